import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tradewind.llm import repeats, simhash
from tradewind.llm.common import WORD
from tradewind.llm.components import components
from tradewind.llm.suffixes import suffix_order


def extras(docs):
    """The values of the columns behind those of documents, the same in all rows."""
    return docs.select(*docs.columns[5:]).distinct().collect()


def print_by_hand(text):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(prints, bits=4):
    group = {p: {p} for p in prints}
    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= bits and group[a] is not group[b]:
                group[a] |= group[b]
                for x in group[b]:
                    group[x] = group[a]
    return group


def test_near_duplicates(docs, rows, empty):
    found = simhash.near_duplicates(docs).collect()
    prints = {r[1]: print_by_hand(r[1]) for r in rows}
    group = components_by_hand(set(prints.values()))
    ids = {}
    for r in rows:
        if r[0] is not None:
            ids.setdefault(prints[r[1]], []).append(r[0])
    expected = Counter((r[0], f"{(p := prints[r[1]]):016x}", min((i for q in group[p] for i in ids.get(q, [])), default=None)) for r in rows)
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found) == expected
    assert simhash.near_duplicates(empty).count() == 0
    left = simhash.without_near_duplicates(docs)
    assert left.columns == docs.columns and extras(left) == extras(docs)
    assert Counter(print_by_hand(r.text) for r in left.collect()).most_common(1)[0][1] == 1
    assert left.count() == len({frozenset(g) for g in group.values()})


@pytest.mark.parametrize("group", [8192, 5])
def test_links_join_all_near_fingerprints(spark, group):
    random = np.random.default_rng(3)
    centres = random.integers(0, 2**63, 25, dtype=np.uint64)
    prints = set(centres.tolist())
    for c in centres.tolist():
        for _ in range(8):
            x = c
            for b in random.integers(0, 64, random.integers(1, 7)).tolist():
                x ^= 1 << b
            prints.add(x)
    frame = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "_fingerprint long").repartition(4)
    found = {}
    for r in components(simhash.links(frame, 4, group)).collect():
        found[r.node % 2**64] = r.root % 2**64
    expected = components_by_hand(prints)
    by_root = {}
    for p in prints:
        by_root.setdefault(found.get(p, p), set()).add(p)
    assert {frozenset(g) for g in by_root.values()} == {frozenset(g) for g in expected.values()}


def test_rows_of_one_id_keep_the_same_text(spark):
    """Texts that differ only in white space share a fingerprint; which of those of the least id stays is fixed."""
    texts = [("one two  three four five" + " " * i) for i in range(12)]
    rows = [(1, t) for t in texts] + [(2, texts[0]), (None, texts[1]), (None, None), (None, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [sorted(map(str, simhash.without_near_duplicates(x).collect())) for x in (frame.coalesce(1), frame.repartition(6), frame.orderBy("text"))]
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 2
    assert simhash.without_near_duplicates(frame.limit(0)).count() == 0


def test_anchors_cover(spark):
    random = np.random.default_rng(4)
    for width in (21, 22):
        a = random.integers(0, 1 << width, 500)
        b = a ^ np.where(random.random(500) < 0.2, 0, 1 << random.integers(0, width, 500))
        at, near = simhash.anchors_near(b, width)
        met = set(zip(at.tolist(), near.tolist(), strict=True))
        assert len(met) == len(at)
        assert all((i, h) in met for i, h in enumerate(simhash.homes(a).tolist()))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (300, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)} | {200: 200, 300: 200}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_order(numbers):
    text = np.array([*numbers, 0], dtype=np.uint8)
    assert suffix_order(text, 5, 1000).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def removal_by_hand(texts, length=200):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    for d in data:
        gone = np.zeros(len(d) + 1, dtype=int)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = 1
        kept = bytes(x for x, g in zip(d, gone, strict=False) if not g)
        yield len(d), int(gone.sum()), int((np.diff(np.append(0, gone)) > 0).sum()), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize(("shard", "piece"), [(None, None), (3000, 2500)])
def test_removals(spark, docs, rows, empty, monkeypatch, shard, piece):
    """Also with anchors that fill more than a shard, and texts longer than a piece."""
    expected = Counter((r[0], *x) for r, x in zip(rows, removal_by_hand([r[1] for r in rows]), strict=True))
    if shard:
        from pyspark import cloudpickle as pickle

        monkeypatch.setattr(repeats, "SHARD", shard)
        monkeypatch.setattr(repeats, "PIECE", piece)
        pickle.register_pickle_by_value(repeats)
    try:
        found = Counter(tuple(r) for r in repeats.removals(docs).collect())
    finally:
        if shard:
            pickle.unregister_pickle_by_value(repeats)
    assert found == expected
    assert repeats.removals(empty).count() == 0


def test_texts_without_repeats(docs, rows):
    left = repeats.without_repeats(docs)
    assert left.columns == docs.columns and left.count() == len(rows)
    assert extras(left) == extras(docs)
    by_id = {r.doc_id: r for r in left.collect()}
    assert by_id[3].text == "" and by_id[3].n_chars == 0 and by_id[2000].text is None and by_id[1003].text == "a"
