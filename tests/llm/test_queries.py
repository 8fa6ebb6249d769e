"""The registered queries and the pipeline over a folder of odd rows, against plain forms of their contracts."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from public_tokenizers import path
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import corpus_pipeline
from tradewind.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


@pytest.fixture(scope="module")
def folder(spark, docs, rows, tmp_path_factory):
    home = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{home}/documents.parquet")
    labels = [(r[0], 1 if len(r[1] or "") > 400 else 0, 0) for r in rows[:60] if r[0] is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{home}/labels.parquet")
    random = np.random.default_rng(4)
    vectors = [(i, random.normal(size=64).tolist()) for i in range(160)]
    spark.createDataFrame(vectors + [(200, [0.0] * 64), (200, [0.0] * 64), (201, None)], "vec_id long, embedding array<double>").write.parquet(f"{home}/embeddings.parquet")
    return home


def found(spark, folder, name, *columns):
    return Counter(map(tuple, QUERIES[name](spark, folder).select(*columns).collect()))


def crc_of_id(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def ids_crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1(spark, folder, rows):
    out = QUERIES["op1_source_mix"](spark, folder).collect()
    sizes, per_source = Counter(), defaultdict(int)
    for r in rows:
        n = len(WORDS(r[1] or ""))
        sizes[r[0], n] += 1
        per_source[r[3]] += n
    assert Counter((r.doc_id, r["size"]) for r in out) == sizes
    taken = defaultdict(int)
    for r in out:
        assert r.source_size == per_source[r.source] and r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    assert sum(taken.values()) == pytest.approx(1.5 * sum(per_source.values()), rel=0.01)
    plan = QUERIES["op1_source_mix"](spark, folder)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "InArrow", "InPandas", "ExternalRDD"))


def check_pieces(out, texts):
    """Pieces of at most 2,048 tokens, without gaps in documents and sequences."""
    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    whole, sequences = Counter(), defaultdict(list)
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        bounds = [0, *range(min(first, len(ids)), len(ids) + 1, 2048)]
        whole.update((doc_id, i, a, b - a, ids_crc(ids[a:b])) for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == whole
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048
    return len(sequences), sum(r.length for r in out)


def test_op2(spark, folder, rows):
    n, tokens = check_pieces(QUERIES["op2_best_fit_packing"](spark, folder).collect(), [r[:2] for r in rows])
    assert n <= -(-tokens // 2048) + 1


def test_op3(spark, folder):
    out = QUERIES["op3_topk_search"](spark, folder).collect()
    codes = Counter(map(tuple, spark.read.parquet(f"{folder}/embeddings.parquet").where("embedding IS NOT NULL").selectExpr("vec_id", "transform(embedding, x -> int(x > 0))").rdd.map(lambda r: (r[0], tuple(r[1]))).collect()))
    every = list(codes.elements())
    want = Counter()
    for q, code in every:
        if q % 50 == 0:
            near = sorted((sum(a != b for a, b in zip(code, c, strict=True)), i) for i, c in every)[:10]
            want.update((q, rank + 1, i, d) for rank, (d, i) in enumerate(near))
    names = out[0].__fields__
    assert len(out) == sum(want.values())
    assert Counter((r[0], r[names.index("rank")], r[1], r[2]) for r in out) == want


def test_op4(spark, folder, rows):
    model = SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    want = Counter((r[0], len((r[1] or "").encode()), n := len(model.encode(r[1] or "")), n > 4096) for r in rows)
    assert found(spark, folder, "op4_token_counts", "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_op5(spark, folder, rows):
    want = Counter()
    for doc_id, text, *_ in rows:
        text = text or ""
        words = WORDS(text)
        seen = Counter(zip(words, words[1:], words[2:], strict=False))
        repeated = {i + j for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if seen[w] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if WORDS(x)]
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        want[doc_id, len(words), sum(map(len, words)), sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), len(repeated), failed] += 1
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert found(spark, folder, "op5_quality_rules", *columns) == want
    kept = QUERIES["op5_quality_rules"](spark, folder)
    assert kept.where("kept AND base_failed").count() == 0 and kept.where("kept").count() > 0


def test_op6_and_op7(spark, folder, rows):
    out = QUERIES["op6_language_id"](spark, folder).collect()
    assert Counter((r.doc_id, r.held_out) for r in out) == Counter((r[0], crc_of_id(r[0]) % 3 == 1) for r in rows)
    assert {r.lang_pred for r in out} <= {"en", "fr", "und"} and all(0 <= r.score <= 1 for r in out)
    bare = {r[0] for r in rows if not any(c.isalpha() for c in r[1] or "")} - {r[0] for r in rows if any(c.isalpha() for c in r[1] or "")}
    assert {r.lang_pred for r in out if r.doc_id in bare} == {"und"}
    out = QUERIES["op7_quality_classifier"](spark, folder).collect()
    assert Counter((r.doc_id, r.held_out) for r in out) == Counter((r[0], crc_of_id(r[0]) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)


def fingerprint(text):
    small = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = WORDS(small)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op8(spark, folder, rows):
    prints = [fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for i, p in enumerate(prints):
            low = min(group[j] for j, q in enumerate(prints) if (p ^ q).bit_count() <= 4)
            group[i] = min(group[i], low)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[group[i]] = min(r[0], least.get(group[i], r[0]))
    out = QUERIES["op8_simhash_dedup"](spark, folder).collect()
    known = Counter((r.doc_id, r.fingerprint, r.component_id) for r in out if r.doc_id is not None)
    assert known == Counter((r[0], f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, group, strict=True) if r[0] is not None)
    assert len(out) == len(rows)


def test_op9(spark, folder, rows):
    tokenizer = Tokenizer.from_file(path("word_bpe_49k.json"))
    out = sorted(QUERIES["op9_token_files"](spark, folder).collect(), key=lambda r: r.start)
    ids = [(r[0], [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1]) for r in rows]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == Counter((i, len(x), ids_crc(x)) for i, x in ids)
    assert [r.doc_id is not None and r.doc_id for r in out] == sorted(r.doc_id is not None and r.doc_id for r in out)
    assert [r.start for r in out] == np.cumsum([0, *(r.n_tokens for r in out)])[:-1].tolist()


def removed(texts):
    starts = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - 199):
            if starts[t[i : i + 200]] > 1:
                gone[i : i + 200] = True
        yield bytes(b for b, g in zip(t, gone, strict=False) if not g), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum())


def test_op10(spark, folder, rows):
    texts = [(r[1] or "").encode() for r in rows]
    want = Counter((r[0], len(t), n, spans, hashlib.sha256(kept).hexdigest()) for r, t, (kept, n, spans) in zip(rows, texts, removed(texts), strict=True))
    assert found(spark, folder, "op10_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_pipeline(spark, folder, rows):
    """Each stage on what the one before it kept, then all in a row."""
    docs, columns = spark.read.parquet(f"{folder}/documents.parquet"), None
    kept = []
    for name, stage in corpus_pipeline.STAGES[:4]:
        columns = columns or docs.columns
        docs = corpus_pipeline.written(stage(spark, docs, folder), "test-stage")
        assert docs.columns == columns, name
        kept.append(docs.select("doc_id", "text", "source").collect())
    scores = {r.doc_id: r.score for r in QUERIES["op7_quality_classifier"](spark, folder).collect()}
    assert {r.doc_id for r in kept[0]} == {i for i, s in scores.items() if s >= 0.7}
    prints = [fingerprint(r.text) for r in kept[1]]
    assert len(set(prints)) == len(prints) and {r.doc_id for r in kept[1]} <= {r.doc_id for r in kept[0]}
    left = Counter(k.decode(errors="ignore") for k, _, _ in removed([(r.text or "").encode() for r in kept[1]]))
    assert Counter(r.text or "" for r in kept[2]) == left
    words, mixed = Counter(), Counter()
    for r in kept[2]:
        words[r.doc_id] += len(WORDS(r.text or ""))
    for r in kept[3]:
        mixed[r.doc_id] += len(WORDS(r.text or ""))
    assert all(n <= 2 * words[i] for i, n in mixed.items())
    assert sum(mixed.values()) == pytest.approx(1.5 * sum(words.values()), rel=0.01)
    last = corpus_pipeline.STAGES[4][1](spark, docs, folder).collect()
    check_pieces(last, [(r.doc_id, r.text) for r in kept[3]])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, corpus_pipeline.run(spark, folder).select(columns).collect())) == Counter(tuple(r[c] for c in columns) for r in last)
