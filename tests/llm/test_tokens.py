import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tradewind.llm import counting, packing, tokenfiles
from tradewind.llm.common import shared_folder
from tradewind.llm.tokens import word_encoder

BYTE, WORD, PIECE = (path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
TEXT = st.text(st.sampled_from("aeT é.,-'5 \n\t 日Σ|<>▁İ"), max_size=25) | st.text(max_size=15)


def totals(counter, texts):
    counts, sizes = counter.tables(pa.array(texts, pa.string()))
    return [int(own[-1]) if len(own) else 0 for own in np.split(counts, np.cumsum(sizes)[:-1])]


def whole(file, text):
    return Tokenizer.from_file(file).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(("file", "drops_space"), [(BYTE, False), (WORD, True)])
def test_encoder_gives_the_librarys_ids(file, drops_space):
    encoder, library = word_encoder(file, drops_space), Tokenizer.from_file(file)

    @settings(max_examples=60, deadline=None)
    @given(st.lists(TEXT, min_size=1, max_size=20))
    def check(texts):
        found = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(pa.array(texts))]
        assert found == [library.encode(t, add_special_tokens=False).ids for t in texts]

    check()


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=20))
def test_counter_gives_the_librarys_counts(texts):
    model = SentencePieceProcessor(model_file=PIECE)
    assert totals(counting.prefix_counter(PIECE), texts) == [len(model.encode(t)) for t in texts]


def test_null_characters_are_counted():
    model = SentencePieceProcessor(model_file=PIECE)
    texts = ["a\0b c", "\0", "\0a", "a\0", "a \0 b", "\0\0 a", "a\0\0b", " \0", "▁\0", "no such character"]
    assert totals(counting.prefix_counter(PIECE), texts) == [len(model.encode(t)) for t in texts]

    @settings(max_examples=60, deadline=None)
    @given(st.lists(st.text(st.sampled_from("aeT é\0.\n▁日"), max_size=20), min_size=1, max_size=20))
    def check(texts):
        assert totals(counting.prefix_counter(PIECE), texts) == [len(model.encode(t)) for t in texts]

    check()


def test_questions_are_answered_from_the_table():
    model = SentencePieceProcessor(model_file=PIECE)
    for text in ["Thing of  the\nworld, 日本 é ", "a", " x y", "one▁two three"]:
        _, tokens = counting.prefix_counter(PIECE).table(text)
        counts = [len(model.encode(text[:i])) for i in range(len(text) + 1)]
        assert [counting.tokens_of_prefix(tokens, i) for i in range(len(text) + 1)] == counts
        for budget in range(counts[-1] + 2):
            assert counting.longest_prefix(tokens, budget) == max(i for i, n in enumerate(counts) if n <= budget)


def prefix_counts(model, text):
    return [len(model.encode(text[:i])) for i in range(1, len(text) + 1)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(TEXT, st.text(st.sampled_from("aeinorst \0▁日"), max_size=40)), max_size=6))
def test_tables_hold_every_prefix(texts):
    model = SentencePieceProcessor(model_file=PIECE)
    counts, sizes = counting.prefix_counter(PIECE).tables(pa.array(texts, pa.string()))
    assert sizes.tolist() == [len(t) for t in texts]
    assert counts.tolist() == [n for t in texts for n in prefix_counts(model, t)]


def test_tables_of_longer_texts(rows):
    model = SentencePieceProcessor(model_file=PIECE)
    for text in [r[1] for r in rows[:8]] + ["日本語" * 60, "internationalization" * 9, "a" * 200, "x▁" * 50, " " * 70]:
        assert counting.prefix_counter(PIECE).table(text)[1] == prefix_counts(model, text)


def test_word_tables_are_forgotten_and_made_again(monkeypatch, rows):
    monkeypatch.setattr(counting, "KEPT_BYTES", 20_000)
    counter, model = counting.PrefixCounter(PIECE), SentencePieceProcessor(model_file=PIECE)
    for _ in range(2):
        for i in range(0, 60, 10):
            texts = [r[1] for r in rows[i : i + 10]]
            assert totals(counter, texts) == [len(model.encode(t)) for t in texts]
    assert len(counter.kept.words) < 2_000


def test_token_counts(docs, rows, empty):
    model = SentencePieceProcessor(model_file=PIECE)
    found = Counter(tuple(r)[:4] for r in counting.count_tokens(docs, PIECE, limit=100).collect())
    sizes = [len(model.encode(r[1] or "")) for r in rows]
    assert found == Counter((r[0], len((r[1] or "").encode()), n, n > 100) for r, n in zip(rows, sizes, strict=True))
    assert {r[3] for r in found} == {True, False}
    assert counting.count_tokens(empty, PIECE, limit=100).count() == 0
    stored = counting.count_tokens(docs.where("doc_id < 5"), PIECE, limit=1, tables=True).collect()
    assert all(r.tokens_at[-1] == r.n_tokens and len(r.tokens_at) == len(r.prefix_ends) for r in stored)


def test_packing(docs, rows, empty):
    found = packing.packed(docs, BYTE, end_id=0, capacity=256).toPandas()
    expected = Counter()
    for doc_id, text, *_ in rows:
        ids = np.array([*whole(BYTE, text), 0], "<u4")
        first = len(ids) % 256 or 256
        bounds = [0, *range(first, len(ids) + 1, 256)]
        expected.update((doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)))
    names = ["piece", "start", "length", "ids_crc32"]
    ids = [None if x != x else int(x) for x in found.doc_id.tolist()]
    assert Counter(zip(ids, *(found[c].tolist() for c in names), strict=True)) == expected
    in_order = found.sort_values(["sequence_id", "offset"])
    ends = in_order.groupby("sequence_id").length.cumsum()
    assert (ends - in_order.length == in_order.offset).all() and ends.max() <= 256
    assert found.sequence_id.nunique() <= -(-found.length.sum() // 256) + 2
    assert packing.packed(empty, BYTE, end_id=0).count() == 0


def test_packed_blocks_hold_the_ids(docs):
    parts = packing.pack(packing.pieces(docs, BYTE, 0, 256, with_ids=True), 256)
    blocks = packing.blocks(parts).toPandas()
    assert blocks.ids.map(len).max() <= 256 and blocks.ids.map(len).sum() == parts.groupBy().sum("length").first()[0]


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 50), max_size=12))
def test_plan_uses_up_every_length(counts):
    patterns = packing.plan(counts, 40)
    total = Counter()
    for p in patterns:
        assert p.blocks > 0 and sum(n * each for n, each in p.fill) <= 40
        for n, each in p.fill:
            total[n] += each * p.blocks
    assert total == Counter(counts)
    gaps = []  # best fit, longest first, piece by piece
    for n in sorted(Counter(counts).elements(), reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else 40) - n)
    assert sum(p.blocks for p in patterns) <= 1.3 * len(gaps) + 2


def test_token_files_round_trip(spark, docs, rows, empty):
    folder = shared_folder(spark, "tokens")
    tokenfiles.write_tokens(docs, folder, WORD, end_id=1)
    read = tokenfiles.read_tokens(spark, folder).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in read) == Counter((r[0], (*whole(WORD, r[1]), 1)) for r in rows)
    found = sorted(tokenfiles.token_digests(spark, folder).collect(), key=lambda r: r.start)
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found[:-1])]).tolist()
    ids = [-1 if r.doc_id is None else r.doc_id for r in found]
    assert ids == sorted(ids)
    tokenfiles.write_tokens(empty, f"{folder}-none", WORD, end_id=1)
    assert tokenfiles.token_digests(spark, f"{folder}-none").count() == 0


def test_token_files_are_written_for_selective_reads(spark, docs):
    import pyarrow.parquet as pq

    folder = shared_folder(spark, "tokens")
    tokenfiles.write_tokens(docs.coalesce(1), folder, WORD, end_id=1)
    file = next(f.path for f in spark.read.format("binaryFile").load(folder).select("path").collect() for f in [f] if ".parquet" in f.path)
    column = pq.ParquetFile(file.removeprefix("file:")).metadata.row_group(0).column(3)
    assert "DELTA_BINARY_PACKED" in column.encodings and column.has_column_index
