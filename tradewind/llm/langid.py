"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to three bytes. A byte's code length is that under its longest context
known to the language, with an escape to the next shorter one for bytes not seen there; a context's escape
probability is its number of different next bytes over that and its number of bytes. The language with the
shortest code of a text is predicted. Counts are frozen after the fit, so code lengths are looked up in tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches

# Stands before each text, so that its first bytes have contexts too.
START = b"\n\n\n"
# Bytes times languages that are looked up at a time.
VALUES = 1 << 20


class Contexts(NamedTuple):
    """Bits by gram and language, only where a language has met the gram: `first[i]` to `first[i + 1]` are the places of
    gram `keys[i]` in `lang`, `bits` and `escape`. `bits` is what is to be added for the gram in a text to the bits
    under shorter contexts, `escape` the part of it that counts for the byte after the gram."""

    keys: np.ndarray
    first: np.ndarray
    lang: np.ndarray
    bits: np.ndarray
    escape: np.ndarray


class Model(NamedTuple):
    """`code` gives each byte value a number, 0 for bytes not met in the fit, below `size`. `two` has the bits of a byte after one
    byte, and `escape` those of leaving a context of two bytes, by the numbers of two bytes and language. Longer grams are
    kept for the languages that have met them, so the model takes some 16 bytes for each gram and language met in the
    sample, and 8 bytes a language for each pair of byte values, at most half a megabyte."""

    languages: list[str]
    code: np.ndarray
    size: int
    two: np.ndarray
    escape: np.ndarray
    three: Contexts
    four: Contexts

    def n_bytes(self) -> int:
        own = [self.code, self.two, self.escape, *self.three, *self.four]
        return sum(x.nbytes for x in own)


def _grams(codes: np.ndarray, n: int, size: int) -> np.ndarray:
    """Numbers of the n bytes that end at each position from n - 1 on."""
    total = np.zeros(len(codes) - n + 1, dtype=np.int64)
    for i in range(n):
        total = total * size + codes[i : len(codes) - n + 1 + i]
    return total


def count_grams(docs: DataFrame, rows_per_language: int) -> DataFrame:
    """Counts of four bytes in a row: lang, gram, n. `docs(doc_id, text, lang)` are the labelled rows; of a language
    with more than `rows_per_language` rows, about that many are taken, by a hash of doc_id and text."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    share = F.coalesce(*(F.when(F.col("lang") == k, F.lit(min(1.0, rows_per_language / n))) for k, n in sizes.items()), F.lit(0.0))
    dealt = F.pmod(F.xxhash64(F.lit(7), "doc_id", F.crc32(F.col("text").cast("binary"))), F.lit(1 << 30))
    sample = known.where(dealt < share * (1 << 30))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, dict[int, int]] = {}
        for batch in text_batches(batches):
            langs = batch.column("lang").to_pylist()
            texts = batch.column("text").to_pylist()
            for lang in set(langs):
                data = [START + t.encode() for t, own in zip(texts, langs, strict=True) if own == lang]
                ends = np.cumsum([len(x) for x in data])
                every = _grams(np.frombuffer(b"".join(data) + START, np.uint8).astype(np.int64), 4, 256)
                # A gram counts where its last byte is one of a text, so none goes from one text to the next.
                between = (ends[:, None] - np.arange(len(START), 0, -1)).ravel()
                grams, n = np.unique(np.delete(every, between), return_counts=True)
                own = sums.setdefault(lang, {})
                for g, k in zip(grams.tolist(), n.tolist(), strict=True):
                    own[g] = own.get(g, 0) + k
        for lang, own in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(own), "gram": list(own), "n": list(own.values())})

    parts = sample.mapInArrow(count, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _contexts(grams: np.ndarray, lang: np.ndarray, bits: np.ndarray, escape: np.ndarray) -> Contexts:
    order = np.lexsort((lang, grams))
    keys, first = np.unique(grams[order], return_index=True)
    return Contexts(keys, np.append(first, len(grams)).astype(np.int32), lang[order].astype(np.int16), bits[order].astype(np.float32), escape[order].astype(np.float32))


def _after(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Bits of each byte after each context, from counts (the last axis is the byte) and the bits under the shorter context."""
    total, kinds = counts.sum(-1, keepdims=True), (counts > 0).sum(-1, keepdims=True)
    with np.errstate(divide="ignore"):
        seen, escape = -np.log2(counts / np.maximum(total + kinds, 1)), -np.log2(kinds / np.maximum(total + kinds, 1))
    return np.where(counts > 0, seen, shorter + np.where(kinds > 0, escape, 0))


def fit(docs: DataFrame, rows_per_language: int = 2000) -> Model:
    """Context trees of the languages in `docs(doc_id, text, lang)`; rows without a text or language teach nothing, and
    repeated rows count each time. An empty table gives a model without languages.

    The driver gets the counts of the bounded sample. All of its contexts are kept.
    """
    rows = count_grams(docs, rows_per_language).toPandas()
    languages = sorted(rows["lang"].unique())
    grams = rows["gram"].to_numpy(np.int64)
    digits = [(grams >> s) & 255 for s in (24, 16, 8, 0)]
    used = np.unique(np.concatenate([*digits, np.frombuffer(START, np.uint8)]))
    code = np.zeros(256, dtype=np.int64)
    code[used] = np.arange(1, len(used) + 1)
    size, kinds = len(used) + 1, len(languages)
    a, b, c, d = (code[x] for x in digits)
    n = rows["n"].to_numpy(np.float64)
    lang = np.searchsorted(np.array(languages, dtype=object), rows["lang"].to_numpy()) if kinds else np.zeros(0, np.int64)

    def table(place: np.ndarray, *shape: int) -> np.ndarray:
        return np.bincount(place, weights=n, minlength=int(np.prod(shape))).reshape(shape)

    zero = _after(table(lang * size + d, kinds, size), np.full((kinds, size), 8.0))
    one = _after(table((lang * size + c) * size + d, kinds, size, size), zero[:, None, :])

    # Three bytes and a language: their number, and what stands for them in the context of two bytes.
    key, at = np.unique(((b * size + c) * size + d) * max(kinds, 1) + lang, return_inverse=True)
    met = np.bincount(at, weights=n, minlength=len(key))
    three, of = np.divmod(key, max(kinds, 1))
    pair = of * size * size + three // size
    total = np.bincount(pair, weights=met, minlength=kinds * size * size)
    others = np.bincount(pair, minlength=kinds * size * size)
    leave = np.where(others > 0, -np.log2(np.maximum(others, 1) / np.maximum(total + others, 1)), 0.0)
    last = of * size * size + three % (size * size)
    shorter = leave[pair] + one.ravel()[last]
    bits = -np.log2(met / (total + others)[pair])

    # Four bytes and a language, in the context of three.
    before, place = np.unique(((a * size + b) * size + c) * max(kinds, 1) + lang, return_inverse=True)
    total = np.bincount(place, weights=n, minlength=len(before))
    others = np.bincount(place, minlength=len(before))
    escape = -np.log2(others / (total + others))
    longest = -np.log2(n / (total + others)[place]) - escape[place] - bits[at]
    four = _contexts(((a * size + b) * size + c) * size + d, lang, longest, np.zeros(len(n)))

    every = np.union1d(key, before)
    as_gram, as_context = np.zeros(len(every)), np.zeros(len(every))
    as_gram[np.searchsorted(every, key)] = bits - shorter
    as_context[np.searchsorted(every, before)] = escape
    own, of = np.divmod(every, max(kinds, 1))
    two = one.reshape(kinds, size * size).T.astype(np.float32)
    leave = leave.reshape(kinds, size * size).T.astype(np.float32)
    return Model(languages, code, size, two, leave, _contexts(own, of, as_gram + as_context, as_context), four)


def _add(sums: np.ndarray, table: Contexts, values: np.ndarray, grams: np.ndarray, own: np.ndarray) -> None:
    """Add to `sums` (texts by languages) the values of the grams that the languages have met; `own` are the texts."""
    if not len(grams) or not len(table.keys):
        return
    at = np.searchsorted(table.keys, grams)
    at[at == len(table.keys)] = 0
    known = table.keys[at] == grams
    at, text = at[known], own[known]
    low = table.first[at].astype(np.int64)
    n = table.first[at + 1] - low
    rows = np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n)
    place = np.repeat((text - own[0]) * sums.shape[1], n) + table.lang[rows]
    few = sums[own[0] : own[-1] + 1]
    few += np.bincount(place, weights=values[rows], minlength=few.size).reshape(few.shape)


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Bits of each text under each language. The texts' bytes are gone through in stretches, so that memory beyond the
    texts doesn't grow with their length."""
    size, kinds = model.size, len(model.languages)
    data = np.frombuffer(b"".join(START + t for t in texts), np.uint8)
    stops = np.cumsum([len(t) + len(START) for t in texts])
    first = stops - [len(t) for t in texts]
    sums = np.zeros((len(texts), kinds))
    step = max(1, VALUES // max(kinds, 1))
    for start in range(len(START), len(data), step):
        stop = min(start + step, len(data))
        codes = model.code[data[start - len(START) : stop]]
        own = np.searchsorted(stops, np.arange(start, stop), side="right")
        inside = np.flatnonzero(np.arange(start, stop) >= first[own])
        if not len(inside):
            continue
        own = own[inside]
        pairs = codes[:-1] * size + codes[1:]
        three = pairs[:-1] * size + codes[2:]
        four = (three[:-1] * size + codes[3:])[inside]
        bits = model.two[pairs[2:][inside]] + model.escape[pairs[1:-1][inside]]
        begins = np.flatnonzero(np.diff(own, prepend=-1))
        sums[own[begins]] += np.add.reduceat(bits, begins, axis=0, dtype=np.float64)
        _add(sums, model.three, model.three.bits, three[1:][inside], own)
        _add(sums, model.four, model.four.bits, four, own)
    # Escapes count for the byte that follows: not after a text's last bytes, but after those that stand before it.
    ends = model.code[data[stops[:, None] + np.arange(-3, 0)]] if len(texts) else np.zeros((0, 3), np.int64)
    every = np.arange(len(texts))
    _add(sums, model.three, -model.three.escape, (ends[:, 0] * size + ends[:, 1]) * size + ends[:, 2], every)
    begin = model.code[np.frombuffer(START, np.uint8)]
    _add(sums, model.three, model.three.escape, np.full(len(texts), (begin[0] * size + begin[1]) * size + begin[2]), every)
    return sums


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of `docs(doc_id, text)`: doc_id, lang_pred and score. `und` with score 0 where the text is null or has no
    letter, or where no language was learned. The score is the share of the predicted language when a language's
    weight halves with each bit that it needs more, per byte of up to 64 bytes. Equal codes: the first by name. Repeated
    rows are rows of their own; an empty table gives none."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample, see Model

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, letter = shared.value, regex.compile(r"\p{L}").search
        for batch in text_batches(batches):
            texts = batch.column("text").to_pylist()
            known = [bool(model.languages) and t is not None and letter(t) is not None for t in texts]
            found, scores = ["und"] * len(texts), [0.0] * len(texts)
            rows = [i for i, k in enumerate(known) if k]
            if rows:
                data = [texts[i].encode() for i in rows]
                bits = code_lengths(model, data)
                best = bits.argmin(1)
                most = np.minimum(np.array([len(x) for x in data]), 64) / np.array([len(x) for x in data])
                share = 1 / np.exp2((bits.min(1, keepdims=True) - bits) * most[:, None]).sum(1)
                for i, k, s in zip(rows, best.tolist(), share.tolist(), strict=True):
                    found[i], scores[i] = model.languages[k], s
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(found), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"]
            )

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, lang_pred string, score double")
