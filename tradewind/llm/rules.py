"""Quality rules on words, symbols, lines and repetition inside a text, the latter from a suffix array.

The suffix array orders all word suffixes of a slice of texts; suffixes end with their text, so no repeat joins two
texts. Neighbours' longest common prefixes cut it into intervals, one for each repeated substring. The longest repeat
that starts at a word is that of the deepest interval around its suffix, and the union of these spans is the union
of the spans of all maximal repeats, since any other repeat lies inside one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, text_batches
from .suffixes import doubled

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
COUNTS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, " \
    "covered_words long, longest_repeat long"  # fmt: skip


def longest_repeats(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position the length of the longest run of words from there that also starts elsewhere in its text.

    `words` holds a number per word and `ends` the end of the text that each position is in. Of two neighbours in the
    order, the ranks by 2**r words say whether their next 2**r words are equal.
    """
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.int64)
    order, levels = doubled(ends * (int(words.max()) + 1) + words, ends)  # a text's own suffixes only
    a, b = order[:-1], order[1:]
    common = np.zeros(n - 1, dtype=np.int64)
    for r in range(len(levels) - 1, -1, -1):
        i, j = a + common, b + common
        good = (i < ends[a]) & (j < ends[b]) & (ends[a] == ends[b])
        same = good & (levels[r][np.minimum(i, n - 1)] == levels[r][np.minimum(j, n - 1)])
        common += same.astype(np.int64) << r
    longest = np.zeros(n, dtype=np.int64)
    longest[a] = common
    longest[b] = np.maximum(longest[b], common)
    return longest


def _covered(longest: np.ndarray, least: int, span: int | None) -> np.ndarray:
    """Positions inside a repeat of `least` or more words: in all of it, or in the first `span` words from each start."""
    here = np.arange(len(longest))
    reach = np.where(longest >= least, here + (longest if span is None else span), 0)
    return (np.maximum.accumulate(reach) > here) if len(here) else np.zeros(0, dtype=bool)


def _duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return len(lines) - len(set(lines))


def measure(docs: DataFrame, least_words: int) -> DataFrame:
    """Per row of `docs(doc_id, text)` the counts of the base rules, the words covered by repeats of `least_words` or
    more, and the longest repeat in words. A null text has no words, lines or symbols; rows are measured one by one,
    so repeated rows and null ids are rows like any others."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(WORD).findall
        for batch in text_batches(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            words = [find(t) for t in texts]
            sizes = np.array([len(w) for w in words], dtype=np.int64)
            stops = np.cumsum(sizes)
            numbers: dict[str, int] = {}
            ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in chain.from_iterable(words)), np.int64, int(sizes.sum()))
            longest = longest_repeats(ids, np.repeat(stops, sizes))

            def per_text(values: np.ndarray, stops: np.ndarray = stops, sizes: np.ndarray = sizes) -> np.ndarray:
                sums = np.append(0, np.cumsum(values))
                return sums[stops] - sums[stops - sizes]

            most = np.zeros(len(texts), dtype=np.int64)
            full = sizes > 0
            if full.any():
                most[full] = np.maximum.reduceat(longest, (stops - sizes)[full])
            columns = [
                batch.column("doc_id").cast(pa.int64()),
                sizes,
                [sum(map(len, w)) for w in words],
                [sum(map(t.count, SYMBOLS)) for t in texts],
                [_duplicate_lines(t) for t in texts],
                per_text(_covered(longest, 3, 3)),
                per_text(_covered(longest, least_words, None)),
                most,
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[x.split()[0] for x in COUNTS.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(count, COUNTS)


def judge(
    docs: DataFrame, least_words: int = 8, most_covered: float = 0.3, most_share: float = 0.15, most_repeat: int = 50
) -> DataFrame:
    """The measures with `base_failed` (fewer than 50 words, or more than half of them in repeated 3-word windows)
    and `kept`: not failed, at most `most_covered` of the words in repeats of `least_words` or more, and no repeat
    longer than `most_share` of the words or than `most_repeat` words."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    fine = (
        (F.col("covered_words") <= most_covered * F.col("n_words"))
        & (F.col("longest_repeat") <= most_share * F.col("n_words"))
        & (F.col("longest_repeat") <= most_repeat)
    )
    return measure(docs, least_words).withColumn("base_failed", failed).withColumn("kept", ~failed & fine)
