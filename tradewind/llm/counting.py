"""Token counts at every prefix of a text, by dynamic programming over its words.

No piece of the vocabulary spans a change from another character to a space, so the count of a prefix that ends with
a word is the count of the prefix before that word and the word's own count. Inside a word the same holds of the
word's own table of prefixes, which is made once per word and kept as long as it is met. There a prefix's last piece is the only one that
stays apart from the last piece of the prefix before it when the two are merged, so a table takes one pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import ENCODE_BYTES, gives_back, text_batches
from .tokens import WordIds, cut_words, spans

if TYPE_CHECKING:
    from sentencepiece import SentencePieceProcessor

COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, prefix_ends array<int>, tokens_at array<int>"


# Texts in which a space stands beside another or at an end, the mark that stands for a space in pieces, or the character
# at which words are cut.
SPACES = "  |^ | $|\u2581|\\x00"


# Words and tables that are kept; making one costs several times what encoding a word does.
KEPT_BYTES = 128_000_000
# Pairs of pieces of which it is remembered whether they stay apart.
MOST_PAIRS = 300_000


class Merges:
    """The merges of a sentencepiece model of type BPE: of neighbours that make a piece, those of the best score, the
    first of these."""

    def __init__(self, model: SentencePieceProcessor):
        special = (model.is_unknown, model.is_control, model.is_byte)
        ids = [i for i in range(model.get_piece_size()) if not any(f(i) for f in special)]
        self.scores = {model.id_to_piece(i): model.get_score(i) for i in ids}
        self.longest = max(map(len, self.scores))
        self.apart = lru_cache(maxsize=MOST_PAIRS)(self._apart)

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text."""
        parts = list(text)
        while True:
            pairs = [(-self.scores[x], i) for i, x in enumerate(map("".join, zip(parts, parts[1:], strict=False))) if x in self.scores]
            if not pairs:
                return parts
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _apart(self, before: str, piece: str) -> bool:
        """Whether two pieces that follow each other stay as they are."""
        return self.merged(before + piece) == [x for x in (before, piece) if x]

    def prefixes(self, text: str) -> list[int]:
        """Counts of the text's prefixes of 1, 2, ... characters, from the counts of shorter ones. A character that is
        no piece counts with its bytes."""
        text = text.replace(" ", "\u2581")
        counts, last = [0], [0]
        scores, apart, longest = self.scores, self.apart, self.longest
        for end in range(1, len(text) + 1):
            for start in range(end - 1, max(-1, end - longest - 1), -1):
                piece = text[start:end]
                known = piece in scores
                if (known or start == end - 1) and apart(text[start - last[start] : start], piece):
                    counts.append(counts[start] + (1 if known else len(piece.encode())))
                    last.append(end - start)
                    break
        return counts[1:]


class PrefixCounter:
    """Counts of a sentencepiece model that puts a space before each text and keeps all spaces."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.cut = re.compile(r" *[^ ]+| +").findall
        self.merges = Merges(SentencePieceProcessor(model_file=path))
        self.kept = WordIds(self._word_tables, KEPT_BYTES)

    def _word_tables(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The counts at every prefix of different words, in a row, and how many each has."""
        tables = [self.merges.prefixes(w) for w in words.to_pylist()]
        sizes = np.fromiter(map(len, tables), np.int64, len(tables))
        return np.fromiter(chain.from_iterable(tables), "<u4", int(sizes.sum())), sizes

    def _words(self, text: str) -> list[str]:
        """A text's words, the space that the model puts in front with the first. One with the mark that stands for a space
        in pieces is one word, since that mark may be merged with what is before it."""
        if not text:
            return []
        return [f" {text}"] if "\u2581" in text else self.cut(f" {text}")

    def _tables(self, words: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """The tables of texts given as words, in a row, and how many entries each has."""
        found = words.values.dictionary_encode()
        place = self.kept.places(found.dictionary)[found.indices.to_numpy()]
        starts, n = self.kept.ends[place], self.kept.ends[place + 1] - self.kept.ends[place]
        whole = np.zeros(len(n), np.int64)  # a word's count is that at its last prefix
        whole[n > 0] = self.kept.ids[(starts + n - 1)[n > 0]]
        before = np.append(0, np.cumsum(whole))
        bounds = words.offsets.to_numpy()
        before = before[:-1] - np.repeat(before[bounds[:-1]], np.diff(bounds))
        table = self.kept.ids[spans(starts, n)] + np.repeat(before, n)
        sizes = np.diff(np.append(0, np.cumsum(n))[bounds])
        # The space put in front of a text is no prefix of it.
        first = (np.cumsum(sizes) - sizes)[sizes > 0]
        return np.delete(table, first), np.maximum(sizes - 1, 0)

    def tables(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The counts at the prefixes of 1, 2, ... characters of each text, in a row, and how many each text has."""
        texts = texts.fill_null("")
        other = pc.or_(pc.match_substring_regex(texts, SPACES), pc.equal(texts, "")).to_numpy(zero_copy_only=False)
        odd = pa.array(list(map(self._words, texts.filter(pa.array(other)).to_pylist())), pa.list_(pa.string()))
        plain = cut_words(pc.binary_join_element_wise(" ", texts.filter(pa.array(~other)), ""))
        parts = [(np.flatnonzero(other), *self._tables(odd)), (np.flatnonzero(~other), *self._tables(plain))]
        sizes = np.zeros(len(texts), np.int64)
        for where, _, n in parts:
            sizes[where] = n
        starts = np.cumsum(sizes) - sizes
        every = np.zeros(int(sizes.sum()), np.int64)
        for where, counts, n in parts:
            every[spans(starts[where], n)] = counts
        return every, sizes

    def table(self, text: str) -> tuple[list[int], list[int]]:
        """All prefixes of a text but the empty one: where they end, in characters, and their counts."""
        counts, _ = self.tables(pa.array([text]))
        return list(range(1, len(text) + 1)), counts.tolist()


@lru_cache(maxsize=2)
def prefix_counter(path: str) -> PrefixCounter:
    """One counter per worker process and model."""
    return PrefixCounter(path)


def count_tokens(docs: DataFrame, model: str, limit: int, tables: bool = False) -> DataFrame:
    """Per row of `docs(doc_id, text)`: doc_id, n_bytes (UTF-8), n_tokens, over_limit and, if asked for, the table of
    prefixes: `prefix_ends`, each place in the text in characters, and `tokens_at`, the count of the prefix up to there.

    The table of every text is made; `n_tokens` is its last entry, and `over_limit` says that this is above `limit`. A null
    text counts as empty: 0 bytes, 0 tokens, an empty table. Each row is counted by itself, so repeated rows and null ids
    give rows like any others.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counter(model)
        for batch in text_batches(batches, ENCODE_BYTES):
            texts = batch.column("text").fill_null("")
            counts, sizes = counter.tables(texts)
            ends = np.cumsum(sizes)
            total = np.zeros(len(sizes), np.int64)
            total[sizes > 0] = counts[ends[sizes > 0] - 1]
            none = pa.nulls(len(sizes), pa.list_(pa.int32()))
            places = spans(np.ones(len(sizes), np.int64), sizes)
            stored = [pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(x, pa.int32())) for x in (places, counts)]
            columns = [batch.column("doc_id").cast(pa.int64()), pc.binary_length(texts).cast(pa.int64()), pa.array(total), pa.array(total > limit)]
            yield pa.RecordBatch.from_arrays(
                [*columns, *(stored if tables else [none, none])],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "prefix_ends", "tokens_at"],
            )

    return docs.select("doc_id", "text").mapInArrow(gives_back(count), COUNTS)


def tokens_of_prefix(tokens: list[int], length: int) -> int:
    """Count of the first `length` characters, from a text's stored `tokens_at`."""
    return tokens[length - 1] if length > 0 else 0


def longest_prefix(tokens: list[int], budget: int) -> int:
    """Characters of the longest prefix of at most `budget` tokens, from a text's stored `tokens_at`. A longer prefix may
    hold fewer tokens, so it is the last that fits."""
    return next((i for i in range(len(tokens), 0, -1) if tokens[i - 1] <= budget), 0)
