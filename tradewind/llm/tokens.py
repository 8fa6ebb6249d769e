"""Whole texts to token ids in tasks, with ids of words kept between texts.

No token of the vocabularies used here spans a change from a word to the space after it, nor, in texts of Latin
letters, digits and ASCII marks without apostrophes, one between letters or digits and marks. So plain texts are cut
there, each slice's different words are looked up, and those not seen yet are encoded by the library, many in a row.
Other texts are encoded whole.
"""

from __future__ import annotations

import gc
import os
import struct
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Letters whose small forms are single letters too, and digits; ASCII marks without the apostrophe.
LETTERS = "0-9A-Za-zÀ-ÖØ-öø-įı-ſ"
MARKS = "!-&(-/:-@\\[-`{-~"
# What plain texts don't have: other characters, and what may begin a special token.
OTHERS = rf"[^{LETTERS}{MARKS} \t\n\x0b\x0c\r]|<\|"
# White space beside a space, or at an end of a text: there a text isn't cut at single spaces.
UNEVEN = r"[ \t\n\x0b\x0c\r] | [\t\n\x0b\x0c\r]|^ | $"
# A full stop or comma beside another mark or after white space; elsewhere it is a piece by itself.
MARKED = rf"[.,][{MARKS}']|[{MARKS}'][.,]|[ \t\n\x0b\x0c\r][.,]|^[.,]"
# Words that keep to themselves in a row of such: a space, and then no white space at either end.
JOINED = r"(?s)^ [^ \t\n\x0b\x0c\r](.*[^ \t\n\x0b\x0c\r])?$"
# Words that are encoded as one text.
TOGETHER = 2000
# Words and ids that an encoder keeps.
KEPT_BYTES = 56_000_000
# Odd factors of a word's bytes in its hash.
FACTORS = np.random.default_rng(11).integers(0, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def cut_words(texts: pa.Array) -> pa.ListArray:
    """Words of texts with the single space before each but the first."""
    return pc.split_pattern(pc.replace_substring(texts, " ", "\0 "), "\0")


def _hashes(words: pa.Array) -> np.ndarray:
    """64 bits per word."""
    if not len(words):
        return np.zeros(0, np.uint64)
    bounds = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]].astype(np.uint64)
    sizes = np.diff(bounds)
    factors = FACTORS[(np.arange(len(data)) - np.repeat(bounds[:-1] - bounds[0], sizes)) % len(FACTORS)]
    sums = np.append(np.uint64(0), np.cumsum((data + np.uint64(1)) * factors))
    found = sums[bounds[1:] - bounds[0]] - sums[bounds[:-1] - bounds[0]]
    return found ^ (found >> np.uint64(32))


class WordIds:
    """Ids of the words met lately, in arrays; `make` gives those of new words and how many each has. Words are found by
    their hashes and compared themselves then."""

    def __init__(self, make: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], most: int):
        self.make, self.most = make, most
        self.words, self.ids, self.ends = pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(1, np.int64)
        self.hashes, self.order = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _halved(self) -> None:
        """The newer half of the words is kept."""
        half = len(self.words) // 2
        self.words = pa.concat_arrays([self.words.slice(half), pa.array([], pa.string())])
        self.ids, self.ends = self.ids[self.ends[half] :].copy(), self.ends[half:] - self.ends[half]
        newer = self.order >= half
        self.hashes, self.order = self.hashes[newer], self.order[newer] - half

    def places(self, words: pa.Array) -> np.ndarray:
        """Where each of some different words stands among the `words`, until the next call."""
        if self.words.nbytes + self.ids.nbytes + self.hashes.nbytes + self.order.nbytes > self.most:
            self._halved()
        hashes = _hashes(words)
        found = np.full(len(words), -1)
        if len(self.words) and len(words):
            near = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            met = np.flatnonzero(self.hashes[near] == hashes)
            at = self.order[near[met]]
            same = pc.equal(words.take(pa.array(met)), self.words.take(pa.array(at))).to_numpy(zero_copy_only=False)
            found[met[same]] = at[same]
        new = found < 0
        if new.any():
            own = np.arange(len(self.words), len(self.words) + new.sum())
            found[new] = own
            fresh = words.filter(pa.array(new))
            ids, sizes = self.make(fresh)
            self.words = pa.concat_arrays([self.words, fresh])
            self.ids = np.concatenate([self.ids, ids])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            sort = np.argsort(hashes[new])
            at = np.searchsorted(self.hashes, hashes[new][sort])
            self.hashes, self.order = np.insert(self.hashes, at, hashes[new][sort]), np.insert(self.order, at, own[sort])
        return found


def _flat(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), "<u4", int(sizes.sum())), sizes


class WordEncoder:
    """Encodes texts with a file of the tokenizers library; ids are little-endian unsigned 32-bit integers.

    `drops_space` says that the vocabulary has no tokens for white space and capitals, so that the one need not be
    encoded and the others may be made small before.
    """

    def __init__(self, path: str, drops_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.drops_space = drops_space
        self.other = OTHERS if drops_space else f"{OTHERS}|{UNEVEN}"
        # Bytes of text that each token stands for; word ends are a mark, not text.
        vocabulary = self.tokenizer.get_vocab()
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = len(token.removesuffix("</w>") if drops_space else token)
        self.kept = WordIds(self._encode_words, KEPT_BYTES)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_whole(self, texts: list[str]) -> list[bytes]:
        """By the library at once."""
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in self._ids(texts)]

    def _encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words, all in a row, and how many each has.

        Words that no token can join to their neighbours are encoded as texts of many, which the library does several
        times faster, and told apart by the bytes that tokens stand for. Should a word not end where a token does, its
        text's words are encoded one by one.
        """
        joined = pa.array(np.ones(len(words), bool)) if self.drops_space else pc.match_substring_regex(words, JOINED)
        sizes = np.zeros(len(words), np.int64)
        alone = ~joined.to_numpy(zero_copy_only=False)
        parts = [(np.flatnonzero(alone), *_flat(self._ids(words.filter(pa.array(alone)).to_pylist())))]
        own, at = words.filter(joined), np.flatnonzero(~alone)
        lengths = pc.binary_length(own).to_numpy()
        for i in range(0, len(own), TOGETHER):
            some = own.slice(i, TOGETHER).to_pylist()
            ids = np.array(self._ids([(" " if self.drops_space else "").join(some)])[0], "<u4")
            ends = np.cumsum(lengths[i : i + TOGETHER])
            reached = np.cumsum(self.token_bytes[ids])
            stops = np.searchsorted(reached, ends, side="left")
            if len(ids) and reached[-1] == ends[-1] and (reached[stops] == ends).all():
                # Tokens of no bytes, were there any, would belong to the word before.
                stops = np.searchsorted(reached, ends, side="right")
                parts.append((at[i : i + TOGETHER], ids, np.diff(stops, prepend=0)))
            else:
                parts.append((at[i : i + TOGETHER], *_flat(self._ids(some))))
        for where, _, n in parts:
            sizes[where] = n
        starts = np.cumsum(sizes) - sizes
        every = np.zeros(int(sizes.sum()), "<u4")
        for where, ids, n in parts:
            every[spans(starts[where], n)] = ids
        return every, sizes

    def _plain(self, texts: pa.Array, marked: bool) -> list[bytes]:
        if self.drops_space:
            texts = pc.utf8_lower(texts)
        if not marked:
            cut = " " if self.drops_space else "\0"
            for mark in ".,":
                texts = pc.replace_substring(texts, mark, f"{cut}{mark}{cut}")
        words = pc.ascii_split_whitespace(texts) if self.drops_space else cut_words(texts)
        found = words.values.dictionary_encode()
        place = self.kept.places(found.dictionary)[found.indices.to_numpy()]
        starts, n = self.kept.ends[place], self.kept.ends[place + 1] - self.kept.ends[place]
        ends = np.append(0, np.cumsum(n))
        every = memoryview(self.kept.ids[spans(starts, n)]).cast("B")
        cuts = (4 * ends[words.offsets.to_numpy()]).tolist()
        return [bytes(every[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text, as bytes; none for null."""
        texts = texts.fill_null("")
        kind = pc.if_else(pc.match_substring_regex(texts, self.other), 2, pc.match_substring_regex(texts, MARKED).cast(pa.int32()))
        gc.disable()  # nothing below makes cycles, and very many lists are made
        try:
            own = [texts.filter(pc.equal(kind, k)) for k in range(3)]
            found = [iter(self._plain(own[0], False)), iter(self._plain(own[1], True)), iter(self.encode_whole(own[2].to_pylist()))]
        finally:
            gc.enable()
        return [next(found[k]) for k in kind.to_pylist()]


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, `sizes` of them, in a row."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


@lru_cache(maxsize=2)
def word_encoder(path: str, drops_space: bool) -> WordEncoder:
    """One encoder per worker process and file."""
    return WordEncoder(path, drops_space)
