"""Suffix orders of arrays of numbers, in whole-array steps."""

from __future__ import annotations

import numpy as np

# Base of the rolling hashes, odd, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i up to n."""
    up, down = np.ones(n + 1, np.uint64), np.ones(n + 1, np.uint64)
    np.cumprod(np.full(n, BASE, np.uint64), out=up[1:])
    np.cumprod(np.full(n, pow(BASE, -1, 1 << 64), np.uint64), out=down[1:])
    return up, down


def doubled(rank: np.ndarray, ends: np.ndarray, rounds: int | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of the suffixes of `rank`, each up to its `ends`, and their ranks by the first 1, 2, 4, ... numbers.

    Prefix doubling: in each round the ranks of halves rank twice the length, and only suffixes that share their rank
    are sorted again. It ends when all ranks differ, or after `rounds` rounds.
    """
    n = len(rank)
    here = np.arange(n)

    def ranked(keys: np.ndarray, base: np.ndarray) -> np.ndarray:
        new = np.append(True, keys[1:] != keys[:-1])
        return base[np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))]

    order = np.argsort(rank, kind="stable")
    first = np.empty(n, dtype=np.int64)
    first[order] = ranked(rank[order], here)
    levels, k, slots = [first], 1, here
    while rounds is None or len(levels) <= rounds:
        shared = levels[-1][order[slots]]
        twin = np.append(shared[1:] == shared[:-1], False)
        twin[1:] |= twin[:-1].copy()
        slots = slots[twin]
        if not len(slots):
            break
        at = order[slots]
        old, after = levels[-1], at + k
        second = np.where(after < ends[at], old[np.minimum(after, n - 1)], -1)
        keys = old[at] * (n + 1) + second + 1
        by = np.argsort(keys, kind="stable")
        order[slots] = at[by]
        new = old.copy()
        new[at[by]] = ranked(keys[by], slots)
        levels.append(new)
        k *= 2
    return order, levels


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one. The last, a sentinel, counts as smaller."""
    n = len(text)
    rises = np.append(text[:-1] < text[1:], True)
    differs = np.append(text[:-1] != text[1:], True)
    place = np.where(differs, np.arange(n), n - 1)
    return rises[np.minimum.accumulate(place[::-1])[::-1]]


def _induced(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, kinds: int) -> np.ndarray:
    """Order of all suffixes induced from leftmost-smaller ones in their order.

    Buckets by first number are filled one after another: the suffixes that start one place before those of a finished
    bucket follow in the same order; those of the same bucket form the next part of it.
    """
    none = np.zeros(0, dtype=seeds.dtype)

    def deal(parts: list[np.ndarray], waiting: list[list[np.ndarray]]) -> None:
        rows = np.concatenate(parts) if parts else none
        if not len(rows):
            return
        first = text[rows]
        by = np.argsort(first, kind="stable")
        first, rows = first[by], rows[by]
        cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
        for c, own in zip(first[np.append(0, cuts)].tolist(), np.split(rows, cuts), strict=True):
            waiting[c].append(own)

    def fill(c: int, waiting: list[list[np.ndarray]], kind: bool) -> tuple[np.ndarray, list[np.ndarray]]:
        """A bucket's part of one type, and the suffixes before it of that type that belong to other buckets."""
        part = np.concatenate(waiting[c]) if waiting[c] else none
        waiting[c] = []
        own, others = [], []
        while len(part):
            own.append(part)
            before = part[part > 0] - 1
            before = before[smaller[before] == kind]
            same = text[before] == c
            others.append(before[~same])
            part = before[same]
        return (np.concatenate(own) if own else none), others

    first = text[seeds]
    by = np.argsort(first, kind="stable")
    bounds = np.searchsorted(first[by], np.arange(kinds + 1))
    seeds = seeds[by]
    larger: list[np.ndarray] = []
    waiting: list[list[np.ndarray]] = [[] for _ in range(kinds)]
    for c in range(kinds):
        own, others = fill(c, waiting, False)
        larger.append(own)
        start = seeds[bounds[c] : bounds[c + 1]]
        deal([*others, start[start > 0] - 1], waiting)
    less: list[np.ndarray] = [none] * kinds
    for c in range(kinds - 1, 0, -1):  # each bucket from its end, the part of smaller suffixes first
        own, others = fill(c, waiting, True)
        less[c] = own[::-1]
        back = larger[c][::-1]
        back = back[back > 0] - 1
        deal([*others, back[smaller[back]]], waiting)
    less[0] = np.array([len(text) - 1], dtype=seeds.dtype)
    return np.concatenate([x for c in range(kinds) for x in (larger[c], less[c])])


def suffix_order(text: np.ndarray, kinds: int, depth: int) -> np.ndarray:
    """Order of the suffixes of `text`, numbers below `kinds` of which only the last is 0, by `depth` numbers at least.

    Induced sorting. Suffixes are classified; leftmost-smaller substrings are sorted by inducing from any order of their
    starts, and named; the string of names is ordered; and from the suffixes that start there all others are
    induced, in time linear in the text. A name stands for two numbers or more, so names need be compared as far as
    half of `depth` only. The string of names has about as many kinds as places, so it is ordered by doubling, not by
    buckets again.
    """
    n = len(text)
    smaller = _types(text)
    starts = np.flatnonzero(smaller[1:] & ~smaller[:-1]).astype(np.int32) + np.int32(1)
    is_start = np.zeros(n, dtype=bool)
    is_start[starts] = True
    order = _induced(text, smaller, starts, kinds)
    order = order[is_start[order]]
    # Names: equal for equal substrings, from a start to the next, both included; told by length and hash.
    up, down = powers(n)
    sums = np.append(np.uint64(0), np.cumsum((text.astype(np.uint64) + np.uint64(1)) * down[:n]))
    place = np.empty(n, dtype=np.int32)
    place[starts] = np.arange(len(starts), dtype=np.int32)
    stops = np.append(starts[1:] + 1, n)
    hashes = (sums[stops] - sums[starts]) * up[starts]
    at = place[order]
    new = np.append(True, (hashes[at[1:]] != hashes[at[:-1]]) | ((stops - starts)[at[1:]] != (stops - starts)[at[:-1]]))
    names = np.empty(len(starts), dtype=np.int64)
    names[at] = np.cumsum(new)
    del up, down, sums, hashes, place, stops
    if not new.all():
        rounds = max(1, (depth // 2).bit_length())
        by, _ = doubled(names, np.full(len(names), len(names)), rounds)
        order = starts[by]
    return _induced(text, smaller, order, kinds)
