"""Periodic run detection by block convolution (operator 12).

A *run* is a stretch of words with smallest period q (words q apart are identical) that no
neighbouring word extends, of at least ``max(MIN_LENGTH, MIN_PERIODS * q)`` words.

At scale B = 1, 2, 4, ... the texts are cut into blocks of B words.  A run of period q in [B, 2B)
holds two aligned blocks in a row that occur again q words later.

1. *Convolution.*  For a block x and the window y of 2B words behind it, the sums over i of
   (x_i - y_(d+i))^2 for all B distances d come from one cyclic convolution, by an exact integer
   number-theoretic transform modulo ``PRIME``; distances where it is zero are the block's occurrences.
   A block with a word that does not occur again within 2B words cannot have one and is left out.
2. *Extension.*  Occurrences of blocks in a row at one distance are a chain; the words from
   one block before it to one behind it are compared one by one (so a sum that is a multiple of
   the prime does no harm), which gives the maximal stretches at that distance.
3. *Smallest period.*  Scales ascend, so a stretch inside a run of a smaller period, and only such a one,
   has a smaller period itself, and is dropped.

An Arrow UDF over Spark's partitions: no shuffle, other columns pass through, a lost executor
repeats its own tasks only.  Texts of a batch are worked on together, ``WORDS_AT_ONCE`` words
or one whole text at a time; a text of n words takes O(n log^2 n) steps and O(n) memory.

Defined results: null, empty and blank texts have no words, no runs and collapse to an empty
text; words are compared by their bytes; repeated rows and ties need no rule, as each row
stands alone; an empty table gives an empty result; existing columns of the output's name
are replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_text

#: Least words of a run, and least periods.
MIN_LENGTH, MIN_PERIODS = 6, 4
#: Texts of so many words in all are worked on at once (one longer text: alone).
WORDS_AT_ONCE = 200_000
#: Elements of one matrix of transforms.
MATRIX = 1 << 19
#: 15 * 2^27 + 1, a prime with roots of unity of all orders up to 2^27, and a generator.
PRIME, GENERATOR = 2_013_265_921, 31

RUNS = T.ArrayType(T.StructType().add("start", T.LongType()).add("length", T.LongType()).add("period", T.LongType()))
RESULT = T.StructType().add("runs", RUNS).add("collapsed", T.StringType())
_P = np.uint64(PRIME)


@lru_cache(maxsize=64)
def roots(half: int) -> np.ndarray:
    """The powers w^0 ... w^(half - 1) of a root of unity of order ``2 * half``."""
    w = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    out = np.ones(1, np.uint64)
    step = w
    # w^(k + len) = w^k * w^len, doubling.
    while len(out) < half:
        step = pow(w, len(out), PRIME)
        out = np.concatenate([out, out * np.uint64(step) % _P])
    return out


def transform(a: np.ndarray) -> np.ndarray:
    """Transforms of the rows of ``a`` (of 2^k numbers below the prime), in bit-reversed order."""
    n = a.shape[1]
    half = n // 2
    while half:
        parts = a.reshape(len(a), -1, 2, half)
        low, high = parts[:, :, 0], parts[:, :, 1]
        out = np.empty_like(parts)
        out[:, :, 0] = (low + high) % _P
        out[:, :, 1] = (low + (_P - high)) % _P * roots(half) % _P
        a, half = out.reshape(len(a), n), half // 2
    return a


@lru_cache(maxsize=64)
def inverse_roots(half: int) -> np.ndarray:
    up = roots(half)
    out = np.empty_like(up)
    out[0] = 1
    # w^half = -1, so w^-k = -w^(half - k).
    out[1:] = _P - up[1:][::-1]
    return out


def inverse(a: np.ndarray) -> np.ndarray:
    """The rows whose transforms (in bit-reversed order) are those of ``a``."""
    n = a.shape[1]
    half = 1
    while half < n:
        parts = a.reshape(len(a), -1, 2, half)
        low, high = parts[:, :, 0], parts[:, :, 1] * inverse_roots(half) % _P
        out = np.empty_like(parts)
        out[:, :, 0] = (low + high) % _P
        out[:, :, 1] = (low + (_P - high)) % _P
        a, half = out.reshape(len(a), n), half * 2
    return a * np.uint64(pow(n, PRIME - 2, PRIME)) % _P


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For rows x (B words) and y (2B words), modulo the prime: the sums over i of
    (x_i - y_(d + i))^2 for d = 0 ... B - 1."""
    size = blocks.shape[1]
    x, y = blocks % _P, windows % _P
    padded = np.zeros_like(y)
    padded[:, :size] = x[:, ::-1]
    cross = inverse(transform(padded) * transform(y) % _P)[:, size - 1:2 * size - 1]
    own = (x * x % _P).sum(axis=1, keepdims=True) % _P
    sums = np.zeros((len(y), 2 * size + 1), np.uint64)
    np.cumsum(y * y % _P, axis=1, out=sums[:, 1:])
    there = (sums[:, size:2 * size] - sums[:, :size]) % _P
    return (own + there + np.uint64(2) * (_P - cross)) % _P


def occurrences(ids: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(block start, distance)`` of all zero mismatches of the blocks of ``size`` words that
    begin at ``at``, at distances from ``size`` to ``2 * size - 1``."""
    found = [], []
    step = max(1, MATRIX // (2 * size))
    for s in range(0, len(at), step):
        start = at[s:s + step, None]
        sums = mismatches(ids[start + np.arange(size)], ids[start + np.arange(size, 3 * size)])
        row, distance = np.nonzero(sums == 0)
        found[0].append(at[s:s + step][row])
        found[1].append(distance + size)
    return tuple(np.concatenate(f) if f else np.empty(0, np.int64) for f in found)


def inside(start: np.ndarray, end: np.ndarray, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of the stretches lie inside one of the runs ``(start, end, period)``."""
    if not runs:
        return np.zeros(len(start), bool)
    known = np.array(sorted(runs), dtype=np.int64)
    furthest = np.maximum.accumulate(known[:, 1])
    before = np.searchsorted(known[:, 0], start, side="right")
    return (before > 0) & (furthest[np.maximum(before, 1) - 1] >= end)


def find_runs(ids: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs ``(start, end, period)``, sorted, of the texts that begin at ``begin`` in ``ids``;
    every text is followed by a number of its own.  Numbers need only be equal where words are."""
    n = len(ids)
    if not n:
        return []
    order = np.argsort(ids, kind="stable")
    again = np.full(n, np.iinfo(np.int64).max)
    same = ids[order[1:]] == ids[order[:-1]]
    again[order[:-1][same]] = (order[1:] - order[:-1])[same]
    text_end = np.repeat(begin + lengths, lengths + 1)

    runs: list[tuple[int, int, int]] = []
    size, longest = 1, int(lengths.max())
    while MIN_PERIODS * size <= longest:
        blocks = np.maximum(0, lengths // size - 1)
        first = np.cumsum(blocks) - blocks
        at = np.repeat(begin, blocks) + (np.arange(blocks.sum()) - np.repeat(first, blocks)) * size
        if size == 1:
            at = at[again[at] == 1]
        elif len(at):
            # The largest step to the next same word in a block, by doubling over all positions.
            worst = again
            width = 1
            while width < size:
                worst = np.maximum(worst[:len(worst) - width], worst[width:])
                width *= 2
            at = at[worst[at] < 2 * size]
        if len(at):
            padded = np.concatenate([ids, np.full(3 * size, ids.max() + 1)]).astype(np.uint64)
            block, distance = occurrences(padded, at, size)
            ok = block + distance + size <= text_end[block]
            runs += extended(ids, begin, text_end, block[ok], distance[ok], size, runs)
        size *= 2
    return sorted(runs)


def extended(ids: np.ndarray, begin: np.ndarray, text_end: np.ndarray, block: np.ndarray, distance: np.ndarray,
             size: int, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The runs that chains of blocks with the same distance seed."""
    if not len(block):
        return []
    order = np.lexsort((block, distance))
    block, distance = block[order], distance[order]
    new = np.flatnonzero(np.r_[True, (np.diff(block) != size) | (np.diff(distance) != 0)])
    last = np.r_[new[1:], len(block)] - 1
    start, end, period = block[new], block[last] + size, distance[new]
    # One word less than a block at either side is all that can be added.
    enough = end - start + 2 * (size - 1) + period >= np.maximum(MIN_LENGTH, MIN_PERIODS * period)
    enough[enough] &= ~inside(start[enough], (end + period)[enough], known)
    found = set()
    for a, b, q in zip(start[enough].tolist(), end[enough].tolist(), period[enough].tolist()):
        stop = int(text_end[a])
        low = max(int(begin[np.searchsorted(begin, a, side="right") - 1]), a - size)
        high = min(stop - q, b + size)
        equal = np.r_[False, ids[low:high] == ids[low + q:high + q], False]
        edge = np.flatnonzero(equal[1:] != equal[:-1])
        for s, e in zip((edge[::2] + low).tolist(), (edge[1::2] + low).tolist()):
            if e - s + q >= max(MIN_LENGTH, MIN_PERIODS * q):
                found.add((s, e + q, q))
    if not found:
        return []
    rows = np.array(sorted(found), dtype=np.int64)
    smaller = inside(rows[:, 0], rows[:, 1], known)
    return [tuple(r) for r in rows[~smaller].tolist()]


def _several(texts: list[str]) -> tuple[list[list[tuple[int, int, int]]], list[str]]:
    """Runs ``(start, length, period)`` and the collapsed text of each of ``texts``."""
    words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    begin = np.cumsum(lengths + 1) - (lengths + 1)
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    ids = np.empty(int((lengths + 1).sum()), dtype=np.int64)
    for w, s in zip(words, begin.tolist()):
        ids[s:s + len(w)] = np.fromiter(map(number.__getitem__, w), np.int64, len(w))
    # A word of its own between texts: nothing crosses from one to the next.
    ids[begin + lengths] = len(number) + np.arange(len(texts))
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    dropped: dict[int, np.ndarray] = {}
    for s, e, q in find_runs(ids, begin, lengths):
        k = int(np.searchsorted(begin, s, side="right")) - 1
        own = s - int(begin[k])
        runs[k].append((own, e - s, q))
        if k not in dropped:
            dropped[k] = np.zeros(len(words[k]), bool)
        dropped[k][own + q:own + e - s] = True
    kept = [[x for x, gone in zip(w, dropped[k].tolist()) if not gone] if k in dropped else w
            for k, w in enumerate(words)]
    return runs, [b" ".join(w).decode("utf-8", "surrogatepass") for w in kept]


def runs_of(texts: list[str]) -> tuple[list[list[tuple[int, int, int]]], list[str]]:
    """As :func:`_several`, for any number of texts in bounded groups."""
    runs, collapsed, group, size = [], [], [], 0
    for text in [*texts, None]:
        # A word takes at least two bytes with the blank behind it.
        if group and (text is None or size + len(text) // 2 > WORDS_AT_ONCE):
            done = _several(group)
            runs += done[0]
            collapsed += done[1]
            group, size = [], 0
        if text is not None:
            group.append(text)
            size += len(text) // 2 + 1
    return runs, collapsed


def _arrow(runs: list[list[tuple[int, int, int]]], collapsed: list[str]) -> pa.StructArray:
    offsets = np.cumsum([0, *map(len, runs)], dtype=np.int32)
    flat = np.array([r for own in runs for r in own], dtype=np.int64).reshape(-1, 3)
    items = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"])
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), items),
                                       pa.array(collapsed, pa.string())], names=["runs", "collapsed"])


def detect(df: DataFrame, text_col: str | Column = "text", out_col: str = "periodic") -> DataFrame:
    """``df`` with ``out_col``: a struct of ``runs`` (``start, length, period`` in words, by start, then
    period) and ``collapsed``, the text without the words that repeat the period of a run."""
    @F.arrow_udf(RESULT)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [_arrow(*runs_of(batch.slice(s, 1024).to_pylist())) for s in range(0, len(batch), 1024)]
            yield pa.concat_arrays(parts) if parts else _arrow([], [])

    text = F.col(text_col) if isinstance(text_col, str) else text_col
    return df.withColumn(out_col, found(as_text(text)))
