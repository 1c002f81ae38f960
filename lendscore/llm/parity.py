"""Shingle sets and parity sketches of texts (the numpy part of operator 7)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import xxhash

#: Words of a shingle; the join's threshold in hundredths.
SHINGLE, PERCENT = 4, 85
#: Ratio of a size band's bounds.
BAND = 1.5
#: Sets with fewer rare elements than this share are sketched whole.
RARE_SHARE = 0.5
#: Keys beyond the first that sets which link must share, per element.
MORE_KEYS = 0.02
#: Least words of the sketches that bound candidates.  Sets with nothing in common differ in half of the
#: bits; sets that link may differ in this share of that half at most.
BOUND_WORDS, BOUND_SHARE = 8, 0.7
#: Characters of texts whose words are hashed together.
AT_ONCE = 1 << 20

_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: Sequence[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """Per text, the sorted hashes of its distinct shingles of lower-cased (A-Z) words; one of the whole
    sequence, if it is shorter; none without words.  Words of ``AT_ONCE`` characters of texts are hashed in one go."""
    out: list[np.ndarray] = []
    held, chars = [], 0
    for text in texts:
        held.append(text)
        chars += len(text or "")
        if chars >= AT_ONCE:
            out += _sets(held, size)
            held, chars = [], 0
    return out + _sets(held, size)


def _sets(texts: Sequence[str | None], size: int) -> list[np.ndarray]:
    words = [t.encode("utf-8", "surrogatepass").lower().split() if t else [] for t in texts]
    counts = [len(w) for w in words]
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), np.uint64, sum(counts))
    total = _shingles(h, size) if len(h) >= size else h
    out, start = [], 0
    for n in counts:
        if n >= size:
            out.append(_distinct(total[start:start + n - size + 1]))
        else:
            out.append(_shingles(h[start:start + n], n) if n else np.empty(0, np.uint64))
        start += n
    return out


def _shingles(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all stretches of ``size`` words."""
    total = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        total = mix(total * _MUL[i % 4] + h[i:len(h) - size + 1 + i])
    return total


def _distinct(values: np.ndarray) -> np.ndarray:
    """``values`` sorted, each once."""
    values = np.sort(values)
    new = np.empty(len(values), bool)
    new[:1] = True
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """:func:`shingle_sets` of one text."""
    return shingle_sets([text], size)[0]


def most_different(n: np.ndarray | int, percent: int = PERCENT):
    """The largest symmetric difference of a set of ``n`` elements and any it may link to."""
    largest = n * 100 // percent
    return (n + largest) * (100 - percent) // (100 + percent)


def shared_keys(n: int) -> int:
    """Keys that a set of ``n`` shares with any it links to, if it has no fewer than the other."""
    return 1 + int(MORE_KEYS * n)


def bands_of(n: int, percent: int = PERCENT) -> list[tuple[int, int]]:
    """``(band, largest size)`` of the bands that a set of ``n`` takes part in.

    Band i covers sizes from BAND^i to BAND^(i+1) * 100 / PERCENT, so that two sets
    that may link share one."""
    i = 0
    while BAND ** (i + 1) <= n:
        i += 1
    out = [(i, int(BAND ** (i + 1) * 100 / percent))]
    if i and n <= int(BAND ** i * 100 / percent):
        out.append((i - 1, int(BAND ** i * 100 / percent)))
    return out


@lru_cache(maxsize=4096)
def band_words(largest: int, percent: int = PERCENT) -> int:
    """Sketch words of a band: as few, so as much in each, as let a set with the least rare
    elements fill the words that it has to emit (of k words, m elements fill k (1 - e^(-m/k)))."""
    emitted = int(most_different(largest, percent)) + shared_keys(largest)
    words, rare = emitted, RARE_SHARE * largest
    while words < 0.9 * largest and words * (1 - math.exp(-rare / words)) < 1.02 * emitted:
        words += max(1, words // 100)
    return words


def sketch(h: np.ndarray, words: int) -> np.ndarray:
    """Parity sketch of ``words`` 64-bit words: every element flips one bit.

    Two sketches differ in at most as many bits, and so words, as their sets do in elements."""
    h = mix(h)
    out = np.zeros(words, dtype=np.uint64)
    np.bitwise_xor.at(out, (h >> np.uint64(6)) % np.uint64(words), np.uint64(1) << (h & np.uint64(63)))
    return out


def whole_sketch(h: np.ndarray, words: int) -> np.ndarray:
    """As :func:`sketch`, but every element flips its word by its whole hash, so that words are equal where they hold
    the same elements.  With one bit each, the few values of a word with one or two elements are met by chance, by more
    sets the more there are."""
    h = mix(h)
    out = np.zeros(words, dtype=np.uint64)
    np.bitwise_xor.at(out, (h >> np.uint64(6)) % np.uint64(words), h)
    return out


def join_keys(h: np.ndarray, rare: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Keys of which two sets that may link share at least the smaller ``shared_keys``.

    With d = ``most_different`` and s = ``shared_keys``, the first d + s non-zero words of each
    whole sketch do (pigeonhole: of the words up to where the first of the two stops, at most d
    differ); a set with fewer emits all its words, zeros too.  Where all but few elements are common ones, the rare
    ones cannot fill so many words: such sets, and those that may link to them, are sketched whole."""
    n, d = len(h), int(most_different(len(h), percent))
    few = RARE_SHARE * n
    kinds = []
    if len(rare) >= few:
        kinds.append((0, rare))
    if len(rare) < few * 100 / percent + 1 + d:
        kinds.append((1, h))
    keys = []
    for band, largest in bands_of(n, percent):
        for kind, elements in kinds:
            s = whole_sketch(elements, band_words(largest, percent))
            at = np.flatnonzero(s)
            most = d + shared_keys(n)
            at = at[:most] if len(at) >= most else np.arange(len(s))
            seed = np.uint64(((band << 1 | kind) + 1) * int(_MUL[0]) % (1 << 64))
            keys.append(mix(mix(s[at] + seed) + at.astype(np.uint64) * _MUL[1]))
    return np.concatenate(keys)


def bound_words(n: int, percent: int = PERCENT) -> int:
    """Words of the sketch that bounds a set's differences: enough that sets with nothing in
    common differ in clearly more bits than sets that link may (it and one of ``n * 100 / percent`` elements,
    which is the most, in ``n * (100 - percent) / percent`` elements)."""
    words = BOUND_WORDS
    while n * (100 - percent) > BOUND_SHARE * 32 * words * percent:
        words *= 2
    return words


def fold(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches (one a row) of ``words`` words, from longer ones of a multiple of them."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, words), axis=1)


def short_sketches(starts: np.ndarray, words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """All bounds folded to ``BOUND_WORDS`` words."""
    short = np.empty((len(starts), BOUND_WORDS), dtype=np.uint64)
    for w in np.unique(words):
        rows = np.flatnonzero(words == w)
        for s in range(0, len(rows), max(1, (1 << 20) // int(w))):
            part = rows[s:s + max(1, (1 << 20) // int(w))]
            short[part] = fold(values[starts[part, None] + np.arange(w)], BOUND_WORDS)
    return short


def near_pairs(a: np.ndarray, b: np.ndarray, n: np.ndarray, short: np.ndarray, starts: np.ndarray, words: np.ndarray,
               values: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """The places of the pairs of rows ``a, b`` that may link, by set sizes ``n`` and bounds (row r has
    ``words[r]`` of ``values`` from ``starts[r]``; ``short``: folded), and how far apart each is, as a share."""
    at = np.flatnonzero((n[a] * 100 >= n[b] * percent) & (n[b] * 100 >= n[a] * percent))
    total = (n[a[at]] + n[b[at]]).astype(np.int64)
    apart = np.bitwise_count(short[a[at]] ^ short[b[at]]).sum(axis=1, dtype=np.int64)
    # 100 i >= p u with i = (s - d) / 2 and u = (s + d) / 2 for sizes' sum s and difference d.
    keep = apart * (100 + percent) <= total * (100 - percent)
    at, total, apart = at[keep], total[keep], apart[keep]
    common = np.minimum(words[a[at]], words[b[at]])
    for w in np.unique(common[common > BOUND_WORDS]):
        those = np.flatnonzero(common == w)
        for s in range(0, len(those), max(1, (1 << 20) // int(w))):
            part = those[s:s + max(1, (1 << 20) // int(w))]
            pair = []
            for side in (a[at[part]], b[at[part]]):
                got = np.empty((len(side), w), dtype=np.uint64)
                for own in np.unique(words[side]):
                    rows = np.flatnonzero(words[side] == own)
                    got[rows] = fold(values[starts[side[rows], None] + np.arange(own)], int(w))
                pair.append(got)
            apart[part] = np.bitwise_count(pair[0] ^ pair[1]).sum(axis=1, dtype=np.int64)
    keep = apart * (100 + percent) <= total * (100 - percent)
    return at[keep], apart[keep] / total[keep]


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)
