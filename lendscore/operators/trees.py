"""Boosted trees from histograms (the numpy part of M2 and M3).

Features are bins (small integers).  A tree is grown from sums per (node, feature, bin) of gradients,
hessians and rows alone, so the same growth serves rows in one task and rows of a whole cluster.

* Growth is best-first up to ``num_leaves`` leaves: the leaf with the largest gain splits next.  Sums are asked for
  many nodes at once: all leaves that best-first growth would reach with the gains known so far.
* Many models grow in step, so one scan gives the sums per (model, node, feature, bin) of all of them.
* Gain ``GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l)`` and leaf value ``-rate * G/(H+l)`` for L2 penalty ``l``.
* A nominal feature's categories are ordered by gradient over hessian in each node; a prefix of that order goes left.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np

#: Most bins of a feature; a code beyond them shares the last.
MAX_BINS = 64
#: Leaves of a tree, if not given.
NUM_LEAVES = 31
#: Least rows and hessian of a leaf; hessian added to order rare categories near the middle.
MIN_ROWS, MIN_HESSIAN, SMOOTH = 20, 1e-3, 10.0
#: A split that gains less than rounding is none.
MIN_GAIN = 1e-9


@dataclass
class Tree:
    """Node k splits on ``feature[k]`` (-1: leaf): bins in ``goes_left[k]`` go to ``left[k]``, others to ``right[k]``."""
    feature: np.ndarray
    goes_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaves(self, bins: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
        """The leaf of every row of ``bins`` below its ``start`` (node 0)."""
        node = np.zeros(len(bins), dtype=np.int32) if start is None else start.astype(np.int32)
        rows = np.arange(len(bins))
        while len(rows):
            at = node[rows]
            inner = self.feature[at] >= 0
            rows, at = rows[inner], at[inner]
            down = self.goes_left[at, bins[rows, self.feature[at]]]
            node[rows] = np.where(down, self.left[at], self.right[at])
        return node

    def parts(self, bins: np.ndarray, rows: np.ndarray, nodes: Sequence[int]) -> Iterator[tuple[int, np.ndarray]]:
        """``(node, its rows)`` of some ``nodes`` none of which is below another; only branches that lead to them are followed."""
        wanted, way = set(nodes), np.zeros(len(self.feature), bool)
        way[nodes] = True
        for k in range(len(way) - 1, -1, -1):  # children come after their parent
            way[k] |= self.feature[k] >= 0 and bool(way[self.left[k]] or way[self.right[k]])
        todo = [(0, rows)]
        while todo:
            k, rows = todo.pop()
            if k in wanted:
                yield k, rows
                continue
            down = self.goes_left[k][bins[:, self.feature[k]][rows]]
            if way[self.left[k]]:
                todo.append((int(self.left[k]), rows[down]))
            if way[self.right[k]]:
                todo.append((int(self.right[k]), rows[~down]))

    def to_json(self) -> dict:
        return {"feature": self.feature.tolist(), "left": self.left.tolist(), "right": self.right.tolist(),
                "value": self.value.tolist(),
                "goes_left": [np.packbits(g).tobytes().hex() if f >= 0 else "" for f, g in zip(self.feature, self.goes_left)]}

    @classmethod
    def from_json(cls, d: Mapping[str, Any], bins: int) -> Tree:
        goes = np.zeros((len(d["feature"]), bins), bool)
        for k, text in enumerate(d["goes_left"]):
            if text:
                goes[k] = np.unpackbits(np.frombuffer(bytes.fromhex(text), np.uint8), count=bins).astype(bool)
        return cls(np.array(d["feature"], np.int32), goes, np.array(d["left"], np.int32), np.array(d["right"], np.int32),
                   np.array(d["value"], float))


class Growth:
    """Trees while they grow, with common node numbers: the roots first, children of a split in a row."""

    def __init__(self, bins: int, roots: int = 1):
        self.feature, self.child = [-1] * roots, [-1] * roots
        self.goes_left = np.zeros((64 + 2 * roots, bins), bool)

    def split(self, node: int, feature: int, goes_left: np.ndarray) -> int:
        first = len(self.feature)
        self.feature[node], self.goes_left[node], self.child[node] = feature, goes_left, first
        self.feature += [-1, -1]
        self.child += [-1, -1]
        if len(self.feature) > len(self.goes_left):
            self.goes_left = np.concatenate([self.goes_left, np.zeros_like(self.goes_left)])
        return first

    def forest(self, models: Sequence[Model]) -> Tree:
        """All trees, cut to the splits decided on, in the common numbers."""
        n = len(self.feature)
        inner = np.zeros(n, bool)
        value = np.zeros(n)
        for m in models:
            inner[list(m.inner)] = True
            value[list(m.value)] = list(m.value.values())
        left = np.where(inner, np.array(self.child), -1).astype(np.int32)
        return Tree(np.where(inner, np.array(self.feature), -1).astype(np.int32), self.goes_left[:n], left, left + inner, value)


def one_tree(forest: Tree, root: int) -> Tree:
    """The tree of one root, its nodes numbered from 0."""
    order = [root]
    for k in order:
        if forest.feature[k] >= 0:
            order += [int(forest.left[k]), int(forest.right[k])]
    place = np.zeros(len(forest.feature), np.int32)
    place[order] = np.arange(len(order))
    inner = forest.feature[order] >= 0
    return Tree(forest.feature[order], forest.goes_left[order], np.where(inner, place[forest.left[order]], -1),
                np.where(inner, place[forest.right[order]], -1), forest.value[order])


class Layout:
    """Where each feature's bins lie in one row of sums: features of about the same number of bins, and of one
    kind, form a block of equal widths."""

    def __init__(self, widths: Sequence[int], nominal: Sequence[bool]):
        self.nominal = np.asarray(nominal, bool)
        self.width = np.array([max(4, 1 << (int(w) - 1).bit_length()) for w in widths])
        self.bins = int(self.width.max())
        self.offset = np.zeros(len(self.width), np.int64)
        self.blocks: list[tuple[np.ndarray, int, int, bool]] = []
        at = 0
        for kind in sorted(set(zip(self.width.tolist(), self.nominal.tolist()))):
            members = np.flatnonzero((self.width == kind[0]) & (self.nominal == kind[1]))
            self.offset[members] = at + np.arange(len(members)) * kind[0]
            self.blocks.append((members, at, kind[0], kind[1]))
            at += len(members) * kind[0]
        self.size = at

    def flat(self, binned: np.ndarray) -> np.ndarray:
        return binned.astype(np.int32) + self.offset.astype(np.int32)

    def of(self, sums: np.ndarray, feature: int) -> np.ndarray:
        return sums[..., self.offset[feature]:self.offset[feature] + self.width[feature]]


def best_splits(sums: np.ndarray, layout: Layout, l2: np.ndarray | float, min_rows: int = MIN_ROWS):
    """``(gain, feature, goes left)`` of the best split of each node, ``sums`` being (nodes, 3, all bins) of
    gradients, hessians and rows.  Ties: first feature, then fewest bins to the left."""
    n = len(sums)
    every = np.arange(n)
    gain, feature = np.full(n, -np.inf), np.full(n, len(layout.width))
    l2 = np.broadcast_to(np.asarray(l2, float), (n,))[:, None, None] + 1e-12
    goes = np.zeros((n, layout.bins), bool)
    total = layout.of(sums, 0).sum(axis=2)[:, :, None, None]
    whole = total[:, 0] ** 2 / (total[:, 1] + l2)
    for members, start, width, nominal in layout.blocks:
        own = sums[:, :, start:start + len(members) * width].reshape(n, 3, len(members), width)
        if nominal:
            rate = np.where(own[:, 2] > 0, own[:, 0] / (own[:, 1] + SMOOTH + 1e-12), np.inf)
            order = np.argsort(rate, axis=2, kind="stable")
            own = np.take_along_axis(own, order[:, None], axis=3)
        low = np.cumsum(own, axis=3)
        high = total - low
        fit = low[:, 0] ** 2 / (low[:, 1] + l2) + high[:, 0] ** 2 / (high[:, 1] + l2) - whole
        few = (np.minimum(low[:, 2], high[:, 2]) < min_rows) | (np.minimum(low[:, 1], high[:, 1]) < MIN_HESSIAN)
        fit[few] = -np.inf
        best = fit.reshape(n, -1).argmax(axis=1)
        place, cut = best // width, best % width
        fit = fit[every, place, cut]
        # Sums differ in their last bits with the order of rows, so near ties go to the first feature.
        near = 1e-9 * np.maximum(1.0, np.abs(np.where(np.isfinite(fit), fit, 0.0)))
        better = (fit > gain + near) | (np.isfinite(fit) & (fit >= gain - near) & (members[place] < feature))
        rows = np.flatnonzero(better)
        gain[rows], feature[rows] = fit[rows], members[place[rows]]
        goes[rows] = False
        left = np.arange(width) <= cut[rows, None]
        if nominal:
            chosen = np.zeros_like(left)
            np.put_along_axis(chosen, order[rows, place[rows]], left, axis=1)
            left = chosen
        goes[rows, :width] = left
    return gain, feature, goes


class Model:
    """One tree of a model: what it has decided so far."""

    def __init__(self, root: int, num_leaves: int = NUM_LEAVES, l2: float = 0.0, rate: float = 1.0):
        self.root, self.num_leaves, self.l2, self.rate = root, num_leaves, l2, rate
        self.split: dict[int, tuple[float, int, np.ndarray]] = {}
        self.value: dict[int, float] = {}
        #: Splits that are certain, the leaves they give, and the gains of those leaves.
        self.inner: set[int] = set()
        self.leaves, self.heap = 1, None

    def next_splits(self, growth: Growth) -> list[int]:
        """Nodes that best-first growth splits, by the gains known, and that are not split yet."""
        child, split, push, pop = growth.child, self.split, heapq.heappush, heapq.heappop
        if self.heap is None:
            self.heap = [(-split[self.root][0], self.root)]
        heap = self.heap
        while heap and self.leaves < self.num_leaves and heap[0][0] <= -MIN_GAIN and child[heap[0][1]] >= 0:
            _, k = pop(heap)
            self.leaves += 1
            self.inner.add(k)
            for c in (child[k], child[k] + 1):
                push(heap, (-split[c][0], c))
        wanted, heap, leaves = [], heap.copy(), self.leaves
        while heap and leaves < self.num_leaves and heap[0][0] <= -MIN_GAIN:
            _, k = pop(heap)
            leaves += 1
            if child[k] < 0:
                wanted.append(k)
            else:
                for c in (child[k], child[k] + 1):
                    push(heap, (-split[c][0], c))
        return wanted


def grow(sums_of: Callable[[Growth, list[int]], np.ndarray], layout: Layout, models: Sequence[Model],
         min_rows: int = MIN_ROWS, roots: int | None = None) -> Tree:
    """Best-first trees of all ``models``, in step, as one forest of as many ``roots`` (default: one per model);
    ``sums_of(growth, nodes)`` gives the sums of some nodes."""
    growth = Growth(layout.bins, roots or len(models))
    sums: dict[int, np.ndarray] = {}

    def decide(nodes: list[tuple[Model, int]]) -> None:
        stacked = np.stack([sums[k] for _, k in nodes])
        gain, feature, goes = best_splits(stacked, layout, np.array([m.l2 for m, _ in nodes]), min_rows)
        totals = layout.of(stacked, 0)[:, :2].sum(axis=2)
        for i, (m, k) in enumerate(nodes):
            m.split[k] = gain[i], int(feature[i]), goes[i]
            g, h = totals[i]
            m.value[k] = -m.rate * g / (h + m.l2) if h + m.l2 > 0 else 0.0

    first = [m.root for m in models]
    sums.update(zip(first, sums_of(growth, first)))
    decide([(m, m.root) for m in models])
    live = list(models)
    while live:
        todo, less = [], []
        for m in live:
            todo += [(m, k) for k in m.next_splits(growth)]
        for m, k in todo:
            _, feature, goes = m.split[k]
            left = growth.split(k, feature, goes)
            own = layout.of(sums[k][2], feature)
            less.append(left if own[goes[:len(own)]].sum() * 2 <= own.sum() else left + 1)
        if not todo:
            break
        for (_, k), c, got in zip(todo, less, sums_of(growth, less)):
            sums[c] = got
            sums[2 * growth.child[k] + 1 - c] = sums.pop(k) - got  # the sibling has the rest
        decide([(m, c) for m, k in todo for c in (growth.child[k], growth.child[k] + 1)])
        live = list(dict.fromkeys(m for m, _ in todo))
    return growth.forest(models)


# --- rows of one task --------------------------------------------------------------
def add_sums(out: np.ndarray, flat: np.ndarray, slot: np.ndarray, gradient: np.ndarray, hessian: np.ndarray) -> None:
    """Add rows to ``out`` (slots, 3, all bins); ``flat`` has their bins' places."""
    size = out.shape[2]
    at = (flat + (slot * size).astype(np.int32)[:, None]).ravel()
    many = flat.shape[1]
    for part, weights in enumerate((gradient, hessian, None)):
        got = np.bincount(at, None if weights is None else np.repeat(weights, many), len(out) * size)
        out[:, part] += got.reshape(len(out), size)


def add_columns(out: np.ndarray, layout: Layout, bins: np.ndarray, rows: np.ndarray, slot: np.ndarray, gradient: np.ndarray,
                hessian: np.ndarray) -> None:
    """:func:`add_sums` of some ``rows`` of ``bins``, feature by feature: bins of one feature should lie side by side."""
    for f, (start, width) in enumerate(zip(layout.offset.tolist(), layout.width.tolist())):
        at = slot * width + bins[:, f][rows]
        for part, weights in enumerate((gradient, hessian, None)):
            out[:, part, start:start + width] += np.bincount(at, weights, len(out) * width).reshape(len(out), width)


class LocalRows:
    """Sums of rows held in one task, ``owner`` being the model of each; a row's node is kept while its tree grows."""

    def __init__(self, binned: np.ndarray, layout: Layout, owner: np.ndarray):
        self.binned, self.layout, self.flat, self.owner = binned, layout, layout.flat(binned), owner

    def start(self, gradient: np.ndarray, hessian: np.ndarray, used: np.ndarray) -> None:
        """``used``: places of the rows that the next trees see."""
        self.used = used
        self.gradient, self.hessian = gradient[used], hessian[used]
        self.node = self.owner[used].astype(np.int32)

    def __call__(self, growth: Growth, nodes: list[int]) -> np.ndarray:
        child, feature = np.array(growth.child, np.int32), np.array(growth.feature, np.int32)
        moved = np.flatnonzero(child[self.node] >= 0)
        if len(moved):
            at = self.node[moved]
            down = growth.goes_left[at, self.binned[self.used[moved], feature[at]]]
            self.node[moved] = child[at] + ~down
        slot = np.full(len(child), -1)
        slot[nodes] = np.arange(len(nodes))
        own = slot[self.node]
        rows = np.flatnonzero(own >= 0)
        out = np.zeros((len(nodes), 3, self.layout.size))
        add_sums(out, self.flat[self.used[rows]], own[rows], self.gradient[rows], self.hessian[rows])
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def log_odds(share: float) -> float:
    share = min(max(share, 1e-15), 1 - 1e-15)
    return float(np.log(share / (1 - share)))


def share_of_rows(n: int, share: float, *seed: int) -> np.ndarray:
    """Places of the rows that a tree sees."""
    if share >= 1.0:
        return np.arange(n)
    return np.flatnonzero(np.random.default_rng(seed).random(n) < share)


def boost(samples: Sequence[tuple[np.ndarray, np.ndarray]], layout: Layout, params: Sequence[Mapping[str, Any]], seed: int,
          others: Sequence[np.ndarray] = (), keys: Sequence[Sequence[int]] | None = None) -> tuple[list[list[Tree]], list[np.ndarray]]:
    """Models fitted in step on the ``(bins, 0/1 labels)`` of one task each, with ``params`` of their own: their trees
    (none kept, if there are ``others``), or the raw scores of ``others``, one set of rows per model.  The rows a
    model's trees see are drawn by seed and its own ``keys``, whatever models it is fitted with."""
    owner = np.repeat(np.arange(len(samples)), [len(y) for _, y in samples])
    n, y = len(owner), np.concatenate([y for _, y in samples]).astype(float)
    every = np.concatenate([*[b for b, _ in samples], *others])
    whose = np.concatenate([owner, np.repeat(np.arange(len(others)), [len(o) for o in others])]).astype(np.int32)
    rows = LocalRows(every[:n], layout, owner)
    raw = np.array([log_odds(float(np.mean(own))) for _, own in samples])[whose]
    trees: list[list[Tree]] = [[] for _ in samples]
    until = np.array([int(p["n_estimators"]) for p in params])
    first = np.cumsum([0, *[len(y) for _, y in samples]])
    keys = keys or [()] * len(samples)
    for t in range(until.max()):
        live = np.flatnonzero(until > t)
        p = sigmoid(raw[:n])
        used = [first[m] + share_of_rows(first[m + 1] - first[m], float(params[m].get("subsample", 1.0)), seed, t, *keys[m]) for m in live]
        rows.start(p - y, p * (1 - p), np.concatenate(used))
        models = [Model(m, int(params[m].get("num_leaves", NUM_LEAVES)), float(params[m].get("reg_lambda", 0.0)),
                        float(params[m]["learning_rate"])) for m in live.tolist()]
        forest = grow(rows, layout, models, roots=len(samples))
        raw += forest.value[forest.leaves(every, whose)]
        if not others:
            for m in live.tolist():
                trees[m].append(one_tree(forest, m))
    ends = np.cumsum([len(o) for o in others])
    return trees, [raw[n + e - len(o):n + e] for e, o in zip(ends, others)]


def average_precision(y: np.ndarray, score: np.ndarray) -> float:
    """Sum over distinct thresholds of recall steps times precision; NaN without positives."""
    order = np.argsort(-score, kind="stable")
    y, score = y[order], score[order]
    last = np.flatnonzero(np.r_[score[1:] != score[:-1], True])
    tp = np.cumsum(y)[last]
    if not len(y) or tp[-1] == 0:
        return float("nan")
    return float(np.sum(np.diff(np.r_[0, tp]) * tp / (last + 1)) / tp[-1])


# --- bins ---------------------------------------------------------------------------
def cut_points(values: np.ndarray, bins: int = MAX_BINS) -> np.ndarray:
    """Upper bounds of the bins of a number: its values, if few, else quantiles that are values."""
    known = np.unique(values[~np.isnan(values)])
    if len(known) <= bins:
        return known[:-1]
    return np.unique(np.quantile(values[~np.isnan(values)], np.arange(1, bins) / bins, method="inverted_cdf"))


def to_bins(values: np.ndarray, cuts: np.ndarray | None, bins: int = MAX_BINS) -> np.ndarray:
    """Bins of a number (those up to a cut are in its bin), or of a nominal code (-1 is bin 0)."""
    if cuts is None:
        return np.clip(np.nan_to_num(values, nan=-1.0) + 1, 0, bins - 1).astype(np.uint8)
    return np.searchsorted(cuts, np.nan_to_num(values, nan=-np.inf), side="left").astype(np.uint8)
