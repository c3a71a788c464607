"""Second-order boosting on histograms: leaf-wise or symmetric trees.

Features are binned once (a byte each) and staged. A tree grows best leaf first, by the gain
of sums of gradients and hessians per bin. Nodes with more than ``local_rows`` rows are split
from histograms that all tasks add up, the smaller child of a pair only; its sibling is what
is left of the parent. Nodes with fewer rows are brought together, one task a node, and
their whole subtree grows there. Best-first order inside a subtree is that of the whole tree,
so the driver, which sees one line per split, picks the same splits whichever way they
were found. It holds histograms of at most ``leaves`` nodes, whatever the size of the table.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.shipping import ship
from tillroll.sources.workspace import discard, stage

LOCAL_ROWS = 1 << 17
ROUNDS = 50  # trees grown in one job if all rows are in one node
RESCORED = 3  # trees between two writes of the scores; those since the last are scored in every job
FEW_ROWS = 1024  # up to so many the columns of a node are added up together
MANY_ROWS = 1 << 12  # from so many on columns are counted together
GROUP_CELLS = 1 << 14  # columns that have fewer cells together are counted in one go
LEVEL_CELLS = 1 << 17  # cells of the nodes of a level that are searched together
MANY_CELLS = 1 << 22  # cells of a level that lie in memory together
BLOCK = 1 << 15  # rows of the staged table that lie in one record, column by column
BLOCKS = 32  # records of a file at most
LEAST = 0.25  # of the least gain of a tree that ends by its leaves: smaller ones of the next wait
GUESSED = 64  # nodes at the top of a tree that are taken over as a guess for the next
GATHERED = 1 << 25  # bytes of histograms that are sent to the driver without being added up before
MISSING = 0  # the bin of nulls, and of levels that training has not seen


@dataclass(frozen=True)
class Settings:
    trees: int = 300
    leaves: int = 1000
    depth: int | None = None
    symmetric: bool = False
    learning_rate: float = 0.01
    l2: float = 0.5
    l1: float = 0.0
    subsample: float = 0.5
    column_share: float = 1.0
    min_rows: int = 20
    min_hessian: float = 1e-3
    max_bins: int = 255
    stopping: int = 50
    seed: int = 42
    local_rows: int = LOCAL_ROWS


@dataclass
class Binning:
    """How columns become bytes: ``edges`` of numbers (bin i holds values up to edge i - 1),
    ``levels`` of nominal columns."""

    names: list[str]
    edges: dict[str, list[float]]
    levels: dict[str, list]

    @property
    def sizes(self) -> np.ndarray:
        return np.array([len(self.edges[c]) + 2 if c in self.edges else len(self.levels[c]) + 1 for c in self.names])

    @property
    def nominal(self) -> np.ndarray:
        return np.array([c in self.levels for c in self.names])

    def apply(self, batch: pa.RecordBatch) -> np.ndarray:
        out = np.zeros((batch.num_rows, len(self.names)), np.uint8, order="F")
        for i, c in enumerate(self.names):
            column = batch.column(batch.schema.get_field_index(c))
            if c in self.edges:
                x = column.cast(pa.float64()).to_numpy(zero_copy_only=False)
                out[:, i] = np.where(np.isnan(x), MISSING, 1 + np.searchsorted(self.edges[c], x, "left"))
            else:
                code = {v: j for j, v in enumerate(self.levels[c], 1)}
                out[:, i] = [code.get(v, MISSING) for v in column.to_pylist()]
        return out


def fit_binning(df: DataFrame, names: Sequence[str], nominal: Sequence[str], max_bins: int) -> Binning:
    """Quantile bins of numbers (all distinct values, if they are few); nominal columns keep a
    bin per level. More than 255 levels are an error."""
    numbers = [c for c in names if c not in nominal]
    probabilities = [i / (max_bins - 1) for i in range(1, max_bins - 1)]
    found = df.approxQuantile(numbers, probabilities, 0.25 / max_bins) if numbers else []
    levels = {}
    for c in (c for c in names if c in nominal):
        # one row more than a byte can name tells that there are too many
        rows = df.select(c).where(F.col(c).isNotNull()).distinct().limit(256).collect()
        if len(rows) > 255:
            raise ValueError(f"{c} has more than 255 levels")
        levels[c] = sorted(r[0] for r in rows)
    return Binning(list(names), {c: sorted(set(q)) for c, q in zip(numbers, found)}, levels)


# ---- splits of a node ---------------------------------------------------------------------


@dataclass
class Split:
    gain: float
    feature: int
    left: np.ndarray  # which bins go left
    sums: np.ndarray  # (2, 3): gradient, hessian, rows of either side


class Search:
    """Best splits from histograms: (3, cells) sums of gradient, hessian and rows per bin of the
    features searched (all, or those of ``columns``)."""

    def __init__(self, binning: Binning, s: Settings, columns: np.ndarray | None = None):
        self.s, self._binning = s, binning
        self.columns = np.arange(len(binning.names)) if columns is None else columns
        self.sizes, self.nominal = binning.sizes[self.columns], binning.nominal[self.columns]
        self.start = np.cumsum([0, *self.sizes[:-1]])
        self.cells = int(self.sizes.sum())
        self._of = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self._last = np.zeros(self.cells, bool)
        self._last[self.start + self.sizes - 1] = True
        self._groups: dict[int, list[list[int]]] = {}

    def on(self, columns: np.ndarray | None) -> Search:
        return self if columns is None else Search(self._binning, self.s, columns)

    def histogram(self, bins: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        if len(bins) > FEW_ROWS:
            return self.histograms(bins, g, h, apart=True)[0]
        by_column = bins.T[self.columns]
        code = (by_column + self.start[:, None]).ravel()
        m = len(by_column)
        weights = (np.tile(g, m), np.tile(h, m), None)
        return np.array([np.bincount(code, w, self.cells) for w in weights])

    def histograms(self, bins: np.ndarray, g: np.ndarray, h: np.ndarray, place: np.ndarray | None = None, nodes: int = 1, counts: bool = True, apart: bool = False) -> np.ndarray:
        """(nodes, 3, cells); ``place`` is the node of each row. Without ``counts`` rows are 0;
        ``apart``: columns are counted one by one, so a bin is added up in the order of the rows."""
        out = np.zeros((nodes, 3, self.cells))
        for group in self._grouped(1 if apart or len(bins) < MANY_ROWS else GROUP_CELLS // nodes):
            code = np.zeros(len(bins), np.intp) if place is None else place.astype(np.intp)
            for f in group:
                code *= self.sizes[f]
                code += bins[:, self.columns[f]]
            shape = (nodes, *self.sizes[group])
            for i, w in enumerate((g, h, None) if counts else (g, h)):
                joint = np.bincount(code, w, int(np.prod(shape))).reshape(shape)
                for j, f in enumerate(group):
                    others = tuple(k + 1 for k in range(len(group)) if k != j)
                    out[:, i, self.start[f] : self.start[f] + self.sizes[f]] = joint.sum(others) if others else joint
        return out

    def _grouped(self, most: int) -> list[list[int]]:
        """Features that are counted in one go: together they have ``most`` cells at most."""
        if most not in self._groups:
            groups, cells = [], []
            for f in np.argsort(-self.sizes, kind="stable"):
                fits = [i for i, c in enumerate(cells) if c * self.sizes[f] <= most]
                if fits:
                    groups[fits[0]].append(int(f))
                    cells[fits[0]] *= int(self.sizes[f])
                else:
                    groups.append([int(f)])
                    cells.append(int(self.sizes[f]))
            self._groups[most] = groups
        return self._groups[most]

    def _score(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        g = np.maximum(np.abs(g) - self.s.l1, 0)
        return g * g / (h + self.s.l2 + 1e-12)

    def gains(self, hist: np.ndarray, order: np.ndarray | None = None, free: bool = False) -> np.ndarray:
        """Gain of a cut after each cell, -inf where it is not allowed; ``free``: sides may be empty.
        Also for many nodes at once."""
        if order is not None:
            hist = hist[..., order]
        run = np.cumsum(hist, axis=-1)
        base = run[..., self.start] - hist[..., self.start]
        left = run - base[..., self._of]
        total = left[..., self.sizes[0] - 1 : self.sizes[0]]
        right = total - left
        part = lambda x, i: x[..., i, :]
        gain = self._score(part(left, 0), part(left, 1)) + self._score(part(right, 0), part(right, 1))
        gain -= self._score(part(total, 0), part(total, 1))
        if free:
            allowed = ~self._last
        else:
            low = np.minimum(left, right)
            allowed = (part(low, 2) >= self.s.min_rows) & (part(low, 1) >= self.s.min_hessian) & ~self._last
        return np.where(allowed, gain, -np.inf)

    def order(self, hist: np.ndarray) -> np.ndarray | None:
        """Cells with the bins of nominal features by their mean gradient."""
        if not self.nominal.any():
            return None
        order = np.arange(self.cells)
        for f in np.flatnonzero(self.nominal):
            own = slice(self.start[f], self.start[f] + self.sizes[f])
            mean = np.where(hist[2, own] > 0, hist[0, own] / (hist[1, own] + 1.0), np.inf)
            order[own] = self.start[f] + np.argsort(mean, kind="stable")
        return order

    @staticmethod
    def first_best(gain: np.ndarray) -> int | None:
        """The first cut of the largest gain; gains that differ by rounding alone are equal."""
        most = gain.max()
        return int(np.argmax(gain >= most * (1 - 1e-9))) if most > 1e-12 else None

    def best(self, hist: np.ndarray) -> Split | None:
        order = self.order(hist)
        return self._cut(hist, order, self.gains(hist, order))

    def best_of_many(self, hists: np.ndarray) -> list[Split | None]:
        if self.nominal.any():
            return [self.best(hist) for hist in hists]
        return [self._cut(hist, None, gain) for hist, gain in zip(hists, self.gains(hists))]

    def _cut(self, hist: np.ndarray, order: np.ndarray | None, gain: np.ndarray) -> Split | None:
        at = self.first_best(gain)
        if at is None:
            return None
        f = int(self._of[at])
        cells = np.arange(self.start[f], at + 1) if order is None else order[self.start[f] : at + 1]
        return self.split(hist, f, cells - self.start[f], float(gain[at]))

    def split(self, hist: np.ndarray, f: int, lefts: np.ndarray, gain: float) -> Split:
        left = np.zeros(256, bool)
        left[lefts] = True
        own = hist[:, self.start[f] : self.start[f] + self.sizes[f]]
        a = own[:, left[: self.sizes[f]]].sum(1)
        return Split(gain, int(self.columns[f]), left, np.array([a, own.sum(1) - a]))


# ---- trees ----------------------------------------------------------------------------------


@dataclass
class Tree:
    """Node 0 is the root; ``feature`` is -1 at leaves. ``left`` has 256 bits per node."""

    feature: np.ndarray
    left: np.ndarray
    children: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def leaf(self, bins: np.ndarray) -> np.ndarray:
        n, flat = len(bins), bins.T.ravel()  # column by column, as blocks lie
        out, at = np.zeros(n, np.int64), np.arange(n)
        node = out.copy()
        # the child of each node for each bin
        lefts = np.unpackbits(self.left, axis=1).astype(bool)
        child = np.where(lefts, self.children[:, :1], self.children[:, 1:]).ravel()
        while len(at):
            f = self.feature[node]
            inner = f >= 0
            if not inner.all():
                out[at[~inner]] = node[~inner]
                at, node, f = at[inner], node[inner], f[inner]
            node = child[(node << 8) + flat[f * n + at]]
        return out

    def score(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.leaf(bins)]

    def score_even(self, bins: np.ndarray) -> np.ndarray:
        """The same for a symmetric tree: all nodes of a level are cut alike."""
        nodes, at = np.zeros(1, np.int64), np.zeros(len(bins), np.int64)
        while (f := self.feature[nodes[0]]) >= 0:
            right = ~np.unpackbits(self.left[nodes[0]]).astype(bool)
            at <<= 1
            at += right[bins[:, f]]
            nodes = self.children[nodes].ravel()
        return self.value[nodes][at]


class Growing:
    """Splits that are known so far. A node is None if it cannot be split, absent if unknown."""

    def __init__(self, root: np.ndarray):
        self.sums = [root]
        self.splits: dict[int, Split | None] = {}
        self.children: dict[int, tuple[int, int]] = {}
        self.depth = [0]

    def put(self, node: int, split: Split | None) -> None:
        self.splits[node] = split
        if split is not None:
            self.children[node] = (len(self.sums), len(self.sums) + 1)
            self.sums += list(split.sums)
            self.depth += [self.depth[node] + 1] * 2

    def splittable(self, node: int, s: Settings) -> bool:
        if s.symmetric:
            return node in self.splits
        return (s.depth is None or self.depth[node] < s.depth) and self.sums[node][2] >= 2 * s.min_rows

    def walk(self, s: Settings) -> tuple[list[int], list[int]]:
        """(nodes split, in best-first order; nodes whose split has to be known first)."""
        done, unknown, heap = [], [], []

        def push(node: int) -> None:
            if not self.splittable(node, s):
                return
            if node not in self.splits:
                unknown.append(node)
            elif self.splits[node] is not None:
                heapq.heappush(heap, (-self.splits[node].gain, node))

        push(0)
        while heap and (s.symmetric or len(done) + 1 < s.leaves):
            node = heapq.heappop(heap)[1]
            done.append(node)
            for child in self.children[node]:
                push(child)
        return done, unknown

    def tree(self, done: Sequence[int], s: Settings) -> Tree:
        nodes = [0, *(c for n in done for c in self.children[n])]
        place = {n: i for i, n in enumerate(nodes)}
        t = Tree(
            np.full(len(nodes), -1), np.zeros((len(nodes), 32), np.uint8), np.zeros((len(nodes), 2), np.int64),
            np.zeros(len(nodes)), np.zeros(len(nodes)),
        )
        for n in done:
            i, split = place[n], self.splits[n]
            t.feature[i], t.left[i], t.gain[i] = split.feature, np.packbits(split.left), split.gain
            t.children[i] = [place[c] for c in self.children[n]]
        g, h, _ = np.array([self.sums[n] for n in nodes]).T
        t.value = -s.learning_rate * np.sign(g) * np.maximum(np.abs(g) - s.l1, 0) / (h + s.l2 + 1e-12)
        return t


def _take(bins: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Some rows, column by column in memory."""
    return bins.T[:, rows].T


def _part(bins: np.ndarray, rows: np.ndarray, split: Split) -> tuple[np.ndarray, np.ndarray]:
    left = split.left[bins[rows, split.feature]]
    return rows[left], rows[~left]


def grow(
    search: Search, s: Settings, bins: np.ndarray, g: np.ndarray, h: np.ndarray, features: np.ndarray | None, depth: int = 0, floor: float = 0.0
) -> Growing:
    """Best-first growth over rows that are all at hand, from a node at ``depth``. Splits of a
    smaller gain than ``floor`` are found, but what lies below them is left unknown."""
    search = search.on(features)
    if s.depth is not None and s.leaves >= 1 << s.depth and not floor:
        return grow_levels(search, s, bins, g, h, depth)
    return grow_leaves(search, s, bins, g, h, depth, floor)


def grow_leaves(search: Search, s: Settings, bins: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int = 0, floor: float = 0.0) -> Growing:
    """Growth leaf by leaf."""
    out = Growing(np.array([g.sum(), h.sum(), len(g)]))
    out.depth[0] = depth
    rows, hists, heap = {0: np.arange(len(g))}, {0: search.histogram(bins, g, h)}, []

    def look(node: int) -> None:
        if out.splittable(node, s):
            out.put(node, search.best(hists[node]))
            if out.splits[node] is not None:
                heapq.heappush(heap, (-out.splits[node].gain, node))
                return
        del rows[node], hists[node]

    look(0)
    for _ in range(s.leaves - 1):
        if not heap or -heap[0][0] < floor:
            break
        node = heapq.heappop(heap)[1]
        a, b = out.children[node]
        rows[a], rows[b] = _part(bins, rows.pop(node), out.splits[node])
        small, large = (a, b) if len(rows[a]) <= len(rows[b]) else (b, a)
        own = rows[small]
        hists[small] = search.histogram(_take(bins, own), g[own], h[own])
        hists[large] = hists.pop(node) - hists[small]
        look(a)
        look(b)
    return out


def _halves(
    search: Search, bins: np.ndarray, g: np.ndarray, h: np.ndarray, place: np.ndarray, parents: np.ndarray, counts: bool = True
) -> np.ndarray:
    """Histograms of the children of some nodes, which lie at 2 i and 2 i + 1: the smaller child
    of a pair is counted, the other is what is left of the parent."""
    pairs = len(parents)
    less = np.bincount(place, minlength=2 * pairs).reshape(-1, 2).argmin(1)
    small = np.zeros((pairs, 2), bool)
    small[np.arange(pairs), less] = True
    at = np.flatnonzero(small.ravel()[place])
    counted = search.histograms(_take(bins, at), g[at], h[at], place[at] >> 1, pairs, counts)
    out = np.empty((pairs, 2, *parents.shape[1:]))
    out[np.arange(pairs), less] = counted
    out[np.arange(pairs), 1 - less] = parents - counted
    return out.reshape(2 * pairs, *parents.shape[1:])


def grow_levels(search: Search, s: Settings, bins: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int = 0) -> Growing:
    """Growth where the depth alone ends it: no order of splits matters, so a level is cut at once."""
    out = Growing(np.array([g.sum(), h.sum(), len(g)]))
    out.depth[0] = depth
    level, place, hists = [0], np.zeros(len(g), np.int64), search.histograms(bins, g, h)
    step = max(1, LEVEL_CELLS // search.cells)
    while level:
        splits: list[Split | None] = []
        for i in range(0, len(level), step):
            splits += search.best_of_many(hists[i : i + step])
        look = [out.splittable(node, s) for node in level]
        for i, node in enumerate(level):
            if look[i]:
                out.put(node, splits[i])
        cut = [i for i, split in enumerate(splits) if look[i] and split is not None]
        new, feature, left = np.full(len(level), -1), np.zeros(len(level), np.int64), np.zeros((len(level), 256), bool)
        new[cut] = 2 * np.arange(len(cut))
        for i in cut:
            feature[i], left[i] = splits[i].feature, splits[i].left
        at = np.flatnonzero(new[place] >= 0)
        if len(at) < len(place):
            place, bins, g, h = place[at], _take(bins, at), g[at], h[at]
        goes = left.ravel()[(place << 8) + bins.T.ravel()[feature[place] * len(place) + np.arange(len(place))]]
        place, level = new[place] + ~goes, [c for i in cut for c in out.children[level[i]]]
        if not any(out.splittable(node, s) for node in level):
            break
        if len(level) * search.cells > MANY_CELLS:
            _grow_apart(search, s, bins, g, h, out, level, place)
            break
        hists = _halves(search, bins, g, h, place, hists[cut])
    return out


def _grow_apart(search: Search, s: Settings, bins: np.ndarray, g: np.ndarray, h: np.ndarray, out: Growing, level: list[int], place: np.ndarray) -> None:
    """The subtrees of a level one after the other, where its histograms would take much memory together."""
    order = np.argsort(place, kind="stable")
    ends = np.searchsorted(place[order], np.arange(len(level) + 1))
    for node, lo, hi in zip(level, ends, ends[1:]):
        if out.splittable(node, s):
            at = order[lo:hi]
            _graft(out, node, list(grow_leaves(search, s, _take(bins, at), g[at], h[at], out.depth[node]).splits.items()))


def common_split(search: Search, hists: np.ndarray) -> list[Split] | None:
    """The cut with the largest gain summed over all nodes of a level, as a split of each."""
    step = max(1, LEVEL_CELLS // search.cells)
    gain = sum(search.gains(hists[i : i + step], free=True).sum(0) for i in range(0, len(hists), step))
    at = search.first_best(gain)
    if at is None:
        return None
    f = int(search._of[at])
    lefts = np.arange(at + 1 - search.start[f])
    return [search.split(hist, f, lefts, float(gain[at])) for hist in hists]


def grow_level(out: Growing, level: list[int], splits: list[Split]) -> list[int]:
    for node, split in zip(level, splits):
        out.put(node, split)
    return [c for node in level for c in out.children[node]]


def grow_symmetric(search: Search, s: Settings, bins: np.ndarray, g: np.ndarray, h: np.ndarray, features: np.ndarray | None) -> Growing:
    """All nodes of a level are cut alike."""
    search = search.on(features)
    out = Growing(np.array([g.sum(), h.sum(), len(g)]))
    level, place = [0], np.zeros(len(g), np.int64)
    hists = search.histograms(bins, g, h, counts=False)
    for depth in range(s.depth or 0):
        splits = common_split(search, hists)
        if splits is None:
            break
        level = grow_level(out, level, splits)
        if depth + 1 < s.depth:
            place = 2 * place + ~splits[0].left[bins[:, splits[0].feature]]
            hists = _halves(search, bins, g, h, place, hists, counts=False)
    return out


# ---- boosting ---------------------------------------------------------------------------------


@dataclass
class Boosted:
    """A fitted model; scores are log-odds."""

    binning: Binning
    settings: Settings
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)  # of the evaluation rows, tree by tree

    def score(self, bins: np.ndarray, first: int = 0) -> np.ndarray:
        out = np.zeros(len(bins))
        for t in self.trees[first:]:
            out += t.score_even(bins) if self.settings.symmetric else t.score(bins)
        return out

    def importance(self) -> list[tuple[str, float]]:
        """(feature, share of all gain), highest first."""
        total = np.zeros(len(self.binning.names))
        for t in self.trees:
            at = t.feature >= 0
            np.add.at(total, t.feature[at], t.gain[at])
        share = total / max(total.sum(), 1e-300)
        return sorted(zip(self.binning.names, map(float, share)), key=lambda x: (-x[1], x[0]))


@dataclass
class Rows:
    """Rows of the staged table."""

    row: np.ndarray
    bins: np.ndarray  # a column lies together in memory
    y: np.ndarray
    w: np.ndarray
    held: np.ndarray
    score: np.ndarray

    def derive(self) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and hessian of the logistic loss."""
        p = 1 / (1 + np.exp(-self.score))
        return self.w * (p - self.y), self.w * p * (1 - p)

    def loss(self) -> tuple[float, float]:
        """Weighted logistic loss of the evaluation rows, and their weight."""
        z, y, w = self.score[self.held], self.y[self.held], self.w[self.held]
        return float((w * (np.logaddexp(0, z) - y * z)).sum()), float(w.sum())


_COLUMNS = ["row", "bins", "y", "w", "score"]
_STATE = "block long, part int, held boolean, " + ", ".join(f"{c} binary" for c in _COLUMNS)
_STATE_ARROW = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("held", pa.bool_()), *((c, pa.binary()) for c in _COLUMNS)])


def _rows(b: pa.RecordBatch, i: int, features: int) -> Rows:
    """The rows of a block."""
    row, bins, y, w, score = (b.column(3 + k)[i].as_buffer() for k in range(5))
    row = np.frombuffer(row, np.int64)
    n = len(row)
    y = np.frombuffer(y, np.uint8 if len(y) == n else float)
    w = np.full(n, np.frombuffer(w)[0]) if len(w) == 8 else np.frombuffer(w)
    return Rows(row, np.frombuffer(bins, np.uint8).reshape(features, -1).T, y, w, np.full(n, b.column(2)[i].as_py()), np.frombuffer(score))


def _blocks(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[Rows]:
    for b in batches:
        for i in range(b.num_rows):
            yield _rows(b, i, features)


def _drawn(s: Settings, row: np.ndarray, tree: int) -> np.ndarray:
    """Whether a tree learns from a row: a hash of both, the same wherever the row is read."""
    with np.errstate(over="ignore"):
        x = (row.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= np.uint64((tree + 1) * 0xD1B54A32D192ED03 + s.seed & (1 << 64) - 1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) < np.uint64(min(int(s.subsample * 2**64), 2**64 - 1))


def _columns_of(s: Settings, features: int, tree: int) -> np.ndarray | None:
    if s.column_share >= 1:
        return None
    n = max(1, round(s.column_share * features))
    return np.sort(np.random.default_rng((s.seed, tree)).choice(features, n, replace=False))


def _tree_row(t: Tree, loss: float | None) -> dict:
    return {
        "feature": t.feature.tolist(), "left": t.left.tobytes(), "children": t.children.ravel().tolist(),
        "value": t.value.tolist(), "gain": t.gain.tolist(), "loss": loss,
    }


_TREE = "feature array<long>, left binary, children array<long>, value array<double>, gain array<double>, loss double"
_TREE_ARROW = pa.schema(
    [("feature", pa.list_(pa.int64())), ("left", pa.binary()), ("children", pa.list_(pa.int64())),
     ("value", pa.list_(pa.float64())), ("gain", pa.list_(pa.float64())), ("loss", pa.float64())]
)


def _tree_of(r) -> Tree:
    return Tree(
        np.array(r.feature, np.int64), np.frombuffer(bytes(r.left), np.uint8).reshape(-1, 32),
        np.array(r.children, np.int64).reshape(-1, 2), np.array(r.value), np.array(r.gain),
    )


def _stale(losses: Sequence[float], patience: int) -> bool:
    return len(losses) > 0 and len(losses) - 1 - int(np.argmin(losses)) >= patience


def _since(m: Boosted, since: int) -> Boosted:
    """The trees that the staged scores do not hold yet; tasks need no others."""
    return Boosted(m.binning, m.settings, m.base, m.trees[since:])


def _rounds(state: DataFrame, m: Boosted, since: int, rounds: int) -> list:
    """The next trees, all in one task: the whole table is smaller than a node that is grown so."""
    s, done, features, losses = m.settings, len(m.trees), len(m.binning.names), list(m.losses)
    late = _since(m, since)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(_blocks(batches, features))
        if not parts:
            return
        order = np.argsort(np.concatenate([p.row for p in parts]), kind="stable")
        r = Rows(*(np.concatenate([getattr(p, c).T for p in parts], -1)[..., order].T for c in ("row", "bins", "y", "w", "held", "score")))
        del parts
        r.score = r.score + late.score(r.bins)
        search, out = Search(late.binning, s), []
        for t in range(done, done + rounds):
            g, h = r.derive()
            at = np.flatnonzero(~r.held & _drawn(s, r.row, t))
            how = grow_symmetric if s.symmetric else grow
            grown = how(search, s, _take(r.bins, at), g[at], h[at], _columns_of(s, features, t))
            tree = grown.tree(grown.walk(s)[0], s)
            r.score += tree.score_even(r.bins) if s.symmetric else tree.score(r.bins)
            if r.held.any():
                losses.append(r.loss()[0] / r.loss()[1])
            out.append(_tree_row(tree, losses[-1] if losses else None))
            if _stale(losses, s.stopping):
                break
        yield pa.RecordBatch.from_pylist(out, _TREE_ARROW)

    return state.coalesce(1).mapInArrow(run, _TREE).collect()


def _routed(state: DataFrame, m: Boosted, since: int, top: Tree, nodes: Sequence[int], schema: str, work) -> DataFrame:
    """``work`` over (place, row, bins, g, h) of the rows a tree learns from that lie in some
    leaves of the tree so far; ``place`` is the place of a row's leaf in ``nodes``."""
    s, t, features, late = m.settings, len(m.trees), len(m.binning.names), _since(m, since)
    place_of = np.full(len(top.feature), -1)
    place_of[list(nodes)] = np.arange(len(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def routed():
            for b in batches:
                for i in range(b.num_rows):
                    r = _rows(b, i, features)
                    at = np.flatnonzero(_drawn(s, r.row, t))
                    bins = _take(r.bins, at)
                    place = place_of[top.leaf(bins)]
                    if (place < 0).any():
                        here = np.flatnonzero(place >= 0)
                        at, place, bins = at[here], place[here], _take(bins, here)
                    r = Rows(r.row[at], bins, r.y[at], r.w[at], r.held[at], r.score[at] + late.score(bins))
                    yield place, r.row, bins, *r.derive()

        yield from work(routed())

    return state.where("not held").mapInArrow(run, schema)


def _histograms(state: DataFrame, m: Boosted, since: int, top: Tree, nodes: Sequence[int], columns: np.ndarray | None = None) -> list[np.ndarray]:
    """Histograms of some leaves over the whole table, added up by node on the executors."""
    search = Search(m.binning, m.settings, columns)
    size = 3 * search.cells

    def local(parts) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(nodes), 3, search.cells))
        for place, _, bins, g, h in parts:
            total += search.histograms(bins, g, h, place, len(nodes))
        rows = [{"node": i, "hist": x.tobytes()} for i, x in enumerate(total) if x[2].any()]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("node", pa.int64()), ("hist", pa.binary())]))

    def added(key: tuple, table: pa.Table) -> pa.Table:
        total = np.zeros(size)
        for x in table.column("hist").to_pylist():
            total += np.frombuffer(x)
        return pa.table({"node": pa.array([key[0].as_py()], pa.int64()), "hist": pa.array([total.tobytes()], pa.binary())})

    schema = "node long, hist binary"
    found = _routed(state, m, since, top, nodes, schema, local)
    if len(state.inputFiles()) * len(nodes) * size * 8 > GATHERED:
        found = found.groupBy("node").applyInArrow(added, schema)
    out = [np.zeros((3, search.cells)) for _ in nodes]
    for r in found.collect():
        out[r.node] += np.frombuffer(r.hist).reshape(3, -1)
    return out


_SPLIT = "node long, seq long, at long, gain double, feature long, left binary, sums array<double>"
_SPLIT_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("node", "seq", "at")] + [("gain", pa.float64()), ("feature", pa.int64()), ("left", pa.binary()), ("sums", pa.list_(pa.float64()))]
)


def _dealt(sizes: Sequence[float], most: float, tasks: int) -> list[int]:
    """A task for each leaf, the largest first to the task with the fewest rows; ``tasks``, or
    as many as it takes to keep them near ``most`` rows."""
    held = [(0.0, i) for i in range(max(1, min(len(sizes), max(tasks, -(-int(sum(sizes)) // int(most))))))]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        rows, task = heapq.heappop(held)
        out[i] = task
        heapq.heappush(held, (rows + sizes[i], task))
    return out


def _subtrees(
    state: DataFrame, m: Boosted, since: int, top: Tree, nodes: Sequence[int], depths: Sequence[int], sizes: Sequence[float], floor: float
) -> dict[int, list]:
    """The splits below small leaves: the rows of a leaf meet in one task."""
    s, features = m.settings, len(m.binning.names)
    columns, binning = _columns_of(s, features, len(m.trees)), m.binning
    task_of = _dealt(sizes, 4 * s.local_rows, state.sparkSession.sparkContext.defaultParallelism)
    schema = pa.schema([("task", pa.int32()), ("node", pa.int64()), ("row", pa.binary()), ("bins", pa.binary()), ("g", pa.binary()), ("h", pa.binary())])

    def send(parts) -> Iterator[pa.RecordBatch]:
        for place, row, bins, g, h in parts:
            order = np.argsort(place, kind="stable")
            ends = np.searchsorted(place[order], np.arange(len(nodes) + 1))
            rows = []
            for node in np.flatnonzero(np.diff(ends)).tolist():
                at = order[ends[node] : ends[node + 1]]
                rows.append({"task": task_of[node], "node": node, "row": row[at].tobytes(), "bins": _take(bins, at).T.tobytes(), "g": g[at].tobytes(), "h": h[at].tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, list] = {}
        for b in batches:
            for i in range(b.num_rows):
                met.setdefault(b.column(1)[i].as_py(), []).append([b.column(k)[i].as_buffer() for k in (2, 3, 4, 5)])
        for node in sorted(met):
            parts = met.pop(node)
            row, g, h = (np.concatenate([np.frombuffer(p[k], kind) for p in parts]) for k, kind in ((0, np.int64), (2, float), (3, float)))
            order = np.argsort(row, kind="stable")  # sums do not depend on the layout of the table
            bins = np.concatenate([np.frombuffer(p[1], np.uint8).reshape(features, -1) for p in parts], 1)[:, order].T
            g, h = g[order], h[order]
            grown = grow(Search(binning, s), s, bins, g, h, columns, depths[node], floor)
            rows = [
                {
                    "node": node, "seq": i, "at": at, "gain": x and x.gain, "feature": x and x.feature,
                    "left": x and np.packbits(x.left).tobytes(), "sums": x and x.sums.ravel().tolist(),
                }
                for i, (at, x) in enumerate(grown.splits.items())
            ]
            yield pa.RecordBatch.from_pylist(rows, _SPLIT_ARROW)

    sent = _routed(state, m, since, top, nodes, "task int, node long, row binary, bins binary, g binary, h binary", send)
    out: dict[int, list] = {}
    met = sent.repartitionById(max(task_of) + 1, "task").mapInArrow(finish, _SPLIT)
    for r in sorted(met.collect(), key=lambda r: (r.node, r.seq)):
        split = None
        if r.gain is not None:
            left = np.unpackbits(np.frombuffer(bytes(r.left), np.uint8)).astype(bool)
            split = Split(r.gain, r.feature, left, np.array(r.sums).reshape(2, 3))
        out.setdefault(r.node, []).append((r.at, split))
    return out


def _graft(grown: Growing, node: int, splits: list) -> None:
    place = {0: node}
    n = 1
    for at, split in splits:
        grown.put(place[at], split)
        if split is not None:
            place[n], place[n + 1] = grown.children[place[at]]
            n += 2


def _frontier(grown: Growing, s: Settings, nodes: list[int]) -> tuple[Tree, list[int]]:
    """The tree of all known splits, and where some nodes are in it."""
    done = [n for n, x in grown.splits.items() if x is not None]
    order = [0, *(c for n in done for c in grown.children[n])]
    place = {n: i for i, n in enumerate(order)}
    return grown.tree(done, s), [place[n] for n in nodes]


class Guess:
    """The top of the tree before, with the histograms of its nodes over the rows of the next:
    where the next tree is cut alike, they need no pass of their own."""

    def __init__(self, state: DataFrame, m: Boosted, since: int, top: Tree):
        leaves = np.flatnonzero(top.feature < 0).tolist()
        self.top, self.hists = top, dict(zip(leaves, _histograms(state, m, since, top, leaves)))
        for i in np.flatnonzero(top.feature >= 0)[::-1].tolist():  # children stand behind their parent
            a, b = top.children[i]
            self.hists[i] = self.hists[a] + self.hists[b]

    def holds(self, place: int, split: Split, rows: np.ndarray) -> bool:
        """Whether a node is cut like its guess; ``rows`` are the counts of the feature's bins."""
        here = np.flatnonzero(rows > 0.5)
        same = np.unpackbits(self.top.left[place]).astype(bool)[here] == split.left[here]
        return self.top.feature[place] == split.feature and bool(same.all())


def _top(grown: Growing, s: Settings) -> Tree:
    """The cuts of the largest nodes."""
    cut = [n for n, x in grown.splits.items() if x is not None and grown.sums[n][2] > s.local_rows]
    cut = sorted(sorted(cut, key=lambda n: -grown.sums[n][2])[:GUESSED])
    return grown.tree(cut, s)


def _next_tree(state: DataFrame, m: Boosted, since: int, before: Tree | None = None, floor: float = 0.0) -> tuple[Tree, Tree]:
    """One tree over a table of any size, and its top; ``before`` is the top of the tree before."""
    s, columns = m.settings, _columns_of(m.settings, len(m.binning.names), len(m.trees))
    search = Search(m.binning, s, columns)
    stump = Growing(np.zeros(3)).tree([], s)
    guess = Guess(state, m, since, before if before is not None and columns is None else stump) if columns is None else None
    root = guess.hists[0] if guess else _histograms(state, m, since, stump, [0], columns)[0]
    grown = Growing(root[:, : search.sizes[0]].sum(1))
    if s.symmetric:
        level, hists = [0], [root]
        for depth in range(s.depth or 0):
            splits = common_split(search, np.array(hists))
            if splits is None:
                break
            before, level = level, grow_level(grown, level, splits)
            if depth + 1 < s.depth:
                top, places = _frontier(grown, s, level[::2])
                lefts = _histograms(state, m, since, top, places, columns)
                hists = [x for left, parent in zip(lefts, hists) for x in (left, parent - left)]
        return grown.tree(grown.walk(s)[0], s), stump
    hists, guessed = {0: root}, {0: 0} if guess else {}
    while unknown := grown.walk(s)[1]:
        large = [n for n in unknown if grown.sums[n][2] > s.local_rows]
        if known := [n for n in large if n in hists]:
            for n in known:
                split = search.best(hists[n])
                grown.put(n, split)
                at = guessed.get(n)
                if split is None or at is None or guess.top.feature[at] < 0:
                    continue
                first = search.start[split.feature]
                if guess.holds(at, split, hists[n][2, first : first + search.sizes[split.feature]]):
                    for c, place in zip(grown.children[n], guess.top.children[at].tolist()):
                        guessed[c], hists[c] = place, guess.hists[place]
            continue
        if large:
            parents = {c: (p, pair) for p, pair in grown.children.items() for c in pair}
            pairs = sorted({parents[n] for n in large})
            less = [min(pair, key=lambda c: grown.sums[c][2]) for _, pair in pairs]
            top, places = _frontier(grown, s, less)
            for (p, pair), n, hist in zip(pairs, less, _histograms(state, m, since, top, places, columns)):
                other = pair[1 - pair.index(n)]
                hists[n], hists[other] = hist, hists.pop(p) - hist
            continue
        # small nodes wait until no large one is left, so that one job grows all their subtrees
        top, places = _frontier(grown, s, unknown)
        found = _subtrees(state, m, since, top, places, [grown.depth[n] for n in unknown], [grown.sums[n][2] for n in unknown], floor)
        for i, n in enumerate(unknown):
            _graft(grown, n, found.get(i, [(0, None)]))
    return grown.tree(grown.walk(s)[0], s), _top(grown, s)


def _held_loss(state: DataFrame, m: Boosted, since: int) -> float | None:
    features, late = len(m.binning.names), _since(m, since)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss = weight = 0.0
        for r in _blocks(batches, features):
            r.score = r.score + late.score(r.bins)
            x, w = r.loss()
            loss, weight = loss + x, weight + w
        yield pa.RecordBatch.from_pydict({"loss": [loss], "weight": [weight]})

    got = state.where("held").mapInArrow(run, "loss double, weight double").agg(F.sum("loss"), F.sum("weight")).first()
    return got[0] / got[1] if got[1] else None


def _rescored(state: DataFrame, m: Boosted, since: int) -> DataFrame:
    features, late = len(m.binning.names), _since(m, since)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = _rows(b, i, features)
                score = pa.array([(r.score + late.score(r.bins)).tobytes()], pa.binary())
                yield b.slice(i, 1).set_column(b.num_columns - 1, "score", score)

    return stage(state.mapInArrow(run, _STATE), "boosting", compression="uncompressed")


def _prepare(df: DataFrame, binning: Binning, label: str, weight: str | None, key: Sequence[str], base: float, rows: int) -> DataFrame:
    """The rows in blocks, dealt over files of about equal size."""
    names = binning.names
    slots = df.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(slots, -(-rows // BLOCK)), -(-rows // (BLOCK * BLOCKS)))

    def block(at: int, held: bool, pieces: list) -> pa.RecordBatch:
        row, bins, y, w = (np.concatenate([p[k] for p in pieces]) for k in range(4))
        first = TaskContext.get().partitionId()
        # labels are bytes where they are 0 and 1, equal weights are held once
        plain = y.astype(np.uint8) if np.isin(y, (0, 1)).all() else y
        columns = [row, bins.T, plain, w[:1] if (w == w[0]).all() else w, np.full(len(row), base)]
        one = [[first << 32 | at], [(first + at) % parts], [held], *([c.tobytes()] for c in columns)]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(one, _STATE_ARROW)], schema=_STATE_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[bool, list] = {False: [], True: []}
        at = 0
        for b in batches:
            row, y, w, held = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            bins, held = binning.apply(b), held.astype(bool)
            for side, pieces in waiting.items():
                here = np.flatnonzero(held == side)
                if len(here):
                    pieces.append((row[here], bins[here], y[here], w[here]))
                if sum(len(p[0]) for p in pieces) >= BLOCK:
                    yield block(at, side, pieces)
                    pieces.clear()
                    at += 1
        for side, pieces in waiting.items():
            if pieces:
                yield block(at, side, pieces)
                at += 1

    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    slim = df.select(
        F.xxhash64(*key).alias("row"), F.col(label).cast("double").alias("y"), w.alias("w"), "held", *names
    )
    blocks = slim.where("y is not null").mapInArrow(run, _STATE)
    return stage(blocks.repartitionById(parts, "part").sortWithinPartitions("block"), "boosting", compression="uncompressed")


def fit(
    train: DataFrame,
    names: Sequence[str],
    label: str,
    nominal: Sequence[str] = (),
    weight: str | None = None,
    evaluation: DataFrame | None = None,
    key: Sequence[str] = (),
    settings: Settings = Settings(),
) -> Boosted:
    """Fit trees to a 0/1 label; with evaluation rows, keep the trees up to their least loss.

    Null features have a bin of their own, below all numbers; rows without label are left
    out. Symmetric trees take numbers only. Which trees learn from a row is drawn by its
    ``key`` (default: all its columns), so a second fit gives the same trees.
    """
    s = settings
    if s.symmetric and (nominal or not s.depth):
        raise ValueError("symmetric trees need a depth, and nominal columns as numbers")
    ship(train.sparkSession)
    both = train.withColumn("held", F.lit(False))
    if evaluation is not None:
        both = both.unionByName(evaluation.withColumn("held", F.lit(True)))
    used = list(dict.fromkeys([*names, label, *key, *([weight] if weight else []), "held"]))
    both = stage(both.select(*used), "features")
    binning = fit_binning(both.where("not held"), names, nominal, s.max_bins)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    seen = F.when(~F.col("held"), w)
    p, n, rows = both.agg(
        F.sum(seen * F.col(label)) / F.sum(seen), F.count(F.when(~F.col("held"), F.col(label))), F.count(label)
    ).first()
    m = Boosted(binning, s)
    if not n:
        return m
    p = min(max(float(p), 1e-12), 1 - 1e-12)
    m.base = float(np.log(p / (1 - p)))
    state, since = _prepare(both, binning, label, weight, key or [*names, label], m.base, rows), 0
    small, top, floor = rows <= s.local_rows, None, 0.0
    while len(m.trees) < s.trees and not _stale(m.losses, s.stopping):
        if len(m.trees) - since >= (ROUNDS if small else RESCORED):
            before, state, since = state, _rescored(state, m, since), len(m.trees)
            discard(before)
        if small:
            for r in _rounds(state, m, since, min(ROUNDS, s.trees - len(m.trees))):
                m.trees.append(_tree_of(r))
                m.losses += [r.loss] if r.loss is not None else []
            continue
        tree, top = _next_tree(state, m, since, top, floor)
        m.trees.append(tree)
        # gains shrink from tree to tree; where a tree ends by its leaves, little is needed below its least
        cut = tree.gain[tree.feature >= 0]
        floor = float(cut.min()) * LEAST * (1 - s.learning_rate) ** 2 if len(cut) + 1 >= s.leaves and len(cut) else 0.0
        if evaluation is not None and (loss := _held_loss(state, m, since)) is not None:
            m.losses.append(loss)
    discard(state)
    discard(both)
    if m.losses:
        m.trees = m.trees[: int(np.argmin(m.losses)) + 1]
    return m


def predict(m: Boosted, df: DataFrame, keep: Sequence, name: str = "proba") -> DataFrame:
    """``keep`` columns plus the probability of label 1."""
    kept = df.select(*keep).schema
    names, left = m.binning.names, [*kept.names, name]
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            features = pa.RecordBatch.from_arrays([b.column(i) for i in range(len(names))], names)
            p = 1 / (1 + np.exp(-(shared.value.base + shared.value.score(shared.value.binning.apply(features)))))
            columns = [b.column(i) for i in range(len(names), b.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(p)], left)

    schema = kept.add(name, "double")
    inputs = [F.col(c).alias(f"_{i}") for i, c in enumerate(names)]
    return df.select(*inputs, *keep).mapInArrow(run, schema)


def save(m: Boosted, spark: SparkSession, path: str) -> str:
    rows = [(i, json.dumps({k: v for k, v in _tree_row(t, None).items() if k != "left"}), t.left.tobytes()) for i, t in enumerate(m.trees)]
    spark.createDataFrame(rows, "tree int, nodes string, left binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
    head = {"binning": asdict(m.binning), "settings": asdict(m.settings), "base": m.base, "losses": m.losses}
    spark.createDataFrame([(json.dumps(head),)], "head string").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    return path


def load(spark: SparkSession, path: str) -> Boosted:
    head = json.loads(spark.read.parquet(f"{path}/model").first().head)
    trees = []
    for r in spark.read.parquet(f"{path}/trees").orderBy("tree").collect():
        n = json.loads(r.nodes)
        trees.append(
            Tree(
                np.array(n["feature"], np.int64), np.frombuffer(bytes(r.left), np.uint8).reshape(-1, 32),
                np.array(n["children"], np.int64).reshape(-1, 2), np.array(n["value"]), np.array(n["gain"]),
            )
        )
    return Boosted(Binning(**head["binning"]), Settings(**head["settings"]), head["base"], trees, head["losses"])
