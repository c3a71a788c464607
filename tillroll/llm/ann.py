"""Nearest neighbours by inverted lists with adaptive scanning of dimensions.

Vectors are rotated by a random orthogonal matrix and kept in lists by nearest centroid,
the rotated values cut into blocks of columns. A query scans the lists of its nearest
centroids block by block. After each block a test on the partial distance, which is a
random projection of the whole, abandons candidates that are too far with high confidence.
What is left is measured exactly on the original vectors.

The index is a table of chunks. About the square root of the number of vectors is the number
of lists. How many of them a query probes is measured: a bounded set of trial vectors is
searched exactly in one scan of the index, and the share is the smallest that holds the asked
part of their neighbours. Queries are packed by list and joined with the chunks of that list,
first with the nearest list only; the distance of the last neighbour found there is the bound
with which the other lists are scanned. No query goes through the driver, and the plan does
not grow with the number of queries.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.ranking import top_k
from tillroll.sources.workspace import stage

K = 10
SAMPLE = 32_768  # vectors the centroids are fitted on, about; a list has 16 of them at least
TRIALS = 128  # sampled vectors that measure what share must be probed
RECALL = 0.95  # part of the trials' neighbours that the probed lists hold
BLOCK_DIMS = 16
CONFIDENCE = 2.1  # of the test, in standard deviations
_CHUNK = 1024  # vectors of a chunk, queries of a pack
_BUFFER = 32_768  # vectors a task of the index build holds
_OPEN = 64  # packs a task keeps the neighbours of
_PAIRS = 1 << 18
_FOUND = "query_id long, vec_id long, score double"


def _usable(ids: pa.Array, vectors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and rows of the usable vectors, and their places: known id, right width, finite, not zero."""
    fits = pc.and_(pc.is_valid(ids), pc.fill_null(pc.equal(pc.list_value_length(vectors), width), False))
    at = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
    x = vectors.filter(fits).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
    good = np.isfinite(x).all(1) & x.any(1)
    return ids.filter(fits).to_numpy(zero_copy_only=False)[good].astype(np.int64), x[good], at[good]


@dataclass
class Quantiser:
    rotation: np.ndarray
    centroids: np.ndarray
    trial_ids: np.ndarray
    trials: np.ndarray
    kind: str  # type of the given components; the index keeps them as they are

    @property
    def width(self) -> int:
        return len(self.rotation)

    def cuts(self) -> list[slice]:
        return [slice(i, min(self.width, i + BLOCK_DIMS)) for i in range(0, self.width, BLOCK_DIMS)]

    def lists(self, x: np.ndarray) -> np.ndarray:
        return _nearest(x, self.centroids)

    def order(self, x: np.ndarray) -> np.ndarray:
        """The lists of each vector, nearest centroid first."""
        near = (self.centroids**2).sum(1) - 2 * x @ self.centroids.T
        return near.argsort(1, kind="stable")


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    norms = (centroids**2).sum(1)
    blocks = [x[i : i + 4096] for i in range(0, len(x), 4096)]
    return np.concatenate([(norms - 2 * b @ centroids.T).argmin(1) for b in blocks] or [np.zeros(0, np.int64)])


def fit(rows: DataFrame, lists: int | None = None, seed: int = 3) -> Quantiser | None:
    """Rotation, centroids and trial vectors from a bounded sample by hash; None if no vector is
    usable. Without ``lists`` their number is the square root of the number of rows.

    The width is that of most sampled vectors; vectors of other widths take no part.
    """
    n = rows.count()
    share = min(1.0, SAMPLE / max(n, 1))
    h = F.pmod(F.xxhash64("vec_id", F.lit("lists")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    known = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    found = rows.where((h < share) & known).limit(2 * SAMPLE).toArrow()
    if not found.num_rows:
        return None
    vectors = found.column("embedding").combine_chunks()
    widths, times = np.unique(pc.list_value_length(vectors).to_numpy(zero_copy_only=False), return_counts=True)
    width = int(widths[times.argmax()])
    ids, x, _ = _usable(found.column("vec_id").combine_chunks(), vectors, width) if width else ([], [], [])
    if not len(x):
        return None
    order = np.lexsort((*x.T[::-1], ids))
    ids, x = ids[order], x[order]
    rng = np.random.default_rng(seed)
    rotation, _ = np.linalg.qr(rng.normal(size=(width, width)))
    k = max(1, min(lists or round(n**0.5), len(x) // 16))
    centroids = x[rng.choice(len(x), k, replace=False)]
    for _ in range(10):
        mine = _nearest(x, centroids)
        by_list = mine.argsort(kind="stable")
        used, first = np.unique(mine[by_list], return_index=True)
        sums = np.add.reduceat(x[by_list], first)
        centroids[used] = sums / np.diff(np.append(first, len(x)))[:, None]
    some = rng.choice(len(x), min(TRIALS, len(x)), replace=False)
    kind = rows.schema["embedding"].dataType.elementType.simpleString()
    return Quantiser(rotation, centroids, ids[some], x[some], "f4" if kind == "float" else "f8")


def index(rows: DataFrame, q: Quantiser) -> DataFrame:
    """Chunks (list, n, ids, original, rotated) of every usable vector; rotated is one binary
    value per block of columns, in single precision."""
    schema = pa.schema(
        [("list", pa.int32()), ("n", pa.int64()), ("ids", pa.binary()), ("original", pa.binary()), ("rotated", pa.list_(pa.binary()))]
    )

    def chunk(which: int, ids: np.ndarray, x: np.ndarray) -> dict:
        turned = (x @ q.rotation).astype("f4")
        columns = [np.ascontiguousarray(turned[:, s]).tobytes() for s in q.cuts()]
        return {"list": which, "n": len(ids), "ids": ids.tobytes(), "original": x.astype(q.kind).tobytes(), "rotated": columns}

    def write(ids: list[np.ndarray], xs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        held, x = np.concatenate(ids), np.concatenate(xs)
        mine = q.lists(x)
        for c in np.unique(mine):
            own = np.flatnonzero(mine == c)
            cuts = range(0, len(own), _CHUNK)
            out = [chunk(int(c), held[own[i : i + _CHUNK]], x[own[i : i + _CHUNK]]) for i in cuts]
            yield pa.RecordBatch.from_pylist(out, schema)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, xs, n = [], [], 0
        for b in batches:
            some, x, _ = _usable(b.column(0), b.column(1), q.width)
            ids.append(some)
            xs.append(x)
            n += len(some)
            if n >= _BUFFER:
                yield from write(ids, xs)
                ids, xs, n = [], [], 0
        if n:
            yield from write(ids, xs)

    kinds = "list int, n long, ids binary, original binary, rotated array<binary>"
    return stage(rows.select("vec_id", "embedding").mapInArrow(build, kinds), "ivf")


def probe_share(chunks: DataFrame, q: Quantiser, sizes: np.ndarray, k: int = K, recall: float = RECALL) -> float:
    """The smallest share of the vectors, nearest lists first, that holds ``recall`` of the exact
    ``k`` nearest neighbours of the trial vectors. One scan of the index; at most
    ``k`` rows per trial come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((len(q.trials), k), np.inf)
        at = np.zeros((len(q.trials), k), np.int64)
        for b in batches:
            for which, ids, original in zip(*(b.column(i).to_pylist() for i in range(3))):
                x = np.frombuffer(original, q.kind).astype(float).reshape(-1, q.width)
                far = (q.trials**2).sum(1)[:, None] + (x**2).sum(1) - 2 * q.trials @ x.T
                far[q.trial_ids[:, None] == np.frombuffer(ids, np.int64)] = np.inf
                far, lists = np.hstack([best, far]), np.hstack([at, np.full(far.shape, which)])
                order = far.argpartition(k - 1, axis=1)[:, :k]
                best, at = np.take_along_axis(far, order, 1), np.take_along_axis(lists, order, 1)
        trial, place = np.nonzero(np.isfinite(best))
        columns = [pa.array(trial), pa.array(at[trial, place]), pa.array(best[trial, place])]
        yield pa.RecordBatch.from_arrays(columns, ["trial", "list", "far"])

    found = chunks.select("list", "ids", "original").mapInArrow(run, "trial long, list long, far double")
    rows = top_k(found, ["trial"], [F.col("far"), F.col("list")], k).collect()
    if not rows:
        return 1.0
    order = q.order(q.trials)
    before = np.cumsum(sizes[order], axis=1) - sizes[order]
    place = order.argsort(1)
    need = np.sort([before[r.trial, place[r.trial, r.list]] / sizes.sum() for r in rows])
    return min(1.0, float(need[int(np.ceil(recall * len(need))) - 1]) + 1 / sizes.sum())


@dataclass
class Probes:
    """Which lists a query scans, and into how many slices a list much longer than others is cut."""

    q: Quantiser
    sizes: np.ndarray
    share: float
    k: int

    def slices(self) -> np.ndarray:
        return np.maximum(1, np.ceil(self.sizes / (2 * max(self.sizes.mean(), 1)))).astype(np.int64)

    def of(self, queries: np.ndarray, home: bool) -> np.ndarray:
        """One column per list: the nearest one only, or the other lists that hold the share and
        more than ``k`` vectors."""
        order = self.q.order(queries)
        before = np.cumsum(self.sizes[order], axis=1) - self.sizes[order]
        use = before < max(self.share * self.sizes.sum(), self.k + 1)
        use[:, 0] = False
        if home:
            use = np.zeros_like(use)
            use[:, 0] = True
        out = np.zeros(use.shape, bool)
        np.put_along_axis(out, order, use, axis=1)
        return out


def _packs(asked: DataFrame, probes: Probes, home: bool) -> DataFrame:
    """Queries (vec_id, embedding, bound) packed for each list they probe, once per slice of it."""
    schema = pa.schema(
        [("list", pa.int32()), ("slice", pa.int64()), ("asking", pa.binary()), ("queries", pa.binary()), ("bounds", pa.binary())]
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = probes.slices()
        for b in batches:
            ids, x, at = _usable(b.column(0), b.column(1), probes.q.width)
            bound = pc.fill_null(b.column(2), np.inf).to_numpy(zero_copy_only=False)[at]
            for lo in range(0, len(ids), _CHUNK):
                some = slice(lo, lo + _CHUNK)
                use = probes.of(x[some], home)
                for c in np.flatnonzero(use.any(0)):
                    own = lo + np.flatnonzero(use[:, c])
                    row = {"list": int(c), "asking": ids[own].tobytes(), "queries": x[own].tobytes(), "bounds": bound[own].tobytes()}
                    yield pa.RecordBatch.from_pylist([{**row, "slice": s} for s in range(slices[c])], schema)

    kinds = "list int, slice long, asking binary, queries binary, bounds binary"
    return asked.select("vec_id", "embedding", "bound").mapInArrow(build, kinds)


class Scan:
    """The running search of one pack of queries over chunks of its list.

    Nothing is abandoned before a query has a bound: one that it came with, or the distance of
    its k-th neighbour. Of rows that share a vec_id the nearest counts.
    """

    def __init__(self, q: Quantiser, ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int):
        self.q, self.ids, self.queries, self.k = q, ids, queries, k
        self.turned = queries @ q.rotation
        self.norms = np.sqrt((queries**2).sum(1))
        self.who = np.zeros(0, np.int64)
        self.far = np.zeros(0)
        self.vec = np.zeros(0, np.int64)
        self.bound = bounds**2 * (1 + 1e-9) + 1e-12

    def add(self, ids: bytes, original: bytes, rotated: list[bytes]) -> None:
        vec = np.frombuffer(ids, np.int64)
        x = np.frombuffer(original, self.q.kind).reshape(len(vec), -1)
        columns = [np.frombuffer(r, "f4").astype(float).reshape(len(vec), -1) for r in rotated]
        step = max(1, _PAIRS // max(len(vec), 1))
        for lo in range(0, len(self.ids), step):
            self._scan(np.arange(lo, min(lo + step, len(self.ids))), vec, x, columns)

    def _scan(self, who: np.ndarray, vec: np.ndarray, x: np.ndarray, columns: list[np.ndarray]) -> None:
        cuts, width = self.q.cuts(), self.q.width
        a = self.turned[who, cuts[0]]
        partial = (a**2).sum(1)[:, None] + (columns[0] ** 2).sum(1) - 2 * a @ columns[0].T
        alive = partial <= self._limit(cuts[0].stop, width)[who][:, None]
        alive &= self.ids[who][:, None] != vec
        i, j = np.nonzero(alive)
        seen = partial[i, j]
        i = who[i]
        for cut, column in zip(cuts[1:], columns[1:]):
            seen = seen + ((self.turned[i, cut] - column[j]) ** 2).sum(1)
            keep = seen <= self._limit(cut.stop, width)[i]
            i, j, seen = i[keep], j[keep], seen[keep]
        exact = ((self.queries[i] - x[j]) ** 2).sum(1)
        near = exact <= self.bound[i]
        self._merge(i[near], np.sqrt(exact[near]), vec[j[near]])

    def _limit(self, dims: int, width: int) -> np.ndarray:
        """The largest partial squared distance that the test does not reject, widened by what
        single precision can shift a distance."""
        part = 1.0 if dims == width else np.sqrt(dims / width) * (1 + CONFIDENCE / np.sqrt(dims))
        last = np.sqrt(self.bound)
        return (last * part + 2e-7 * (self.norms + last)) ** 2

    def _merge(self, who: np.ndarray, far: np.ndarray, vec: np.ndarray) -> None:
        if not len(who):
            return
        who, far, vec = np.append(self.who, who), np.append(self.far, far), np.append(self.vec, vec)
        order = np.lexsort((far, vec, who))
        who, far, vec = who[order], far[order], vec[order]
        new = np.append(True, (np.diff(who) != 0) | (np.diff(vec) != 0))
        who, far, vec = who[new], far[new], vec[new]
        order = np.lexsort((vec, far, who))
        who, far, vec = who[order], far[order], vec[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        keep = place < self.k
        self.who, self.far, self.vec = who[keep], far[keep], vec[keep]
        last = place == self.k - 1
        self.bound[who[last]] = np.minimum(self.bound[who[last]], far[last] ** 2 * (1 + 1e-9) + 1e-12)

    def result(self) -> pa.RecordBatch:
        columns = [pa.array(self.ids[self.who]), pa.array(self.vec), pa.array(self.far)]
        return pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])


def _scanned(chunks: DataFrame, packs: DataFrame, q: Quantiser, k: int) -> DataFrame:
    """Up to ``k`` neighbours of each query in each slice of the lists it was packed for. A task
    keeps the neighbours of some packs at a time; a pack that comes back later starts anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scans: OrderedDict[tuple, Scan] = OrderedDict()
        for b in batches:
            for i in range(b.num_rows):
                asking, queries, bounds, ids, original, rotated = (b.column(c)[i].as_py() for c in range(6))
                pack = asking, queries
                if pack not in scans:
                    x = np.frombuffer(queries, float).reshape(-1, q.width)
                    scans[pack] = Scan(q, np.frombuffer(asking, np.int64), x, np.frombuffer(bounds, float), k)
                    if len(scans) > _OPEN:
                        yield scans.popitem(last=False)[1].result()
                scans[pack].add(ids, original, rotated)
        for scan in scans.values():
            yield scan.result()

    pairs = packs.join(chunks, ["list", "slice"])
    return pairs.select("asking", "queries", "bounds", "ids", "original", "rotated").mapInArrow(run, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each query with their rank from 0, ties to the smaller vec_id."""
    nearest = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return top_k(nearest, ["query_id"], [F.col("score"), F.col("vec_id")], k, rank="rank")


def search(
    rows: DataFrame, every: int = 100, k: int = K, lists: int | None = None, share: float | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found of each query.

    Queries are the rows whose vec_id ``every`` divides; candidates are all rows with another
    vec_id; score is the Euclidean distance of the original vectors, ties go to the smaller
    vec_id. Vectors that are null, empty, zero, of another width than most, or hold null or
    non-finite values take no part, nor do rows without vec_id. Rows that share a vec_id are
    one item with several vectors: the least distance counts, asked from or to any of them.
    Extra columns are ignored; an empty table gives no rows. ``share`` of the vectors, nearest
    lists first, is scanned by each query; without it ``probe_share`` measures what is needed.
    """
    slim = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    q = fit(slim, lists)
    if q is None:
        empty = slim.where("false").select(F.col("vec_id").alias("query_id"), "vec_id")
        return empty.selectExpr("query_id", "1 rank", "vec_id", "0D score")
    chunks = index(slim, q)
    sizes = np.zeros(len(q.centroids))
    for r in chunks.groupBy("list").agg(F.sum("n").alias("n")).collect():
        sizes[r.list] = r.n
    probes = Probes(q, sizes, probe_share(chunks, q, sizes, k) if share is None else share, k)
    parts = F.get(F.lit(probes.slices()), F.col("list"))
    chunks = chunks.withColumn("slice", F.pmod(F.xxhash64("ids"), parts))
    asked = slim.where(f"vec_id % {every} = 0 and embedding is not null")
    unbound = asked.withColumn("bound", F.lit(None).cast("double"))
    home = stage(_best(_scanned(chunks, _packs(unbound, probes, True), q, k), k).drop("rank"), "near")
    full = F.when(F.count(F.lit(1)) >= k, F.max("score"))
    bounds = home.groupBy(F.col("query_id").alias("vec_id")).agg(full.alias("bound"))
    rest = _scanned(chunks, _packs(asked.join(bounds, "vec_id", "left"), probes, False), q, k)
    ranked = _best(home.unionByName(rest), k)
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), "vec_id", "score")
