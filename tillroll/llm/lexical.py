"""Ranked lexical search turned round: documents stream through an index of the items.

The items (the queries) are the small side. Their terms become an inverted index, which is
broadcast in blocks of bounded size. One pass over the documents reduces each text to its
length and the counts of the index's terms; corpus statistics come from that table, and a
second pass streams its rows through the index and keeps a bounded heap per item. The heaps
of all tasks are merged by a top-k per item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.ranking import top_k
from tillroll.sources.workspace import stage

BLOCK_POSTINGS = 500_000  # postings of one block of the index, at most (one item may exceed it)
CELLS = 1 << 21  # scores (documents x items), or postings met, that are held at once
CUT = 1 << 20  # bytes of a text that are split into terms at once

# Bytes that separate terms become a space, A-Z become a-z, all others stay.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text (UTF-8) in lists of bounded size."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)
    i = 0
    while i < len(raw):
        j = raw.find(b" ", i + CUT)
        j = len(raw) if j < 0 else j
        yield raw[i:j].split()
        i = j


class ItemIndex:
    """Inverted index of a block of items: each term's items and how often each holds it."""

    def __init__(self, items: list[tuple[int | None, dict[bytes, int]]]):
        self.ids = [i for i, _ in items]
        self.term: dict[bytes, int] = {}
        postings: list[list[tuple[int, int]]] = []
        for at, (_, held) in enumerate(items):
            for t, n in held.items():
                t = self.term.setdefault(t, len(self.term))
                if t == len(postings):
                    postings.append([])
                postings[t].append((at, n))
        self.start = np.cumsum([0, *map(len, postings)])
        flat = np.array([x for p in postings for x in p], np.int64).reshape(-1, 2)
        self.item, self.times = flat[:, 0].copy(), flat[:, 1].copy()

    def count(self, text: str | None) -> tuple[int, list[int], list[int]]:
        """Number of terms of a text, and which of the index it holds how often."""
        n, held = 0, Counter()
        for some in terms(text):
            n += len(some)
            held.update(map(self.term.get, some))
        held.pop(None, None)
        return n, list(held), list(held.values())


def _blocks(items: DataFrame) -> Iterator[ItemIndex]:
    """The items in blocks of bounded size; rows of one item_id are one item."""
    block, size = [], 0
    rows = items.select("item_id", "text").orderBy("item_id").toLocalIterator()
    for item_id, same in groupby(rows, key=lambda r: r.item_id):
        held = Counter(t for r in same for some in terms(r.text) for t in some)
        if block and size + len(held) > BLOCK_POSTINGS:
            yield ItemIndex(block)
            block, size = [], 0
        block.append((item_id, held))
        size += len(held)
    if block:
        yield ItemIndex(block)


def _counted(docs: DataFrame, index) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [index.value.count(t) for t in b.column(1).to_pylist()]
            n, ids, times = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))],
                ["doc_id", "n", "ids", "times"],
            )

    schema = "doc_id long, n long, ids array<int>, times array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, schema)


class Heaps:
    """The best ``k`` documents per item; equal scores go by doc_id, null last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.zeros(items, np.int64)  # what a document has to score to matter
        self.rows = np.zeros((4, 0), np.int64)  # item, score, doc_id is null, doc_id

    def add(self, item: np.ndarray, score: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        rows = np.concatenate([self.rows, [item, score, null, doc]], axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        first = np.flatnonzero(np.diff(rows[0], prepend=-1))
        place = np.arange(rows.shape[1]) - np.repeat(first, np.diff(first, append=rows.shape[1]))
        last = rows[:, place == self.k - 1]
        self.least[last[0]] = last[1]
        self.rows = rows[:, place < self.k]


def _cuts(fan: np.ndarray, items: int) -> Iterator[slice]:
    """Runs of documents whose postings and scores fit in memory."""
    ends, lo = np.cumsum(fan), 0
    while lo < len(fan):
        most = (ends[lo - 1] if lo else 0) + CELLS
        hi = min(int(np.searchsorted(ends, most, "right")), lo + CELLS // items)
        hi = max(hi, lo + 1)
        yield slice(lo, hi)
        lo = hi


def _scores(x: ItemIndex, term: np.ndarray, gain: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """(rows, items) summed gains; each entry (row, term, gain) meets the postings of its term."""
    fan = x.start[term + 1] - x.start[term]
    at = np.repeat(x.start[term] - np.cumsum(fan) + fan, fan) + np.arange(fan.sum())
    cell = np.repeat(row, fan) * len(x.ids) + x.item[at]
    gain = np.repeat(gain, fan) * x.times[at]
    # bincount sums doubles, exact below 2**53: high and low bits are added apart
    high, low = (np.bincount(cell, part, rows * len(x.ids)).astype(np.int64) for part in (gain >> 26, gain & (1 << 26) - 1))
    return ((high << 26) + low).reshape(rows, len(x.ids))


def _searched(counted: DataFrame, index, weight, n_docs: int, length: int, k: int) -> DataFrame:
    """(item, doc_id, score) of each task's heaps."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, w = index.value, weight.value
        heaps = Heaps(len(x.ids), k)
        for b in batches:
            doc = b.column(0).fill_null(0).to_numpy()
            null = b.column(0).is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            m = 25 + (75 * b.column(1).to_numpy() * n_docs) // length
            ends = np.concatenate([[0], np.cumsum(np.diff(b.column(2).offsets.to_numpy()))])
            term, times = b.column(2).flatten().to_numpy(), b.column(3).flatten().to_numpy()
            row = np.repeat(np.arange(b.num_rows), np.diff(ends))
            gain = w[term] * ((1_000_000_000 * times) // (1000 * times + 8 * m[row]))
            fan = np.bincount(row, x.start[term + 1] - x.start[term], b.num_rows).astype(np.int64)
            for cut in _cuts(fan, len(x.ids)):
                some = slice(ends[cut.start], ends[cut.stop])
                score = _scores(x, term[some], gain[some], row[some] - cut.start, cut.stop - cut.start)
                d, item = np.nonzero((score > 0) & (score >= heaps.least))
                heaps.add(item, score[d, item], null[cut][d], doc[cut][d])
        item, score, null, doc = heaps.rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(doc, mask=null == 1), pa.array(score)], ["item", "doc_id", "score"]
        )

    return counted.mapInArrow(search, "item long, doc_id long, score long")


def _search_block(docs: DataFrame, index: ItemIndex, k: int) -> DataFrame | None:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(index)
    counted = stage(_counted(docs, shared), "term-counts")
    n_docs, length = counted.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return None
    # one row per term of the block
    df = counted.select(F.explode("ids").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    weight = np.zeros(len(index.term), np.int64)
    for t, held in df.collect():
        weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held + 1)))
    found = _searched(counted, shared, spark.sparkContext.broadcast(weight), n_docs, length, k)
    ids = spark.createDataFrame(list(enumerate(index.ids)), "item long, item_id long")
    best = top_k(found, ["item"], [F.desc("score"), F.asc_nulls_last("doc_id")], k, rank="rank")
    return stage(
        best.join(F.broadcast(ids), "item").select(
            "item_id", (F.col("rank") + 1).alias("rank"), "doc_id", "score"
        ),
        "ranked",
    )


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents that score highest for each item.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII; A-Z are
    lowered. Null, empty and blank texts have none: such a document is not counted and such
    an item finds nothing. Whole texts of any length are read. Rows of one item_id (null is
    one, too) are one item, terms of repeated rows counted again. Each row of ``docs`` is a
    document; equal scores go by ascending doc_id, null last. Extra columns are ignored. An
    empty table on either side gives an empty result.
    """
    found = [_search_block(docs, index, k) for index in _blocks(items)]
    none = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, [f for f in found if f is not None], none)
