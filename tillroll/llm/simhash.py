"""SimHash near-copies: segment popcounts on a grid, Manhattan bound, exact check.

A 64-bit fingerprint becomes the vector of bit counts of its segments. The Manhattan
distance of two such vectors never exceeds the Hamming distance of the fingerprints, so
fingerprints within two bits have vectors within Manhattan distance two, and then there
is a grid point at most one step from both. Each distinct fingerprint is put on its own
grid point and all points one step away; only those that meet another one stay. The
survivors are checked with segments of one bit, where the bound is the Hamming distance
itself: two of them meet on a point exactly if at most two bits differ, and a point never
holds more than 65 fingerprints. Links of a point are a star, so no pairs are listed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.components import components
from tillroll.llm.text import word_blocks
from tillroll.sources.workspace import stage

SEED = 42
BITS = 64
SEGMENT = 2  # bits; the finer, the fewer fingerprints meet by chance


def fingerprint(text: str | None, words: int = 3) -> int:
    """Unsigned SimHash over the word shingles of a text; 0 without words.

    A bit is set if it is set in over half the shingle hashes, repeats included.
    """
    ones, n, block = np.zeros(BITS, np.int64), 0, []

    def add(grams: list[bytes]) -> None:
        nonlocal ones, n
        hashes = np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        n += len(grams)

    for block in word_blocks(text or "", words - 1):
        if len(block) >= words:
            add([b" ".join(x) for x in zip(*(block[i:] for i in range(words)))])
    if not n and block:  # the last block holds all words of a text with fewer
        add([b" ".join(block)])
    bits = ones * 2 > n if n else np.zeros(BITS, bool)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprint_column(text: str | Column, words: int = 3) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def signed(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(t, words) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64), index=texts.index)

    return signed.asNondeterministic()(text)


def _segment_counts(fp: Column) -> Column:
    """Bit counts (0, 1, 2) of the 32 segments, each in the place of its segment."""
    low, beside = F.lit(0x5555555555555555), F.shiftrightunsigned(fp, 1)
    one = fp.bitwiseXOR(beside).bitwiseAND(low)
    both = fp.bitwiseAND(beside).bitwiseAND(low)
    return one.bitwiseOR(F.shiftleft(both, 1))


def _signed(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def _grid_points(counts: Column) -> Column:
    """The point itself and every point one step away."""
    steps = []
    for i in range(0, BITS, SEGMENT):
        count = F.shiftrightunsigned(counts, i).bitwiseAND(F.lit(3))
        steps.append(F.when(count < SEGMENT, counts.bitwiseXOR(_signed(1 << i))))  # 0 and 1
        steps.append(F.when(count > 0, counts.bitwiseXOR(_signed(3 << i))))  # 1 and 2
    return F.filter(F.array(counts, *steps), lambda p: p.isNotNull())


def _flips(fp: Column) -> Column:
    """The fingerprint and the 64 values one bit away."""
    return F.array(fp, *[fp.bitwiseXOR(_signed(1 << i)) for i in range(BITS)])


def links(prints: DataFrame) -> DataFrame:
    """Links (u > v) that join all distinct fingerprints at most two bits apart."""
    on_grid = prints.select("fp", F.explode(_grid_points(_segment_counts(F.col("fp")))).alias("p"))
    shared = on_grid.groupBy("p").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("p")
    near = on_grid.join(shared, "p", "left_semi").select("fp").distinct()
    flips = near.select("fp", F.explode(_flips(F.col("fp"))).alias("p"))
    # at most 65 fingerprints have a given value as a neighbour, so these lists are short
    met = flips.groupBy("p").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    star = met.select(F.explode("fps").alias("u"), F.array_min("fps").alias("v"))
    return star.where("u <> v").distinct()


def near_copies(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of each row; component_id is the smallest doc_id reachable
    over links of at most two differing bits.

    Null and empty texts have fingerprint 0 and are linked like any other. Repeated rows
    stay. Rows without doc_id have links but are never a smallest id. Extra columns are
    ignored. An empty table gives an empty result.
    """
    ids = stage(docs.select("doc_id", fingerprint_column("text", words).alias("fp")), "fps")
    prints = stage(ids.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    roots = components(links(prints))
    named = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    named = stage(named, "named")
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = named.join(smallest, "root").select("fp", "component_id")
    return ids.join(classes, "fp")


def hex16(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame, found: DataFrame, fp: Column) -> DataFrame:
    """The rows of ``docs`` that ``found`` (doc_id, fp, component_id) leaves; ``fp`` is the
    expression of the fingerprint of a row."""
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_id"), F.col("fp").alias("_gone"))
    gone = stage(gone.distinct(), "gone")
    several = found.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    several = stage(several.select(F.col("doc_id").alias("_id")), "several")
    kept = docs.join(gone, docs["doc_id"] == gone["_id"], "left_anti")
    if several.isEmpty():
        return kept
    # only where a doc_id repeats do fingerprints tell which of its rows go
    single = kept.join(several, kept["doc_id"] == several["_id"], "left_anti")
    again = docs.join(several, docs["doc_id"] == several["_id"], "left_semi")
    own = again.select(F.struct(*docs.columns).alias("_row"), "doc_id", fp.alias("_fp"))
    one = own.groupBy("doc_id", "_fp").agg(F.first("_row").alias("_row"))
    dropped = (one["doc_id"] == gone["_id"]) & (one["_fp"] == gone["_gone"])
    return single.unionByName(one.join(gone, dropped, "left_anti").select("_row.*"))


def keep_one(docs: DataFrame, words: int = 3) -> DataFrame:
    """Documents without near-copies of an earlier one: each group keeps its smallest doc_id.

    Of rows that repeat a doc_id with one fingerprint a single row stays. Rows without
    doc_id stay. The columns are those of ``docs``.
    """
    return keep_first(docs, near_copies(docs, words), fingerprint_column("text", words))
