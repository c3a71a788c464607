"""Sharding by a weighted hash tree: region, rack, shard.

At each level every child draws ``-ln(u) / weight`` with u from a hash of the document and
the child, and the smallest draw wins. A child is chosen in proportion to its weight, and
when weights change, documents only move into or out of the subtrees whose weight changed.
A shard is added as a region of its own, so the weights of all others stay as they are and
documents move into the new shard only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.sources.workspace import stage

ROWS_PER_SLICE = 1 << 16


@dataclass(frozen=True)
class Node:
    """A place in the tree. ``shard`` is set on leaves only."""

    name: str
    weight: float = 1.0
    children: tuple[Node, ...] = ()
    shard: int | None = None


def _inner(name: str, children: Sequence[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), tuple(children))


def tree(shards: int, regions: int = 4, racks: int = 2, weights: Sequence[float] | None = None) -> Node:
    """Shards 0.. dealt to racks and regions as evenly as they go."""
    if shards < 1:
        raise ValueError("a tree needs a shard")
    leaves = [
        Node(f"shard{i}", 1.0 if weights is None else weights[i], shard=i) for i in range(shards)
    ]
    groups = min(shards, regions * racks)
    cut = [leaves[g * shards // groups : (g + 1) * shards // groups] for g in range(groups)]
    rack = [_inner(f"rack{g}", c) for g, c in enumerate(cut)]
    tops = min(regions, groups)
    return _inner(
        "root",
        [
            _inner(f"region{r}", rack[r * groups // tops : (r + 1) * groups // tops])
            for r in range(tops)
        ],
    )


def grown(root: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region and rack of its own."""
    leaf = Node(f"shard{shard}", weight, shard=shard)
    new = _inner(f"region+{shard}", [_inner(f"rack+{shard}", [leaf])])
    return _inner("root", [*root.children, new])


def _draw(key: Column, node: Node, level: str) -> Column:
    h = F.xxhash64(key, F.lit(f"{level}/{node.name}"))
    u = (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(u) / F.lit(float(node.weight))


def _descend(key: Column, node: Node, level: str = "") -> Column:
    """The leaf below ``node`` that the draws lead to."""
    if node.shard is not None:
        return F.lit(node.shard)
    below = [c for c in node.children if c.weight > 0]
    if len(below) == 1:
        return _descend(key, below[0], f"{level}/{node.name}")
    draws = [_draw(key, c, f"{level}/{node.name}") for c in below]
    least = F.least(*draws)
    pick = F.lit(None).cast("int")
    for c, d in reversed(list(zip(below, draws))):
        pick = F.when(d == least, _descend(key, c, f"{level}/{node.name}")).otherwise(pick)
    return pick


def shard_of(key: Column, root: Node) -> Column:
    return _descend(key, root).cast("int")


def assign(docs: DataFrame, shards: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of each row.

    The law is ``key``: doc_id and the number of shards decide. size is the UTF-8 bytes of
    the text plus 1 (null: 1), text_crc32 that of the text's bytes (null: of none). Slots
    count from 0 in each shard without gaps, by slice, doc_id, crc and size; repeated rows
    get a slot each. Rows without doc_id share the draws of one fixed key. A shard is cut
    into slices of about 65,536 rows, numbered apart and put together by their counts, so no
    task holds a shard whole. Extra columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    root = tree(shards)
    rows = stage(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            shard_of(key, root).alias("shard"),
            shard_of(key, grown(root, shards)).alias("grown_shard"),
        ),
        "shards",
    )
    slices = max(1, -(-rows.count() // (shards * ROWS_PER_SLICE)))
    placed = rows.withColumn("_slice", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(slices)))
    counts = placed.groupBy("shard", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("shard").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "shard", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = W.partitionBy("shard", "_slice").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("_rank", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["shard", "_slice"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("_before") + F.col("_rank")).cast("long").alias("slot"),
        "grown_shard",
    )
