"""Benchmark decontamination: q-gram lemma on diagonal bands, then banded alignment.

An occurrence of an item of length m with at most k edits keeps at least ``m + 1 - q - k*q``
of its q-grams, and all of them lie within k diagonals (text position minus item position).
Shared q-grams are counted in bands of diagonals that overlap by half, so that every run of
k + 1 diagonals lies within one band; bands that reach the bound give a region, and only
regions are aligned. Both sides are compared as lower-case words with single spaces.

A tenth of an item's characters may differ, whatever its length: q shrinks for items whose
bound would fall under one q-gram. Items of fewer than ``Q`` characters have no edit to
spend; they are found as they stand, as whole words where their script has spaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.text import CodeTable, folded, gram_codes

Q = 8
EDITS = 0.1
BLOCK_CHARS = 4 << 20  # of the benchmark; more items are searched in further passes
_CHUNK = 1 << 20
_NO_CHAR = 0xFFFFFFFF

# fixed values: code points of scripts that are written without spaces between words
_UNSPACED = (
    (0x0E00, 0x0EFF),  # Thai, Lao
    (0x1000, 0x109F),  # Myanmar
    (0x1780, 0x17FF),  # Khmer
    (0x3040, 0x30FF),  # Hiragana, Katakana
    (0x3400, 0x9FFF),  # Han
    (0xF900, 0xFAFF),  # Han, compatibility forms
    (0x20000, 0x3FFFF),  # Han, further planes
)


@dataclass
class Grams:
    """The q-grams of those items that are searched by one q, or of the ``whole`` items of q
    characters. Entries ``first[g]`` up to ``first[g + 1]`` are the (item, place) of the q-gram
    g of the table."""

    q: int
    whole: bool
    table: CodeTable
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray

    @classmethod
    def build(cls, points: list[np.ndarray], own: np.ndarray, q: int, whole: bool) -> Grams:
        codes = [gram_codes(points[j], q) for j in own.tolist()]
        flat = np.concatenate(codes)
        table = CodeTable(flat)
        item = np.repeat(own, [len(c) for c in codes])
        place = np.concatenate([np.arange(len(c)) for c in codes])
        at, found = table.find(flat)
        order = at[np.argsort(found, kind="stable")]
        first = np.searchsorted(np.sort(found), np.arange(len(table.codes) + 1))
        return cls(q, whole, table, first, item[order], place[order])


@dataclass
class Index:
    """The items of a block, and their q-grams for each q in use."""

    ids: list[int]
    points: list[np.ndarray]
    budget: np.ndarray
    need: np.ndarray
    grams: list[Grams]
    longest: int

    @classmethod
    def build(cls, items: list[tuple[int, str]], q: int = Q, edits: float = EDITS) -> Index:
        """Items without a letter or digit are left out. ``q`` is the longest q-gram; an item
        takes a shorter one where its edits would else leave no q-gram that must remain."""
        kept = [(i, p) for i, p in ((i, folded(t)) for i, t in items) if len(p)]
        m = np.array([len(p) for _, p in kept], np.int64)
        budget = (m * edits).astype(np.int64)
        own_q = np.minimum(q, m // (budget + 1))
        points = [p for _, p in kept]
        grams = [
            Grams.build(points, np.flatnonzero((own_q == n) & ((m < q) == whole)), n, whole)
            for n, whole in sorted(set(zip(own_q.tolist(), (m < q).tolist())))
        ]
        longest = int((m + 2 * budget + 2).max(initial=0))
        return cls([i for i, _ in kept], points, budget, m + 1 - own_q - budget * own_q, grams, longest)


def align(item: np.ndarray, region: np.ndarray, band: int, budget: int) -> tuple[int, int]:
    """Fewest edits of ``item`` against any stretch of ``region``, and where that ends.

    Diagonals 0..band of the region are computed, the start is free. Stops once the budget
    is exceeded on all of them.
    """
    exact = region.tobytes().find(item.tobytes())
    if exact >= 0 and exact % region.itemsize == 0 and exact // region.itemsize <= band:
        return 0, exact // region.itemsize + len(item)
    steps = np.arange(band + 1)
    row = np.zeros(band + 1, np.int64)
    padded = np.concatenate([region.astype(np.int64), np.full(len(item) + band + 1, -1)])
    inside = len(region)
    for i, c in enumerate(item):
        change = row + (padded[i : i + band + 1] != c)
        drop = np.append(row[1:], row[-1] + len(item)) + 1
        best = np.minimum(change, drop)
        best[steps + i + 1 > inside] += len(item)
        row = np.minimum.accumulate(best - steps) + steps
        if i & 7 == 7 and row.min() > budget:
            return int(row.min()), 0
    at = int(row.argmin())
    return int(row[at]), min(inside, at + len(item))


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... up to n[i] values, for each i in turn."""
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))


def _candidates(points: np.ndarray, index: Index, grams: Grams) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(item, place in the item, diagonal) of the shared q-grams, an item at a time, of the items
    of whose q-grams the text holds enough. An item is told apart by its places before
    positions of the text are listed, so many items that begin alike cost no more than their
    q-grams."""
    at, gram = grams.table.find(gram_codes(points, grams.q))
    if not len(at):
        return
    known = np.unique(gram)
    n = grams.first[known + 1] - grams.first[known]
    use = _spread(grams.first[known], n)
    item = grams.item[use]
    held = np.bincount(item, minlength=len(index.ids))
    keep = np.flatnonzero(held[item] >= index.need[item])
    if not len(keep):
        return
    code, item, place = np.repeat(known, n)[keep], item[keep], grams.place[use[keep]]
    order = np.argsort(item, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(item[order])) + 1):
        own_code = code[own]  # ascending, as the entries are
        lo = np.searchsorted(own_code, gram)
        times = np.searchsorted(own_code, gram, side="right") - lo
        places = place[own][_spread(lo, times)]
        yield int(item[own[0]]), places, np.repeat(at, times) - places


def _regions(points: np.ndarray, index: Index, grams: Grams) -> Iterator[tuple[int, int, int]]:
    """(item, first diagonal, diagonals) of bands that reach their item's bound."""
    for j, place, diagonal in _candidates(points, index, grams):
        width, need = int(index.budget[j]) + 1, int(index.need[j])
        band = diagonal // width
        order = np.argsort(band, kind="stable")
        band, place = band[order], place[order]
        found, start = np.unique(band, return_index=True)
        start = np.append(start, len(band))
        # a band is two steps wide: its q-grams are those of its own step and of the next
        bands = np.union1d(found, found - 1)
        lo = start[np.searchsorted(found, bands)]
        hi = start[np.searchsorted(found, bands + 1, side="right")]
        enough = [
            c
            for c, i, k in zip(bands.tolist(), lo.tolist(), hi.tolist())
            # a q-gram of the item counts once, however often the band repeats it
            if k - i >= need and len(np.unique(place[i:k])) >= need
        ]
        if enough:
            for run in np.split(np.array(enough), np.flatnonzero(np.diff(enough) != 1) + 1):
                # neighbouring bands are aligned as one
                yield j, int(run[0]) * width, (len(run) + 1) * width


def _rims(points: np.ndarray) -> np.ndarray:
    """For each place between characters, and both ends, whether a word can begin or end there:
    beside a space or a character of a script without spaces."""
    free = points == 32
    for lo, hi in _UNSPACED:
        free |= (points >= lo) & (points <= hi)
    return np.concatenate([[True], free[1:] | free[:-1], [True]])


def _words(
    points: np.ndarray, begin: int, end: int, index: Index, grams: Grams
) -> Iterator[tuple[int, int]]:
    """(item, end) of the first place of each short item that stands between rims."""
    at, gram = grams.table.find(gram_codes(points[begin:end], grams.q))
    if not len(at):
        return
    left, right = max(0, begin - 1), min(len(points), end + 1)
    rims = _rims(points[left:right])
    if left > 0:
        rims[0] = False  # cut off here, seen whole in the block before
    if right < len(points):
        rims[-1] = False
    at = at + begin
    free = rims[at - left] & rims[at - left + grams.q]
    at, gram = at[free], gram[free]
    order = np.lexsort((at, gram))
    _, firsts = np.unique(gram[order], return_index=True)
    for h in order[firsts].tolist():
        for j in grams.item[grams.first[gram[h]] : grams.first[gram[h] + 1]].tolist():
            if np.array_equal(points[at[h] : at[h] + grams.q], index.points[j]):
                yield j, int(at[h]) + grams.q


def search(text: str | None, index: Index, q: int = Q) -> list[tuple[int, int, int]]:
    """(item id, edits, end in the normalised text) of each item that the text holds."""
    points = folded(text)
    best: dict[int, tuple[int, int]] = {}
    longest = index.longest
    size = max(_CHUNK, 4 * longest)
    for begin in range(0, max(1, len(points) - longest), size - longest):
        part = points[begin : begin + size]
        for grams in index.grams:
            if grams.whole:
                for j, end in _words(points, begin, begin + len(part), index, grams):
                    best[j] = min(best.get(j, (0, end)), (0, end))
                continue
            for j, diagonal, band in _regions(part, index, grams):
                item, k = index.points[j], int(index.budget[j])
                if best.get(j, (1, 0))[0] == 0:
                    continue
                region = part[max(0, diagonal) : max(0, diagonal + len(item) + band + k)]
                if diagonal < 0:  # diagonals that begin before the text
                    region = np.pad(region, (-diagonal, 0), constant_values=_NO_CHAR)
                edits, end = align(item, region, band, k)
                found = (edits, begin + diagonal + end)
                if edits <= k and found < best.get(j, (k + 1, 0)):
                    best[j] = found
    return sorted((index.ids[j], e, end) for j, (e, end) in best.items())


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items in blocks of bounded size, one after the other.

    Null ids and texts are left out; a text that repeats under one id counts once.
    """
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars)
    for b in range(n):
        part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b
        found = [(r.item_id, r.text) for r in items.where(part).collect()]
        if found:
            yield sorted(found)


def matches_column(text: Column | str, items: list[tuple[int, str]]) -> Column:
    """The matches of a text, as an array of (item_id, edits, end_char)."""
    built: list[Index] = []

    @F.pandas_udf("array<struct<item_id: long, edits: int, end_char: long>>")
    def find(texts: pd.Series) -> pd.Series:
        if not built:
            built.append(Index.build(items))
        return pd.Series(
            [[{"item_id": i, "edits": e, "end_char": p} for i, e, p in search(t, built[0])] for t in texts],
            index=texts.index,
        )

    return find.asNondeterministic()(text)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, edits, end_char) for each benchmark item that a document holds with
    at most a tenth of its characters edited.

    Documents without a match have no row. Null and empty texts match nothing, nor do items
    without a letter or digit; items of fewer than ``Q`` characters match whole words. Repeated rows give repeated matches. Items of one text but several ids each match. An
    empty table on either side gives no rows. Extra columns are ignored.
    """
    out = None
    slim = docs.select("doc_id", "text")
    for items in blocks(benchmark):
        hit = slim.select("doc_id", F.explode(matches_column("text", items)).alias("m"))
        found = hit.select("doc_id", "m.item_id", "m.edits", "m.end_char")
        out = found if out is None else out.unionByName(found)
    if out is None:
        empty = docs.select("doc_id").where("false")
        return empty.selectExpr("doc_id", "0L item_id", "0 edits", "0L end_char")
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item. Columns stay, rows with a null
    or empty text stay, and repeated rows stay or go together. An empty benchmark takes nothing
    away; an empty table stays empty."""
    for items in blocks(benchmark):
        docs = docs.where(F.size(matches_column("text", items)) == 0)
    return docs
