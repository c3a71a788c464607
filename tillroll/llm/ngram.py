"""Interpolated modified Kneser-Ney model of word n-grams.

Everything is counted over all training texts and kept in sorted hash arrays: the words of
the vocabulary by their 64-bit hashes, longer n-grams by (rank of the n-gram without its last
word, rank of that word), that is in the order of their words' hashes. Spark range-partitions
the counts, each task writes its range as one array file in the shared folder, and workers
map the files into memory: pages are read as they are needed and shared by the workers of a
machine, so neither a worker nor the driver holds the model. A batch of documents asks for
its distinct n-grams in sorted order, shard after shard.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.files import mapped, write_bytes
from tillroll.llm.langid import held_out
from tillroll.llm.text import word_blocks
from tillroll.sources.workspace import new_path, stage

SEED = 42
END_WORD = b"\n"  # no word holds white space
BLOCK = 500_000  # tokens worked on at once
CACHE = 500_000  # words whose hashes a worker remembers
PART_KEYS = 1 << 21  # keys of a task that writes an array, as counted per block
SAMPLE_KEYS = 1 << 21  # tokens that are read ahead to cut the keys into ranges


# ---- sorted arrays ----------------------------------------------------------------------


@dataclass(frozen=True)
class Shard:
    first: int
    n: int
    uri: str
    width: int  # bytes of a value

    def keys(self) -> np.ndarray:
        return mapped(self.uri)[: 8 * self.n].view("<i8")

    def values(self, column: int) -> np.ndarray:
        at = self.n * (8 + self.width * column)
        return mapped(self.uri)[at : at + self.n * self.width].view(f"<u{self.width}")


class SortedTable:
    """Distinct sorted keys with columns of counts, in shards by range of the key."""

    def __init__(self, shards: Sequence[Shard], columns: int, of_counts: Sequence[int], total: int):
        self.shards = sorted((s for s in shards if s.n), key=lambda s: s.first)
        self.columns, self.of_counts, self.total = columns, tuple(of_counts), total
        self._first = np.array([s.first for s in self.shards], np.int64)
        self._before = np.cumsum([0, *(s.n for s in self.shards)])

    def __len__(self) -> int:
        return int(self._before[-1])

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each key (-1: unknown) and its values (0 if unknown), (columns, keys)."""
        asked, back = np.unique(keys, return_inverse=True)
        rank = np.full(len(asked), -1, np.int64)
        values = np.zeros((self.columns, len(asked)), np.int64)
        borders = np.append(np.searchsorted(asked, self._first), len(asked))
        for i in np.flatnonzero(np.diff(borders)):
            shard, some = self.shards[i], slice(borders[i], borders[i + 1])
            known = shard.keys()
            at = np.minimum(np.searchsorted(known, asked[some]), shard.n - 1)
            hit = np.flatnonzero(known[at] == asked[some])
            at = at[hit]
            rank[some.start + hit] = self._before[i] + at
            for c in range(self.columns):
                values[c, some.start + hit] = shard.values(c)[at]
        return rank[back], values[:, back]

    def key_of(self, rank: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rank), np.int64)
        shard = np.searchsorted(self._before, rank, "right") - 1
        for i in np.unique(shard):
            at = shard == i
            out[at] = self.shards[i].keys()[rank[at] - self._before[i]]
        return out


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a sorted run, values (columns, keys) added up."""
    if not len(keys):
        return keys, values
    first = np.flatnonzero(np.concatenate([[True], np.diff(keys) != 0]))
    return keys[first], np.add.reduceat(values, first, axis=1)


def save(counts: DataFrame, name: str, columns: int = 1, borders: np.ndarray | None = None) -> SortedTable:
    """Write (key, v0, v1, ...) as sorted arrays, equal keys added up.

    Equal keys lie in one range. A task holds its range once, so its size is that of a
    shuffle partition; the driver gets one line per shard. Spark finds ranges by computing all
    counts once more; where that is dear, ``counts`` has a column ``part``, the place of the key
    among the ``borders``.
    """
    folder = new_path(counts.sparkSession, name)
    names = [f"v{i}" for i in range(columns)]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = [], []
        for b in batches:
            if b.num_rows:
                more = np.array([b.column(i + 1).to_numpy() for i in range(columns)], np.int64)
                k, v = _summed(b.column(0).to_numpy(), more)
                keys.append(k)
                values.append(v)
        if not keys:
            return
        k, v = _summed(np.concatenate(keys), np.concatenate(values, axis=1))
        width = next(w for w in (1, 2, 4, 8) if int(v.max()) < 1 << (8 * w - 1))
        uri = f"{folder}/{uuid.uuid4().hex}.array"
        write_bytes(uri, k.astype("<i8").tobytes(), v.astype(f"<u{width}").tobytes())
        of_counts = [int((v[0] == c).sum()) for c in (1, 2, 3, 4)]
        row = {"first": int(k[0]), "n": len(k), "uri": uri, "width": width, "of_counts": of_counts, "total": int(v[0].sum())}
        yield pa.RecordBatch.from_pylist([row])

    if borders is None:
        ranges = counts.select("key", *names).repartitionByRange("key")
    else:
        ranges = counts.repartitionById(len(borders) + 1, "part").select("key", *names)
    ordered = ranges.sortWithinPartitions("key")
    schema = "first long, n long, uri string, width long, of_counts array<long>, total long"
    rows = stage(ordered.mapInArrow(write, schema), name).collect()
    of_counts = [sum(r.of_counts[i] for r in rows) for i in range(4)]
    shards = [Shard(r["first"], r.n, r.uri, r.width) for r in rows]
    return SortedTable(shards, columns, of_counts, sum(r.total for r in rows))


# ---- tokens -----------------------------------------------------------------------------


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word, SEED)
        return h


_hashes = _Hashes()


@dataclass
class Tokens:
    """A block of tokens. ``doc``: row of the batch; ``place``: place in the document; ``fresh``
    is false for words repeated from the block before."""

    word: np.ndarray
    doc: np.ndarray
    place: np.ndarray
    fresh: np.ndarray


def _pieces(text: str | None, carry: int) -> Iterator[tuple[list[bytes], int, int]]:
    """(words, place of the first, how many of them were in the piece before); the last
    piece ends with END_WORD."""
    seen, old, last = 0, 0, []
    for words in word_blocks(text or "", carry):
        if seen:
            yield last, seen - len(last), old
            old = min(carry, len(last))
        last = words
        seen += len(words) - old
    yield [*last, END_WORD], seen - len(last), old


def tokens(texts: Sequence[str | None], carry: int) -> Iterator[Tokens]:
    words: list[bytes] = []
    spans: list[tuple[int, int, int, int]] = []

    def block() -> Tokens:
        if len(_hashes) > CACHE:
            _hashes.clear()
        word = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words)).view(np.int64)
        row, n, place, old = np.array(spans, np.int64).T
        inside = np.arange(len(words)) - np.repeat(np.cumsum(n) - n, n)
        return Tokens(word, np.repeat(row, n), np.repeat(place, n) + inside, inside >= np.repeat(old, n))

    for row, text in enumerate(texts):
        for some, place, old in _pieces(text, carry):
            words += some
            spans.append((row, len(some), place, old))
            if len(words) >= BLOCK:
                yield block()
                words, spans = [], []
    if words:
        yield block()


# ---- the model ----------------------------------------------------------------------------


def discounts(of_counts: Sequence[int]) -> tuple[float, float, float]:
    """What is taken off counts of 1, 2, and 3 or more, from the counts of counts 1 to 4.

    Where a count of counts is 0 (very small corpora) the discounts are 0.5, 1 and 1.5.
    """
    n1, n2, n3, n4 = of_counts
    if not min(n1, n2, n3, n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.0), k) for k, d in enumerate(found, 1))  # type: ignore[return-value]


def _discounted(counts: np.ndarray, d: Sequence[float]) -> np.ndarray:
    return np.maximum(counts - np.array([0.0, *d])[np.minimum(counts, 3)], 0.0)


@dataclass
class Model:
    """``words``: raw counts by word hash. ``grams[n]``: adjusted counts of n-grams (raw for the
    longest, and for those at the start of a text). ``contexts[n]``: per context of an n-gram the
    sum of its counts, and how many of them are 1, 2, 3 or more. All n-grams are keyed by rank."""

    order: int
    words: SortedTable
    grams: dict[int, SortedTable]
    contexts: dict[int, SortedTable]

    @property
    def bits(self) -> int:
        return _bits(self.words)

    def ranks(self, t: Tokens, rank: np.ndarray, upto: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(n, places of the block with a context of n - 1 tokens, rank of that context, counts of
        the n-gram) for n = 2 .. ``upto``; ``rank`` is that of each word."""
        shorter = rank.copy()
        follows = np.concatenate([[False], np.diff(t.doc) == 0]) if len(rank) else np.zeros(0, bool)
        for n in range(2, upto + 1):
            context = np.where(follows, np.roll(shorter, 1), -1)
            if n == 2:
                context = np.where(t.place == 0, len(self.words), context)
            at = np.flatnonzero(context >= 0)
            key = context[at] << self.bits | np.maximum(rank[at], 0)
            found, counts = self.grams[n].find(key)
            unknown = rank[at] < 0
            yield n, at, context[at], np.where(unknown, 0, counts[0])
            shorter = np.full(len(rank), -1)
            shorter[at] = np.where(unknown, -1, found)

    def log10(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each token, and its raw count."""
        # what depends on one word alone is looked up once per distinct word of the block
        words, back = np.unique(t.word, return_inverse=True)
        known, (raw,) = self.words.find(words)
        one = self.grams[1]
        d = discounts(one.of_counts)
        n1, n2, _, _ = one.of_counts
        left = d[0] * n1 + d[1] * n2 + d[2] * (len(one) - n1 - n2)
        held = one.find(np.maximum(known, 0))[1][0] if len(one) else np.zeros(len(known), np.int64)
        total = max(one.total, 1)
        p = _discounted(np.where(known < 0, 0, held), d) / total
        # an empty corpus leaves all to the one unknown word
        p += (left / total if len(one) else 1.0) / (len(self.words) + 1)
        p, raw, rank = p[back], raw[back], known[back]
        for n, at, context, counts in self.ranks(t, rank, self.order) if len(one) else ():
            d = discounts(self.grams[n].of_counts)
            if n == 2:
                of_words = self.contexts[2].find(np.append(known, len(self.words)))[1]
                stats = of_words[:, np.where(t.place == 0, len(words), np.roll(back, 1))[at]]
            else:
                stats = self.contexts[n].find(context)[1]
            seen = stats[0] > 0
            total, c1, c2, c3 = stats[:, seen]
            at = at[seen]
            left = d[0] * c1 + d[1] * c2 + d[2] * c3
            p[at] = (_discounted(counts[seen], d) + left * p[at]) / total
        return np.log10(p), raw


def _bits(words: SortedTable) -> int:
    return max(1, len(words).bit_length())


def _counted(docs: DataFrame, keys, borders: np.ndarray | None = None) -> DataFrame:
    """Keys of all blocks (``keys(tokens)``) with their counts, added up per block, and the ``part``
    between ``borders`` that a key falls into."""
    names = ["key", "v0", *(["part"] if borders is not None else [])]
    kinds = {"part": "int"}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for found in keys(b.column(0).to_pylist()):
                made = list(np.unique(found, return_counts=True))
                if borders is not None:
                    cuts = np.searchsorted(made[0], borders)
                    sizes = np.diff(np.concatenate([[0], cuts, [len(made[0])]]))
                    made.append(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes))
                yield pa.RecordBatch.from_arrays([pa.array(m) for m in made], names)

    return docs.select("text").mapInArrow(count, ", ".join(f"{n} {kinds.get(n, 'long')}" for n in names))


def _borders(docs: DataFrame, keys, n_keys: int) -> np.ndarray:
    """Where to cut the keys of all texts into ranges of about PART_KEYS, from those of a random part of
    the texts. They only say which task holds a key; every key is counted."""
    parts = -(-n_keys // PART_KEYS)
    if parts < 2:
        return np.zeros(0, np.int64)
    share = min(1.0, SAMPLE_KEYS / n_keys)
    some = _counted(docs.sample(share, SEED), keys).select("key").sample(0.1, SEED).toArrow()
    found = np.sort(some.column("key").to_numpy())
    if not len(found):
        return np.zeros(0, np.int64)
    return np.unique(found[np.arange(1, parts) * len(found) // parts])


def _of_shards(spark, table: SortedTable, work, columns: int = 1) -> DataFrame:
    """(key, v0, ...) that ``work(keys, counts)`` makes of the pieces of a table."""
    names = ["key", *(f"v{i}" for i in range(columns))]
    shards = table.shards

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in b.column(0).to_pylist():
                keys, counts = shards[i].keys(), shards[i].values(0)
                for lo in range(0, len(keys), BLOCK):
                    made = work(keys[lo : lo + BLOCK], counts[lo : lo + BLOCK].astype(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(m, pa.int64()) for m in made], names)

    tasks = spark.range(0, len(shards), 1, max(1, len(shards)))
    return tasks.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def train(docs: DataFrame, order: int = 2) -> Model:
    """Count all texts of ``docs`` (null: empty) and write the model to the shared folder.

    A token is a run of characters other than ASCII white space, A-Z lowered; each text ends
    with one more. Words are told apart by 64-bit hashes. Ranks of n-grams and words share
    63 bits. An empty table gives a model that knows no word.
    """
    spark = docs.sparkSession
    begin = lambda texts: (t.word[t.fresh] for t in tokens(texts, 0))
    words = save(_counted(docs, begin).groupBy("key").agg(F.sum("v0").alias("v0")), "words")
    bits, mask = _bits(words), (1 << _bits(words)) - 1
    start = len(words)
    raw = Model(order, words, {}, {})
    for n in range(2, order + 1):
        if (len(raw.grams[n - 1]) if n > 2 else start).bit_length() + bits > 63:
            raise ValueError(f"ranks of {n}-grams need more than 63 bits")

        def longest(texts, n=n, known=Model(order, words, dict(raw.grams), {})) -> Iterator[np.ndarray]:
            for t in tokens(texts, n - 1):
                rank = known.words.find(t.word)[0]
                if n == 2:
                    context = np.where(t.place == 0, start, np.roll(rank, 1))
                    at = np.flatnonzero(t.fresh)
                else:
                    context = np.full(len(rank), -1)
                    *_, (_, at, before, _) = known.ranks(t, rank, n - 1)
                    key = before << bits | rank[at]
                    context[at] = known.grams[n - 1].find(key)[0]
                    context = np.roll(context, 1)
                    at = np.flatnonzero(t.fresh & (t.place >= n - 2))
                yield context[at] << bits | rank[at]

        borders = _borders(docs, longest, words.total)
        raw.grams[n] = save(_counted(docs, longest, borders), f"grams{n}", borders=borders)
    grams = {order: raw.grams[order]}
    for n in range(order - 1, 0, -1):
        # how many words come before an n-gram
        def suffix(keys: np.ndarray, _: np.ndarray, n=n) -> tuple[np.ndarray, np.ndarray]:
            last = keys & mask
            if n > 1:
                context = keys >> bits
                last = _suffix_rank(raw, n, context) << bits | last
            return np.unique(last, return_counts=True)

        counts = _of_shards(spark, raw.grams[n + 1], suffix)
        if n > 1:
            # nothing comes before the start of a text: raw counts there
            def at_start(keys: np.ndarray, counts: np.ndarray, n=n) -> tuple[np.ndarray, np.ndarray]:
                first = _starts(raw, n, keys)
                return keys[first], counts[first]

            counts = counts.unionByName(_of_shards(spark, raw.grams[n], at_start))
        grams[n] = save(counts.groupBy("key").agg(F.sum("v0").alias("v0")), f"adjusted{n}")

    def sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        each = np.array([counts, counts == 1, counts == 2, counts > 2], np.int64)
        context, added = _summed(keys >> bits, each)
        return context, *added

    contexts = {n: save(_of_shards(spark, grams[n], sums, 4), f"contexts{n}", 4) for n in range(2, order + 1)}
    return Model(order, words, grams, contexts)


def _suffix_rank(raw: Model, n: int, rank: np.ndarray) -> np.ndarray:
    """Rank, as an (n-1)-gram, of an n-gram without its first word."""
    key = raw.grams[n].key_of(rank)
    last = key & ((1 << raw.bits) - 1)
    if n == 2:
        return last
    shorter = _suffix_rank(raw, n - 1, key >> raw.bits)
    return raw.grams[n - 1].find(shorter << raw.bits | last)[0]


def _starts(raw: Model, n: int, keys: np.ndarray) -> np.ndarray:
    """Which n-grams begin with the start of a text."""
    context = keys >> raw.bits
    for m in range(n - 1, 1, -1):
        context = raw.grams[m].key_of(context) >> raw.bits
    return context == len(raw.words)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row of ``docs``.

    score is the log10 probability of the whole text, its end included; base_score that of
    the word counts alone, half a token added to each. All words the model has not seen are
    one word. Null texts are empty. Repeated rows stay, extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        smooth = math.log10(model.words.total + 0.5 * (len(model.words) + 1))
        for b in batches:
            sums = np.zeros((4, b.num_rows))
            for t in tokens(b.column(1).to_pylist(), model.order - 1):
                p, raw = model.log10(t)
                each = (1.0, raw > 0, np.log10(raw + 0.5) - smooth, p)
                for i, x in enumerate(each):
                    sums[i] += np.bincount(t.doc, t.fresh * x, b.num_rows)
            columns = [b.column(0), *(pa.array(s.astype(np.int64)) for s in sums[:2]), *map(pa.array, sums[2:])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    schema = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def perplexities(docs: DataFrame, order: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every
    document, by a model of those whose id does not fall on the held-out fifth (a row without
    id is held out)."""
    model = train(docs.where(~held_out(5, 1)), order)
    n = F.lit(model.words.total).cast("long").alias("train_tokens")
    found = score(docs, model)
    return found.select(
        "doc_id", held_out(5, 1).alias("held_out"), "n_tokens", "n_known", n, "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
