"""Language identification by the nearest of several centroids per language.

Texts become TF-IDF vectors of hashed character n-grams. Document frequencies cover every
training text. Per language a spherical k-means over a bounded sample gives a few centroids;
a text takes the language of the centroid with the highest cosine. A text farther from its
language than nearly all sampled training texts is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.text import folded, gram_codes_of, pieces

BUCKET_BITS = 13
GRAMS = (1, 2, 3)
CENTROIDS = 3
SAMPLE = 4000  # training texts for the centroids, over all languages; about evenly dealt
SAMPLE_PER_LANGUAGE = 500
REJECT = 0.005  # share of sampled training texts that lie beyond the rejection distance
UNKNOWN = "und"
_PIECE = 1 << 20


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of a text's letters, and how often each occurs."""
    letters = folded(text, digits=False, rim=1)
    if not len(letters):
        return np.zeros(0, np.int64), np.zeros(0)
    total = np.zeros(1 << BUCKET_BITS)
    for i, piece in enumerate(pieces(letters, _PIECE, max(GRAMS) - 1)):
        for n, codes in zip(GRAMS, gram_codes_of(piece, GRAMS)):
            codes = codes[max(GRAMS) - n if i else 0 :]  # the piece before has had these
            bucket = (codes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
            total += np.bincount(bucket, minlength=len(total))
    at = np.flatnonzero(total)
    return at, total[at]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    limit: np.ndarray

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        at, n = gram_counts(text)
        weight = np.log1p(n) * self.idf[at]
        norm = np.sqrt((weight**2).sum())
        return at, weight / norm if norm else weight

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        at, weight = self.vector(text)
        if not len(at) or not self.languages:
            return UNKNOWN, 0.0, True
        cosine = weight @ self.centroids[at]
        best = int(cosine.argmax())
        language = int(self.owner[best])
        score = float(min(1.0, max(0.0, cosine[best])))
        return self.languages[language], score, bool(cosine[best] < self.limit[language])


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts, and of those with each bucket. One row per task is combined."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(1 << BUCKET_BITS, np.int64), 0
        for b in batches:
            for t in b.column(0).to_pylist():
                seen[gram_counts(t)[0]] += 1
                n += 1
        at = np.flatnonzero(seen)
        rows = [pa.array(np.append(at, -1)), pa.array(np.append(seen[at], n))]
        yield pa.RecordBatch.from_arrays(rows, ["bucket", "df"])

    counts = texts.select("text").mapInArrow(count, "bucket long, df long")
    df, n = np.zeros(1 << BUCKET_BITS), 0
    for r in counts.groupBy("bucket").agg(F.sum("df").alias("df")).collect():
        if r.bucket < 0:
            n = r.df
        else:
            df[r.bucket] = r.df
    return n, df


def _sample(train: DataFrame) -> list:
    """(lang, buckets, counts) of about SAMPLE_PER_LANGUAGE texts per language, by hash."""
    sizes = train.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    per = max(20, min(SAMPLE_PER_LANGUAGE, SAMPLE // max(1, sizes.count())))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("centroids")), F.lit(1 << 30)) / F.lit(float(1 << 30))

    @F.pandas_udf("struct<at: array<int>, n: array<float>>")
    def counts(texts: pd.Series) -> pd.DataFrame:
        found = [gram_counts(t) for t in texts]
        return pd.DataFrame(
            {"at": [a.astype(np.int32) for a, _ in found], "n": [c.astype(np.float32) for _, c in found]},
            index=texts.index,
        )

    # one row per language; the model keeps centroids of each language in memory anyway
    known = train.select("doc_id", "lang").where("doc_id is not null")
    ids = known.join(F.broadcast(sizes), "lang")
    picked = ids.where(draw < F.lit(float(per)) / F.col("n")).select("doc_id", "lang").distinct()
    # about SAMPLE ids, whatever the size of the table: the texts stay where they are
    kept = train.join(F.broadcast(picked), ["doc_id", "lang"])
    rows = kept.select("lang", "doc_id", counts.asNondeterministic()("text").alias("c"))
    return sorted(rows.select("lang", "doc_id", "c.at", "c.n").collect(), key=lambda r: (r.lang, r.doc_id is None, r.doc_id or 0, len(r["at"])))


def _cluster(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Unit centroids of the rows of ``x`` (spherical k-means, farthest-first start)."""
    start = [int(np.random.default_rng(seed).integers(len(x)))]
    near = x @ x[start[0]]
    while len(start) < k:
        start.append(int(near.argmin()))
        near = np.maximum(near, x @ x[start[-1]])
    centres = x[start]
    for _ in range(12):
        mine = (x @ centres.T).argmax(1)
        sums = np.stack([x[mine == c].sum(0) if (mine == c).any() else centres[c] for c in range(k)])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def fit(train: DataFrame, centroids: int = CENTROIDS, seed: int = 7) -> Model:
    """``train`` has doc_id, text and lang; rows without lang or text are left out."""
    train = train.select("doc_id", "text", "lang").where("lang is not null and text is not null")
    n, df = document_frequencies(train)
    idf = np.log((1 + n) / (1 + df)) + 0.1
    model = Model([], idf, np.zeros((len(df), 0), np.float32), np.zeros(0, np.int64), np.zeros(0))
    by_language: dict[str, list] = {}
    for r in _sample(train):
        if r["at"]:
            by_language.setdefault(r.lang, []).append((np.array(r["at"]), np.array(r["n"])))
    columns, owner, limits = [], [], []
    for i, (language, rows) in enumerate(sorted(by_language.items())):
        x = np.zeros((len(rows), len(df)), np.float32)
        for j, (at, c) in enumerate(rows):
            x[j, at] = np.log1p(c) * idf[at]
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        centres = _cluster(x, min(centroids, len(x)), seed)
        limits.append(float(np.quantile((x @ centres.T).max(1), REJECT)))
        columns.append(centres.T)
        owner += [i] * centres.shape[0]
    if columns:
        model.languages = sorted(by_language)
        model.centroids = np.concatenate(columns, axis=1)
        model.owner, model.limit = np.array(owner), np.array(limits)
    return model


def predict_column(text: Column | str, model: Model) -> Column:
    @F.pandas_udf("struct<lang_pred: string, score: double, rejected: boolean>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        rows = [model.predict(t) for t in texts]
        return pd.DataFrame(rows, columns=["lang_pred", "score", "rejected"], index=texts.index)

    return predict.asNondeterministic()(text)


def held_out(parts: int, left: int) -> Column:
    """Whether crc32 of the id as text falls on the part that is never learned from.

    Rows without an id count as held out, since no one can say what they are."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == left, F.lit(True))


def identify(docs: DataFrame, centroids: int = CENTROIDS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of each row.

    Learns from the rows that are not held out. lang_pred is ``und`` for a text that is null
    or has no letter, and for all if there is nothing to learn from. score is the cosine with
    the nearest centroid; ties go to the language that sorts first. Repeated rows are rows
    of their own; extra columns are ignored; an empty table gives no rows.
    """
    rows = docs.select("doc_id", "text", "lang")
    model = fit(rows.where(~held_out(4, 2)), centroids)
    scored = rows.select("doc_id", held_out(4, 2).alias("held_out"), predict_column("text", model).alias("p"))
    return scored.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.rejected")
