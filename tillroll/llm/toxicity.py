"""Toxicity by a linear classifier with a counterfactual penalty.

The features are the character n-grams of words that a text has at all. The loss is the
logistic loss over labelled texts plus the squared change of a sentence's score when an
identity term in it is swapped for another of its kind, so that a mention of a group does
not raise the score by itself. Labels are learned from a bounded sample; scoring reads whole
texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.langid import held_out
from tillroll.llm.text import CodeTable, folded, gram_codes_of, pieces
from tillroll.sources.workspace import stage

GRAMS = (4, 5, 6)
FEATURES = 2000
LEAST_TOXIC = 3  # texts a feature must occur in
SAMPLE_TOXIC, SAMPLE_CLEAN = 4000, 12000  # labelled texts to learn from, about, by hash
THRESHOLD = 0.7
PENALTY = 1.0
RIDGE = 0.5  # strength of the prior on the weights, over all labelled texts together
LEAST_GAIN = 5.0  # log-likelihood ratio that a feature must reach
_PIECE = 1 << 20
_SENTENCE = re.compile(r"[^.!?\n]+")

# Identity terms, swapped within a line.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("gay", "straight", "lesbian", "bisexual", "queer", "heterosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants"),
    ("black", "white", "asian", "hispanic", "african", "european", "arab", "indian"),
    ("american", "mexican", "chinese", "russian", "turkish", "polish", "french", "german"),
    ("blind", "deaf", "disabled", "elderly", "young", "immigrant", "refugee"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("schwul", "lesbisch", "bisexuell", "heterosexuell"),
    ("muslimisch", "christlich", "jüdisch", "hinduistisch", "buddhistisch"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulman", "chrétien", "juif", "hindou", "bouddhiste"),
    ("mujeres", "hombres", "chicas", "chicos"),
    ("musulmán", "cristiano", "judío", "hindú", "budista"),
)
_OTHERS = {t: [o for o in line if o != t] for line in IDENTITY_TERMS for t in line}
_TERM = re.compile(r"\b(" + "|".join(sorted(_OTHERS, key=len, reverse=True)) + r")\b", re.IGNORECASE)


def _codes(text: str | None) -> Iterator[np.ndarray]:
    for piece in pieces(folded(text, rim=1), _PIECE, max(GRAMS) - 1):
        yield from gram_codes_of(piece, GRAMS)


def features(text: str | None) -> np.ndarray:
    """Codes of the n-grams of a text, each once."""
    found = list(_codes(text))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def swapped(text: str | None) -> list[tuple[str, str]]:
    """The distinct sentences with an identity term, each with its counterfactual (all terms
    swapped). Which term comes in depends on the sentence alone.
    """
    pairs = {}
    for m in _SENTENCE.finditer(text or ""):
        sentence = m.group().strip()
        if sentence not in pairs and _TERM.search(sentence):
            turn = sum(map(ord, sentence))
            pairs[sentence] = _TERM.sub(lambda t: (o := _OTHERS[t.group().lower()])[turn % len(o)], sentence)
    return list(pairs.items())


@dataclass
class Model:
    table: CodeTable
    weights: np.ndarray
    bias: float

    def present(self, text: str | None) -> np.ndarray:
        found = [self.table.find(c)[1] for c in _codes(text)]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def score(self, text: str | None) -> float:
        z = self.bias + self.weights[self.present(text)].sum()
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


class _Sparse:
    """Rows of feature places, for products with a weight vector."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.width, self.n = width, len(rows)
        self.column = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, g[self.row], minlength=self.width)


def train(
    rows: list[np.ndarray],
    labels: np.ndarray,
    pairs: list[tuple[np.ndarray, np.ndarray]],
    width: int,
    penalty: float = PENALTY,
    steps: int = 800,
) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam on the penalised loss."""
    x = _Sparse(rows, width)
    a, b = _Sparse([p for p, _ in pairs], width), _Sparse([q for _, q in pairs], width)
    y = np.asarray(labels, float)
    rate = np.clip(y.mean() if len(y) else 0.0, 1e-3, 0.5)
    w, bias = np.zeros(width), float(np.log(rate / (1 - rate)))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x.dot(w) + bias, -500, 500)))
        e = (p - y) / max(len(y), 1)
        g = x.back(e) + RIDGE / max(len(y), 1) * w
        if pairs:
            change = 2 * penalty * (a.dot(w) - b.dot(w)) / len(pairs)
            g += a.back(change) - b.back(change)
        full = np.append(g, e.sum())
        m = 0.9 * m + 0.1 * full
        v = 0.999 * v + 0.001 * full**2
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w -= step[:-1]
        bias -= step[-1]
    return w, bias


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, doc_id, toxic) of a bounded number of labelled texts, each text once.

    A text has the smallest id and the highest label of its documents."""
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out(3, 1))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    n = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.when(F.col("toxic") == 1, F.lit(SAMPLE_TOXIC / max(n.get(1, 0), 1))).otherwise(
        F.lit(SAMPLE_CLEAN / max(n.get(0, 0), 1))
    )
    # about SAMPLE_TOXIC + SAMPLE_CLEAN ids at any size of the table
    picked = F.broadcast(known.where(draw < share))
    texts = docs.select("doc_id", "text").where("text is not null")
    found = texts.join(picked, "doc_id").groupBy("text")
    return found.agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))


def _counts(sample: DataFrame, known: CodeTable | None) -> dict[int, tuple[int, int]]:
    """Texts with each feature, as clean and toxic counts; of the features known, if given."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for toxic in (0, 1):
                texts = [t for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if y == toxic]
                found = [features(t) for t in texts]
                if known is not None:
                    found = [f[known.find(f)[0]] for f in found]
                if found:
                    codes, n = np.unique(np.concatenate(found), return_counts=True)
                    rows = [pa.array(codes.view(np.int64)), pa.array(np.full(len(codes), toxic, np.int32)), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(rows, ["code", "toxic", "n"])

    counted = sample.select("text", "toxic").mapInArrow(count, "code long, toxic int, n long")
    sums = counted.groupBy("code").agg(
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
    )
    if known is None:  # a bounded sample has a bounded number of these
        sums = sums.where(F.col("bad") >= LEAST_TOXIC).orderBy(F.desc("bad"), "code").limit(25 * FEATURES)
    return {r.code: (r.clean, r.bad) for r in sums.collect()}


def _gain(clean: np.ndarray, bad: np.ndarray, n_clean: int, n_bad: int) -> np.ndarray:
    """Signed likelihood ratio: how much a feature says for the toxic class."""
    n = n_clean + n_bad
    out = np.zeros(len(bad))
    for seen, size in ((bad, n_bad), (n_bad - bad, n_bad), (clean, n_clean), (n_clean - clean, n_clean)):
        whole = bad + clean if seen is bad or seen is clean else n - bad - clean
        with np.errstate(divide="ignore", invalid="ignore"):
            part = seen * np.log(seen * n / (whole * size))
        out += np.nan_to_num(part)
    return np.where(bad * n_clean > clean * n_bad, out, -out)


def fit(docs: DataFrame, labels: DataFrame, penalty: float = PENALTY) -> Model:
    """``labels`` has doc_id and toxic; of several labels of a document the highest counts."""
    empty = Model(CodeTable(np.zeros(0, np.uint64)), np.zeros(0), -4.0)
    sample = stage(_sample(docs, labels), "labelled")
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(1):
        return empty
    candidates = _counts(sample.where("toxic = 1"), None)
    if not candidates:
        return empty
    table = CodeTable(np.array(list(candidates), np.int64).view(np.uint64))
    counted = _counts(sample, table)
    codes = np.array(sorted(counted), np.int64)
    clean, bad = np.array([counted[c] for c in codes.tolist()]).T
    gain = _gain(clean, bad, sizes.get(0, 0), sizes[1])
    telling = np.flatnonzero(gain >= LEAST_GAIN)
    best = codes[telling[np.argsort(-gain[telling], kind="stable")]][:FEATURES]
    model = Model(CodeTable(best.view(np.uint64)), np.zeros(len(best)), 0.0)

    @F.pandas_udf("struct<at: array<int>, pairs: array<struct<a: array<int>, b: array<int>>>>")
    def encode(texts: pd.Series) -> pd.DataFrame:
        small = lambda t: model.present(t).astype(np.int32).tolist()
        pairs = [[{"a": small(a), "b": small(b)} for a, b in swapped(t)] for t in texts]
        return pd.DataFrame({"at": [small(t) for t in texts], "pairs": pairs}, index=texts.index)

    rows = sample.select("doc_id", "toxic", encode.asNondeterministic()("text").alias("f"))
    learned = sorted(rows.select("doc_id", "toxic", "f.at", "f.pairs").collect(), key=lambda r: r.doc_id)
    pairs = [(np.array(p.a, int), np.array(p.b, int)) for r in learned for p in r.pairs]
    w, bias = train(
        [np.array(r["at"], int) for r in learned],
        np.array([r.toxic for r in learned]),
        pairs,
        len(model.table.codes),
        penalty,
    )
    return Model(model.table, w, bias)


def score_column(text: Column | str, model: Model) -> Column:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], index=texts.index, dtype="float64")

    return score.asNondeterministic()(text)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row.

    Null and empty texts get the score of a text without features. Without labels, or
    without toxic ones, every score is low. Repeated rows are rows of their own; extra
    columns are ignored; an empty table gives no rows.
    """
    slim = docs.select("doc_id", "text")
    model = fit(slim, labels)
    scored = slim.select("doc_id", held_out(3, 1).alias("held_out"), score_column("text", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that are classified as toxic. Columns stay."""
    model = fit(docs.select("doc_id", "text"), labels)
    return docs.where(score_column("text", model) < THRESHOLD)
