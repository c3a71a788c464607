"""The named queries of this subpackage, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import (
    ann,
    decontam,
    htmltext,
    langid,
    lexical,
    mixing,
    ngram,
    repair,
    sharding,
    simhash,
    tokencount,
    tokenfile,
    toxicity,
)
from tillroll.llm.inputs import table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16("fp").alias("fingerprint"), "component_id")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.tokenize(table(spark, sf_dir, "documents"), WORD_BPE)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), PIECES)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audit(table(spark, sf_dir, "conversations"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.perplexities(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_language_id,
        op3_toxicity,
        op4_simhash,
        op5_token_files,
        op6_token_counts,
        op7_html_text,
        op8_sharding,
        op9_mixing,
        op10_nearest,
        op11_repair,
        op12_lexical,
        op13_ngram_lm,
    )
}
_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

#: The other operators are no SQL (hashes, models, files); they are held against brute force in tests/llm.
ORACLES: dict[str, str] = {
    "op12_lexical": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
            tf AS (SELECT r, doc_id, n, term, count(*) AS tf
                   FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
            corpus AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS length FROM d
                       WHERE len(terms) > 0),
            w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1)))
                      AS BIGINT) AS w
                  FROM tf, corpus GROUP BY term, docs),
            asked AS (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark),
            scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf)
                           // (1000 * tf + 8 * (25 + (75 * n * docs) // length)))) AS BIGINT) AS score
                       FROM asked JOIN tf USING (term) JOIN w USING (term), corpus
                       GROUP BY item_id, r, doc_id)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)
                   AS INTEGER) AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 10""",
}
