"""From documents to packed sequences: toxic documents, repeated lines and near copies go, personal data
is replaced, the rest is packed.  Each stage is written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillmill.llm import bin_slack, line_windows, ngram_join, surrogates, toxicity
from skillmill.llm.common import ship, stored, table
from skillmill.llm.queries import held_out, surrogate_key


def resized(docs: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, ``n_chars`` counted anew where there is one."""
    columns = [F.col(f"`{c}`") for c in like.columns]
    if "n_chars" in like.columns:
        kind = like.schema["n_chars"].dataType
        columns = [F.length("text").cast(kind).alias("n_chars") if c == "n_chars" else F.col(f"`{c}`") for c in like.columns]
    return docs.select(*columns)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, table(ship(spark), sf_dir, "labels"), ~held_out(3, 1))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = line_windows.drop_repeated_windows(docs)
    # Of a document of nothing but lines that came before, nothing is left to pack.
    emptied = (F.col("n_removed") > 0) & (F.col("text") == "")
    return resized(found.where(~F.coalesce(emptied, F.lit(False))), docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies: five-word shingles, similarity 0.8 or more."""
    ship(spark)
    return ngram_join.keep_one(docs, shingle=5, percent=80)


def replace_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return resized(surrogates.with_surrogates(docs, surrogate_key(spark)), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return bin_slack.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", clean),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", dedup_documents),
    ("PII", replace_personal),
    ("best-fit packing", pack),
]

#: Learned scores and tokens cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
