"""From raw documents to packed training sequences.

Each stage takes what the one before has kept, written as Parquet below the checkpoint folder and
read again, and deleted once the next one has written what it keeps. All but the last return the
columns of ``documents``; the last returns a row for each piece of a packed sequence. A row without
an id cannot be told from others and goes in the first stage. Empty tables go through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.jaccard_join import near_duplicates
from millrace.llm.language import UNKNOWN, fit, predict
from millrace.llm.packing import pack
from millrace.llm.quality import judged_rows
from millrace.llm.substring_dedup import remove_repeats
from millrace.session import discard, durable

#: A language that is less likely than this is a guess. Half and half texts stay.
LEAST_SCORE = 0.4


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or their language's perplexity band go."""
    return judged_rows(docs, docs.columns).filter("kept").select("row.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those that are in no language the network has learned.

    Where no row has a language there is nothing to learn, and all with a letter stay.
    """
    model = fit(docs)
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    told = predict(docs, model, docs.columns)
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return told.filter(known).select(docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that similarity links, directly or in steps, the one with the smallest id stays."""
    first = near_duplicates(docs, size=5, per_cent=80).filter("component_id = doc_id")
    kept = docs.join(first.select("doc_id").distinct(), "doc_id", "left_semi")
    return kept.dropDuplicates(["doc_id"]).select(docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 and more words that stand in more than one place are cut out of the texts."""
    cut = remove_repeats(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind))
    return cut.select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts' tokens in as few sequences of 2048 as best fit finds."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: The stages learn models, find components and pack, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = durable(stage(spark, docs, sf_dir), name)
        discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
