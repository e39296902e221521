"""The corpus pipeline: five stages over ``documents``, each working on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freightmart.llm.base import keep, ship
from freightmart.llm.packing import best_fit_packing
from freightmart.llm.partenum import BROADCAST_ROWS, linked_rows, with_class
from freightmart.llm.pii import fit_pii, without_personal_data
from freightmart.llm.quality import fit_quality, quality_scores
from freightmart.llm.toxicity import fit_toxicity, toxicity_grades

# Trained models and iterated joins: no stage but the last is SQL.
ORACLE_SQL = None


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def same_columns(kept: DataFrame, docs: DataFrame) -> DataFrame:
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    ship(spark)
    model = fit_quality(docs, labels(spark, sf_dir))
    return same_columns(quality_scores(docs, model, *docs.columns).where("__predicted = 1"), docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal regression does not grade as toxic."""
    ship(spark)
    model = fit_toxicity(docs, labels(spark, sf_dir))
    return same_columns(toxicity_grades(docs, model, *docs.columns).where("__toxic = 0"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one row of the least doc_id; rows without a doc_id or without words all stay.

    Each row is decided on by its own text: of rows that share a doc_id those stay that are linked with nothing. Of several
    rows of the least doc_id in a group the one with the least class_id, then the least text stays.
    """
    ship(spark)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    links = keep(linked_rows(docs).where("doc_id is not null"))
    state = keep(links.groupBy("doc_id").agg((F.count("*") > 1).alias("repeated"), F.max(F.col("doc_id") != F.col("component_id")).alias("copy")).where("repeated or copy"))
    few = state.count() <= BROADCAST_ROWS
    side = F.broadcast(state.select("doc_id")) if few else state.select("doc_id")
    stay = docs.join(side, "doc_id", "left_anti").select(*columns)
    repeated = state.where("repeated").select("doc_id")
    if repeated.isEmpty():
        return stay
    repeated = F.broadcast(repeated) if few else repeated
    decided = links.where("class_id is not null").join(repeated, "doc_id", "left_semi").select(
        F.col("doc_id").alias("__doc"), F.col("class_id").alias("__class"), F.col("component_id").alias("__least"), F.col("group_id").alias("__group")).distinct()
    rows = with_class(docs.join(repeated, "doc_id", "left_semi").select(*columns), "__own")
    rows = rows.join(decided, (F.col("doc_id") == F.col("__doc")) & (F.col("__own") == F.col("__class")), "left")
    first = Window.partitionBy("__group").orderBy("__own", "text")
    one = rows.where("__own is not null and doc_id = __least").withColumn("__n", F.row_number().over(first)).where("__n = 1")
    return stay.unionByName(rows.where("__own is null").select(*columns)).unionByName(one.select(*columns))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data replaced by its kind, n_chars counted again."""
    ship(spark)
    return without_personal_data(docs, fit_pii(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their places in training sequences."""
    ship(spark)
    return best_fit_packing(docs)


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what a stage keeps is checkpointed for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
