"""Table access: parquet folders, catalog tables, schema metadata."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ParquetTables:
    """Tables stored as ``<folder>/<name>.parquet``, opened lazily by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]


def catalog_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """Every table of a catalog database, by name."""
    return {t.name: spark.table(f"{database}.{t.name}") for t in spark.catalog.listTables(database)}


def describe_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Metadata as data: one row per column with its position and type, from the schemas alone."""
    rows = [
        (name, field.name, position, field.dataType.simpleString())
        for name, df in tables.items() for position, field in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, position int, data_type string")


def without(tables: Mapping[str, DataFrame], protected: Iterable[str]) -> dict[str, DataFrame]:
    """Tables that no listed constraint protects."""
    skip = set(protected)
    return {name: df for name, df in tables.items() if name not in skip}


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Calendar dimension with date, year_month and year_week."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(days).alias("date")).select(
        "date", F.date_format("date", "yyyy-MM").alias("year_month"),
        F.concat(F.extract(F.lit("YEAROFWEEK"), "date").cast("string"), F.lit("-"),
                 F.lpad(F.weekofyear("date").cast("string"), 2, "0")).alias("year_week"),
    )
