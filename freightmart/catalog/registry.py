"""Named queries over the test tables, each next to the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import ParquetTables

AS_OF = "2001-12-01"


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[ParquetTables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return portable(self.build(ParquetTables(spark, folder)))


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function of the tables under its own name."""
    def register(build: Callable[[ParquetTables], DataFrame]):
        QUERIES[build.__name__] = Query(build.__name__, build, sql)
        return build
    return register


def portable(df: DataFrame) -> DataFrame:
    """Types every SQL engine shares: long, double and text."""
    columns = []
    for field in df.schema.fields:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            col = col.cast("double")
        elif isinstance(kind, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("long")
        elif isinstance(kind, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        columns.append(col.alias(field.name))
    return df.select(*columns)


def money(col: str):
    return F.col(col).cast("decimal(18,2)")


def text(col: str):
    return F.col(col).cast("string")
