"""Which columns of which tables share values.

One job instead of a probe per pair of columns: every candidate column is
reduced to its distinct values, values are grouped once, and each value yields
the set of columns it occurs in. Sets are de-duplicated before they are turned
into pairs, so pairing works on catalog-sized data whatever the tables hold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import literals as fixed

PAIR_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("rel_table_name", T.StringType()),
    T.StructField("rel_column_name", T.StringType()),
])


def candidate_columns(
    tables: Mapping[str, DataFrame], suffix: str = "", skipped: Sequence[str] = tuple(fixed.RELATION_SKIPPED_COLUMNS)
) -> dict[str, list[str]]:
    """Columns worth comparing, read from the table schemas alone."""
    return {
        name: [c for c in df.columns if c.endswith(suffix) and c not in skipped] for name, df in tables.items()
    }


def catalog_frame(spark: SparkSession, candidates: Mapping[str, Sequence[str]]) -> DataFrame:
    rows = [(t, c) for t, columns in candidates.items() for c in columns]
    return spark.createDataFrame(rows, "table_name string, column_name string")


def column_values(tables: Mapping[str, DataFrame], candidates: Mapping[str, Sequence[str]]) -> DataFrame:
    """Distinct (table, column, value) of all candidates; each table is scanned once."""
    parts = None
    for name, columns in candidates.items():
        if not columns:
            continue
        cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
        part = (
            tables[name].select(F.explode(cells).alias("cell"))
            .select(F.lit(name).alias("table_name"), F.col("cell.c").alias("column_name"), F.col("cell.v").alias("value"))
            .where(F.col("value").isNotNull())
            .distinct()
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def only_zero_columns(values: DataFrame) -> DataFrame:
    """Columns whose only value is the zero reference: they would relate to everything."""
    return (
        values.groupBy("table_name", "column_name")
        .agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("v"))
        .where((F.col("n") == 1) & (F.col("v") == fixed.ZERO_REF))
        .select("table_name", "column_name")
    )


def pairs_of(values: DataFrame) -> DataFrame:
    """Ordered pairs of columns of different tables that share one of the ``values``, both directions."""
    sets = (
        values.groupBy("value")
        .agg(F.array_sort(F.collect_set(F.struct("table_name", "column_name"))).alias("places"))
        .where(F.size("places") > 1)
        .select("places").distinct()
    )
    return (
        sets.select(F.explode("places").alias("a"), "places")
        .select("a", F.explode("places").alias("b"))
        .where(F.col("a.table_name") != F.col("b.table_name"))
        .select(
            F.col("a.table_name").alias("table_name"), F.col("a.column_name").alias("column_name"),
            F.col("b.table_name").alias("rel_table_name"), F.col("b.column_name").alias("rel_column_name"),
        )
        .distinct()
    )


def index_values(tables: Mapping[str, DataFrame], candidates: Mapping[str, Sequence[str]]) -> DataFrame:
    """Which column holds which value: what is stored for later rounds. The zero reference relates nothing."""
    return column_values(tables, candidates).where(F.col("value") != fixed.ZERO_REF)


def related_pairs(tables: Mapping[str, DataFrame], candidates: Mapping[str, Sequence[str]]) -> DataFrame:
    """Pairs of all tables from one scan of each."""
    return pairs_of(index_values(tables, candidates))


def pairs_with_new(index: DataFrame, fresh: DataFrame) -> DataFrame:
    """Pairs that involve a column of ``fresh``; both frames as ``index_values`` gives them, of different tables.

    Of the stored values only those that the new tables hold as well are met, by a semi join; no old table is read.
    """
    met = index.join(fresh.select("value").distinct(), "value", "left_semi")
    new = fresh.select("table_name").distinct()
    pairs = pairs_of(fresh.unionByName(met.select(*fresh.columns)))
    here = pairs.join(new, "table_name", "left_semi")
    there = pairs.join(new.withColumnRenamed("table_name", "rel_table_name"), "rel_table_name", "left_semi")
    return here.unionByName(there.select(*here.columns)).distinct()


def with_lonely(pairs: DataFrame, columns: DataFrame) -> DataFrame:
    """The pairs, and a row without a partner for each of the ``columns`` that is in none."""
    lonely = columns.join(pairs.select("table_name", "column_name").distinct(), ["table_name", "column_name"], "left_anti").select(
        "table_name", "column_name", F.lit(None).cast("string").alias("rel_table_name"), F.lit(None).cast("string").alias("rel_column_name"))
    return pairs.select(*lonely.columns).unionByName(lonely)


def column_relations(tables: Mapping[str, DataFrame], candidates: Mapping[str, Sequence[str]]) -> DataFrame:
    """Related pairs, plus a row without a partner for every candidate that has none."""
    spark = next(iter(tables.values())).sparkSession
    return with_lonely(related_pairs(tables, candidates), catalog_frame(spark, candidates))


#: Parts of the hash space of values in which a pair of columns is probed, one after the other.
PROBES = [(0, 1), (1, 16), (16, 256)]


def shared_value(left: DataFrame, left_column: str, right: DataFrame, right_column: str) -> str | None:
    """A value that both columns hold, or None; the zero reference does not count.

    Related columns mostly share many values, so a small part of the values is joined first and the probe ends where it
    meets one. Only a pair without any shared value is compared whole.
    """
    def part(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
        value = df.select(F.col(column).cast("string").alias("value")).where(F.col("value") != fixed.ZERO_REF)
        return value.where(F.pmod(F.xxhash64("value"), F.lit(PROBES[-1][1])).between(low, high - 1))

    for low, high in PROBES:
        met = part(left, left_column, low, high).join(part(right, right_column, low, high).distinct(), "value", "left_semi").head()
        if met is not None:
            return met.value
    return None


def probe_pairs(tables: Mapping[str, DataFrame], pairs: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """For each pair (table, column, table, column) whether the columns share a value."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(*pair, shared_value(tables[pair[0]], pair[1], tables[pair[2]], pair[3]) is not None) for pair in pairs]
    return spark.createDataFrame(rows, "table_name string, column_name string, rel_table_name string, rel_column_name string, related boolean")


def tables_not_covered(tables: Sequence[str], stored: DataFrame) -> list[str]:
    """Names of tables without a stored relation row; the list is as long as the catalog."""
    spark = stored.sparkSession
    named = spark.createDataFrame([(t,) for t in tables], "table_name string")
    known = stored.select("table_name").distinct()
    return sorted(r.table_name for r in named.join(known, "table_name", "left_anti").toLocalIterator())


def data_dictionary(relations: DataFrame, schema_prefix: str = "") -> DataFrame:
    """Per column, the related ``table.column`` names as one comment text."""
    def plain(col: str):
        return F.replace(F.col(col), F.lit(schema_prefix), F.lit("")) if schema_prefix else F.col(col)

    partner = F.concat(plain("rel_table_name"), F.lit("."), plain("rel_column_name"))
    return (
        relations.where(F.col("rel_table_name").isNotNull() & F.col("rel_column_name").isNotNull())
        .withColumn("partner", partner)
        .groupBy("table_name", "column_name")
        .agg(F.expr("listagg(partner, '; ') WITHIN GROUP (ORDER BY partner)").alias("comment"))
    )
