"""Join forms that keep every row, survive hot keys and stay hash or merge joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, freed_shuffles

# rows of a dictionary or of totals that every task can hold
FEW = 10_000


def few_rows(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept, and marked for broadcast where it has ``FEW`` rows at most, counted first.

    A join on few keys fills few partitions of a shuffle. Adaptive execution then leaves it a merge join however small one
    side is, and a task reads all rows of a key. More rows than that are left to a shuffle.
    """
    kept = cut_lineage(df)
    with freed_shuffles(df.sparkSession):
        few = kept.limit(FEW + 1).count() <= FEW
    return F.broadcast(kept) if few else kept


def equal(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a] == right[b] for a, b in pairs])


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, names: dict[str, str]) -> DataFrame:
    """Left join to a dictionary for a few of its columns, under new names.

    The same dictionary can be used in several roles. Whether it is broadcast
    is decided by Spark from its measured size.
    """
    side = dim.select(F.col(dim_key).alias("__dim_key"), *[F.col(a).alias(b) for a, b in names.items()])
    return df.join(side, df[key] == side["__dim_key"], "left").drop("__dim_key")


def link_full_join(one: DataFrame, many: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Full outer join of a document side with the side that points to it.

    ``pairs`` are (column of ``one``, column of ``many``). Both sides are computed once and kept, so a chain of links reads
    every source a fixed number of times however long it is. Adaptive execution cannot split a full outer join. Here the
    pointing side is the preserved side of a left join, whose hot keys it cuts by rows, and the documents that
    nothing points to are added by an anti join against the distinct keys. Rows with a NULL key never match: those of
    ``many`` keep no document, those of ``one`` are among the added.
    """
    one, many = cut_lineage(one), cut_lineage(many)
    # without the rows that never match, both joins deal out the same rows, and one shuffle serves both; said as the
    # joins themselves would say it, since they add nothing then and the two sides stay equal
    keyless = reduce(lambda a, b: a | b, [F.col(a).isNull() for a, _ in pairs])
    keyed = one.where(reduce(lambda a, b: a & b, [F.col(a).isNotNull() for a, _ in pairs]))
    unkeyed = one.where(keyless)
    back = [(b, a) for a, b in pairs]
    linked = many.join(keyed, equal(many, keyed, back), "left").select(*one.columns, *many.columns)
    met = many.select(*[F.col(b).alias(f"__m{i}") for i, (_, b) in enumerate(pairs)]).dropna().distinct()
    alone = keyed.join(met, equal(keyed, met, [(a, f"__m{i}") for i, (a, _) in enumerate(pairs)]), "left_anti")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in many.schema.fields]
    return linked.unionByName(alone.unionByName(unkeyed).select(*one.columns, *nothing))


def within_seconds(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], left_time: str, right_time: str, seconds: int
) -> DataFrame:
    """Left join on equal keys and times less than ``seconds`` apart.

    Times are cut into buckets of that width; the right side is offered to its
    own bucket and both neighbours. The bucket is part of the key, so one busy
    number does not meet all its own rows.
    """
    def bucket(col: Column) -> Column:
        return F.floor(F.unix_micros(col.cast("timestamp")) / (seconds * 1_000_000)).cast("long")

    probe = left.withColumn("__bucket", bucket(F.col(left_time)))
    offered = right.withColumn("__own", bucket(F.col(right_time))).withColumn(
        "__near", F.explode(F.array(F.col("__own") - 1, F.col("__own"), F.col("__own") + 1))
    ).drop("__own")
    apart = F.abs(
        F.unix_micros(probe[left_time].cast("timestamp")) - F.unix_micros(offered[right_time].cast("timestamp"))
    )
    on = equal(probe, offered, pairs) & (probe["__bucket"] == offered["__near"]) & (apart < seconds * 1_000_000)
    return probe.join(offered, on, "left").drop("__bucket", "__near")


def match_counts(
    df: DataFrame, dim: DataFrame, first: tuple[str, str], second: tuple[str, str], flag: Column,
) -> DataFrame:
    """How often each row meets ``dim`` under ``first OR second`` equality.

    Adds ``matches`` (number of dictionary rows that meet either equality) and
    ``flagged`` (how many of them carry ``flag``). Counted by inclusion and
    exclusion over three pre-aggregated lookups, instead of an OR join whose
    only physical plan is a nested loop and whose rows multiply.
    """
    marked = dim.withColumn("__flag", flag.cast("long"))
    result = df
    parts = []
    for n, pairs in enumerate([[first], [second], [first, second]]):
        counted = marked.groupBy(*[F.col(b).alias(f"__d{n}_{b}") for _, b in pairs]).agg(
            F.count(F.lit(1)).alias(f"__n{n}"), F.sum("__flag").alias(f"__f{n}")
        )
        on = reduce(lambda a, b: a & b, [result[a] == counted[f"__d{n}_{b}"] for a, b in pairs])
        result = result.join(counted, on, "left").drop(*[f"__d{n}_{b}" for _, b in pairs])
        parts.append((F.coalesce(F.col(f"__n{n}"), F.lit(0)), F.coalesce(F.col(f"__f{n}"), F.lit(0))))
    return (
        result.withColumn("matches", parts[0][0] + parts[1][0] - parts[2][0])
        .withColumn("flagged", parts[0][1] + parts[1][1] - parts[2][1])
        .drop(*[f"__{k}{n}" for n in range(3) for k in "nf"])
    )
