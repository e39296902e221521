"""Exact duplicates by progressive refinement: length, then a hash of the beginning, then a hash of the whole text.

Each round counts the rows of a key and writes down which keys occur more than once in a bit filter of fixed size, which
is broadcast. A row that the filter does not know is alone and leaves the race; a false hit costs one more hash and
decides nothing. No text is shuffled: only ids, lengths and hashes are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import keep, pick

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters of the beginning that are hashed in the second round.
PREFIX = 64
#: Bits of a filter; as 64-bit words it has FILTER_BITS / 64 rows at most, whatever the size of the table.
FILTER_BITS = 1 << 26
#: Groups above this share of all rows are joined by broadcast: there are HOT_PARTS of them at most.
HOT_PARTS = 1000


def normal(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, UPPER, LOWER)


def _slot(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))


def repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The bit filter of all keys that more than one row has: 64-bit words by their number."""
    twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(_slot(keys).alias("slot"))
    bits = F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))")
    return twice.groupBy(F.expr("slot div 64").alias("word")).agg(bits.alias("bits"))


def mark(rows: DataFrame, keys: list[str], filter_: DataFrame, out: str) -> DataFrame:
    """Whether the filter knows a row's key."""
    found = rows.withColumn("slot", _slot(keys)).withColumn("word", F.expr("slot div 64"))
    found = found.join(F.broadcast(filter_), "word", "left")
    return found.withColumn(out, F.expr("coalesce(getbit(bits, cast(slot % 64 as int)) = 1, false)")).drop("slot", "word", "bits")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", digest_all: bool = False) -> DataFrame:
    """doc_id, keep_id, group_size, kept and digest (SHA-256 of the normalised text) of every row.

    Texts are equal when they are identical after lower-casing A-Z. Of equal texts the row with the largest id stays:
    ``kept`` is true for exactly one row of a group, of repeated rows with that id for one of them. A null text counts as
    empty, and all empty texts are equal. A null id is smaller than any other; ``keep_id`` is null only where no row of
    the group has an id. The digest of a row that an earlier round found to be alone is null unless ``digest_all`` asks
    for it. Texts of any length are hashed whole by one expression. Other columns are not looked at, an empty table gives
    an empty result.
    """
    rows = pick(docs, id=f"{id_column} bigint", body=f"{text_column} string")
    rows = rows.withColumn("body", F.coalesce("body", F.lit(""))).withColumn("bytes", F.octet_length("body"))
    sized = mark(rows, ["bytes"], repeated(rows, ["bytes"]), "same_length")
    sized = sized.withColumn("prefix", F.when(F.col("same_length"), F.xxhash64(normal(F.substring("body", 1, PREFIX)))))
    begun = mark(sized, ["bytes", "prefix"], repeated(sized.where("same_length"), ["bytes", "prefix"]), "same_prefix")
    survives = F.col("same_length") & F.col("same_prefix")
    whole = F.unhex(F.sha2(normal(F.col("body")), 256))
    state = keep(begun.select(
        "id", F.monotonically_increasing_id().alias("row"), "bytes", "prefix", survives.alias("survives"),
        (whole if digest_all else F.when(survives, whole)).alias("digest")))

    key = ["bytes", "prefix", "digest"]
    groups = keep(
        state.where("survives").groupBy(*key)
        .agg(F.max(F.struct("id", (-F.col("row")).alias("row"))).alias("top"), F.count(F.lit(1)).alias("size")).where("size > 1")
        .select(*key, F.col("top.id").alias("keep_id"), (-F.col("top.row")).alias("keep_row"), "size"))
    # a group of very many copies would fill one task of a join by hash
    hot = F.broadcast(groups.where(F.col("size") * HOT_PARTS > state.count()))
    racing = state.where("survives")
    joined = [
        racing.join(hot, key),
        racing.join(hot, key, "left_anti").join(groups, key, "left"),
        state.where("not survives").withColumns({
            "keep_id": F.lit(None).cast("bigint"), "keep_row": F.lit(None).cast("bigint"), "size": F.lit(None).cast("bigint")}),
    ]
    columns = ["id", "row", "digest", "keep_id", "keep_row", "size"]
    every = joined[0].select(*columns).unionByName(joined[1].select(*columns)).unionByName(joined[2].select(*columns))
    grouped = F.col("size").isNotNull()
    return every.select(
        F.col("id").alias("doc_id"),
        F.when(grouped, F.col("keep_id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("bigint")).alias("group_size"),
        F.when(grouped, F.col("row") == F.col("keep_row")).otherwise(F.lit(True)).alias("kept"),
        "digest",
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """Of every document the row that stays in its place, the size of its group and the digest of its text in hex."""
    found = exact_duplicates(docs, digest_all=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
