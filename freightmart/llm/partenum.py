"""N-gram Jaccard join by PartEnum signatures.

Sets of word shingles with sizes in one band differ in at most k elements if they are similar enough. The domain of
shingle hashes is cut into partitions; each difference spoils one partition, so two similar sets agree on the contents
of all but k. In the terms of PartEnum a first-level partition is cut in n2 = 2 and may hold k2 = 1 difference; every
subset of n2 - k2 = 1 of its parts is a signature: the content of one part, no larger subsets are enumerated. In bands of
up to SINGLE elements every element is a signature, an inverted index with overlap counts. Signatures that very many sets
share are left out; where the others of both sets are too few to prove a link, the sets' rarest elements take their place:
two similar sets share one that is not among the most shared 3/4 of either. What shares enough is verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from ..session import cut_lineage
from .base import pick, steps
from .components import components

WORDS = 5
#: Similarity as a fraction: 3/4.
UP, DOWN = 3, 4
#: Bands of sizes grow by this factor; up to SINGLE elements every element is a partition of its own, above a
#: partition of the band's largest sets holds so many elements.
BAND, SINGLE, ELEMENTS = 3, 80, 2.2
#: A signature that more sets share is hot: sets that lack enough others are looked up by their rarest elements.
HOT = 32
#: Signatures that a task gathers before it deals them out to buckets, and documents for each bucket.
FLUSH, BUCKET_DOCS = 1_500_000, 8192
#: Shared signatures of pairs that are verified first.
LIKELY = 3
#: Pairs for each row of the open groups up to which all of them are counted.
FEW_PAIRS = 40
#: So many counted rows at most are broadcast.
BROADCAST_ROWS = 1_000_000
#: Rounds of pivots before all pairs between unlinked parts of the remaining groups are verified: one pivot a group of
#: sets that share signatures, so many a group of any size that share an element.
PIVOT_ROUNDS, PIVOTS = 2, 8

_BANDS = np.array([BAND**i for i in range(33)], np.int64)


def differences(n: np.ndarray, top: np.ndarray) -> np.ndarray:
    """The most elements in which a set of n differs from a similar one of at most ``top``: similar sets of a and b
    elements differ in (a + b) * (DOWN - UP) / (DOWN + UP) at most."""
    return (n + np.minimum(top, n * DOWN // UP)) * (DOWN - UP) // (DOWN + UP)


def signatures(values: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, their signatures' rows, the signatures, and what each row has beyond its k, for each kind of signature.

    The kind is in a signature's lowest 6 bits: the band, or the band + 32 for the single elements of sets whose
    elements happened to fall into too few partitions.
    """
    n = np.diff(offsets)
    band = np.searchsorted(_BANDS, n, "right") - 1
    passes = [(np.flatnonzero(n > 0), 0, False), (np.flatnonzero((n > 0) & (n * DOWN >= _BANDS[band + 1] * UP)), 1, False)]
    while passes:
        rows, up, alone = passes.pop(0)
        if not len(rows):
            continue
        size, own = n[rows], band[rows] + up
        top = _BANDS[own + 1] - 1
        parts = np.where((top <= SINGLE) | alone, 0, np.ceil(top / ELEMENTS)).astype(np.uint64)
        begins = np.cumsum(size) - size
        at = np.arange(size.sum()) - np.repeat(begins, size) + np.repeat(offsets[rows], size)
        value, count = values[at], np.repeat(parts, size)
        part = ((value >> np.uint64(32)) * count) >> np.uint64(32)
        new = count == 0
        new[1:] |= part[1:] != part[:-1]
        new[begins] = True
        first = np.flatnonzero(new)
        owner = np.repeat(np.arange(len(rows)), size)[first]
        kind = own + 32 * alone
        content = W.mix(np.add.reduceat(W.mix(value + np.uint64(1)), first) + kind[owner].astype(np.uint64))
        made = (content & ~np.uint64(63)) | kind[owner].astype(np.uint64)
        beyond = np.bincount(owner, minlength=len(rows)) - differences(size, top)
        if not alone and (beyond <= 0).any():
            passes.append((rows[beyond <= 0], up, True))
        yield rows, rows[owner], made, np.stack([kind, beyond], axis=1)


def elements(values: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Like signatures, with every element as a signature of one kind for sets of any size."""
    n = np.diff(offsets)
    yield np.arange(len(n)), np.repeat(np.arange(len(n)), n), W.mix(values + np.uint64(1)), np.zeros((len(n), 2), np.int64)


def sets_of(batch: pa.RecordBatch, text: int) -> tuple[np.ndarray, np.ndarray]:
    texts = W.Texts.of(batch.column(text))
    data = W.lower(texts.data)
    found = W.words(texts)
    return W.distinct(*W.shingles(W.hashes(data, found.start, found.end), found.per_row(texts.rows), WORDS))


def set_keys(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each row's set."""
    full = np.flatnonzero(np.diff(offsets))
    out = [np.zeros(len(offsets) - 1, np.uint64) for _ in range(2)]
    for key, salt in zip(out, (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03), strict=True):
        if len(full):
            key[full] = np.add.reduceat(W.mix(values + np.uint64(salt)), offsets[:-1][full])
    return out[0].view(np.int64), out[1].view(np.int64)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, size and two keys of each document's set, and what its signatures have beyond k: (kind, beyond) pairs."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 1):
            values, offsets = sets_of(batch, 1)
            key, key2 = set_keys(values, offsets)
            slack: list[list[int]] = [[] for _ in range(batch.num_rows)]
            for rows, _, _, beyond in signatures(values, offsets):
                for row, pair in zip(rows.tolist(), beyond.tolist(), strict=True):
                    slack[row] += pair
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(key), pa.array(key2), pa.array(slack, pa.list_(pa.int32()))],
                ["doc_id", "n_shingles", "key", "key2", "slack"])

    return docs.mapInArrow(made, "doc_id bigint, n_shingles bigint, key bigint, key2 bigint, slack array<int>")


def dealt(docs: DataFrame, buckets: int, signs: Callable = signatures) -> DataFrame:
    """All signatures by bucket, packed: 40 bits of each, and the sets' keys with the number of signatures in a row."""

    def flush(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        key, made = (np.concatenate(x) for x in zip(*parts, strict=True))
        bucket = ((made >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        order = np.argsort(bucket.astype(np.uint32), kind="stable")
        key, made, bucket = key[order], made[order], bucket[order]
        ends = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        rows = []
        for b in range(buckets):
            k, s = key[ends[b]:ends[b + 1]], made[ends[b]:ends[b + 1]]
            if len(k):
                change = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
                rows.append((b, s.astype("<u4").tobytes(), (s >> np.uint64(32)).astype(np.uint8).tobytes(), k[change].tobytes(),
                             np.diff(np.append(change, len(k))).astype("<u4").tobytes()))
        kinds = (pa.int32(), *[pa.binary()] * 4)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                          ["bucket", "low", "high", "keys", "runs"])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in steps(batches, 1):
            values, offsets = sets_of(batch, 1)
            key, _ = set_keys(values, offsets)
            for _, row, sign, _ in signs(values, offsets):
                held.append((key[row], sign))
                total += len(row)
            if total >= FLUSH:
                yield flush(held)
                held, total = [], 0
        if total:
            yield flush(held)

    return docs.mapInArrow(made, "bucket int, low binary, high binary, keys binary, runs binary")


GROUP, SHARED = 0, 1


def shared(packed: DataFrame) -> DataFrame:
    """What shares signatures, by kind of row.

    GROUP: the sorted keys that share n signatures of this bucket, and no other key does. SHARED: a is a hot signature,
    b a key that has it.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        joined = lambda name, kind: np.frombuffer(b"".join(table[name].to_pylist()), kind)
        sign = joined("low", "<u4").astype(np.int64) | joined("high", np.uint8).astype(np.int64) << 32
        key = np.repeat(joined("keys", np.int64), joined("runs", "<u4"))
        bucket = table["bucket"][0].as_py()
        del table
        order = np.argsort(sign)
        sign = sign[order]
        same = sign[1:] == sign[:-1]
        multi = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        sign, key = sign[multi], key[order[multi]]
        order = np.lexsort((key, sign))
        sign, key = sign[order], key[order]
        first = np.ones(len(sign), bool)
        first[1:] = (sign[1:] != sign[:-1]) | (key[1:] != key[:-1])
        sign, key = sign[first], key[first]
        if not len(sign):
            return
        begins = np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1]]))
        size = np.diff(np.append(begins, len(sign)))
        hot = np.repeat(size, size) > HOT
        none = lambda n, kind: pa.nulls(n, kind)
        names, n = ["kind", "a", "b", "members", "n"], int(hot.sum())
        # the bucket's number stands before the signature: it and 40 bits name it everywhere
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, SHARED, np.int32)), pa.array(sign[hot] + (np.int64(bucket) << 40)), pa.array(key[hot]),
                                          none(n, pa.list_(pa.int64())), none(n, pa.int64())], names)
        wanted = np.flatnonzero((size > 1) & (size <= HOT))
        if len(wanted):
            _, at, times = np.unique(np.add.reduceat(W.mix(key.view(np.uint64)), begins)[wanted], return_index=True, return_counts=True)
            wanted = wanted[at]
            ends = np.concatenate([[0], np.cumsum(size[wanted])])
            at = np.arange(ends[-1]) - np.repeat(ends[:-1], size[wanted]) + np.repeat(begins[wanted], size[wanted])
            n = len(wanted)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, GROUP, np.int32)), none(n, pa.int64()), none(n, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(key[at])), pa.array(times.astype(np.int64))], names)

    return packed.groupBy("bucket").applyInArrow(found, "kind int, a bigint, b bigint, members array<bigint>, n bigint")


def rows_of(docs: DataFrame, wanted: DataFrame, total: int) -> DataFrame:
    """Documents with the columns of their ``total`` wanted rows (doc_id, key, ...): copies of a doc_id whose set has another key are among them.

    Up to BROADCAST_ROWS wanted rows are broadcast; more are joined by shuffling.
    """
    return docs.join(F.broadcast(wanted) if total <= BROADCAST_ROWS else wanted, "doc_id")


def elements_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """to, key and packed elements (40 bits of each, sorted by them) of the wanted (doc_id, key, to), one row for each of ``to``.

    Classes whose rows all lack a doc_id are found by the key, among the rows without one.
    """

    def packed(values: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        raw = []
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            x = values[a:b] >> np.uint64(24)
            raw.append(x.astype("<u4").tobytes() + (x >> np.uint64(32)).astype(np.uint8).tobytes())
        return raw

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 1):
            values, offsets = sets_of(batch, 1)
            key, _ = set_keys(values, offsets)
            raw = packed(values, offsets)
            for i in np.flatnonzero(key == batch.column(2).to_numpy()).tolist():
                to = batch.column(3)[i].values
                for at in range(0, len(to), 64):
                    part = to.slice(at, 64)
                    yield pa.RecordBatch.from_arrays([part, pa.array(np.full(len(part), key[i])), pa.array([raw[i]] * len(part), pa.binary())], ["to", "key", "elements"])

    def nameless(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 1):
            values, offsets = sets_of(batch, 1)
            yield pa.RecordBatch.from_arrays([pa.array(set_keys(values, offsets)[0]), pa.array(packed(values, offsets), pa.binary())], ["key", "elements"])

    wanted = cut_lineage(wanted.groupBy("doc_id", "key").agg(F.collect_list("to").alias("to")))
    total, named = wanted.agg(F.count("*"), F.count("doc_id")).first()
    found = rows_of(docs, wanted, total).select("doc_id", "text", "key", "to").mapInArrow(made, "to bigint, key bigint, elements binary")
    if named == total:
        return found
    lost = wanted.where("doc_id is null").select("key", F.explode("to").alias("to"))
    rows = docs.where("doc_id is null").select("doc_id", "text").mapInArrow(nameless, "key bigint, elements binary")
    # copies are aggregated: one row for each key
    return found.unionByName(rows.join(lost.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.first("elements").alias("elements"))
                             .join(lost, "key").select("to", "key", "elements"))


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of keys whose sets are similar enough, compared as whole sets."""
    names = classes.select("key", "doc_id")
    ask = pairs.select(F.col("b").alias("key"), F.col("a").alias("to"))
    own = pairs.select(F.col("a").alias("key")).distinct().withColumn("to", F.col("key"))
    x = elements_of(docs, own.join(names, "key")).select(F.col("to").alias("a"), F.col("elements").alias("x"))
    y = elements_of(docs, ask.join(names, "key")).select(F.col("to").alias("a"), F.col("key").alias("b"), F.col("elements").alias("y"))

    def unpack(x: pa.BinaryScalar) -> np.ndarray:
        raw = x.as_buffer()
        n = raw.size // 5
        return np.frombuffer(raw, "<u4", n).astype(np.uint64) | np.frombuffer(raw, np.uint8, n, 4 * n).astype(np.uint64) << np.uint64(32)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = unpack(x), unpack(y)
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                good.append(DOWN * common >= UP * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    joined = y.join(x, "a").select("a", "b", "x", "y")
    return cut_lineage(joined.mapInArrow(check, "a bigint, b bigint").distinct())


def listed_groups(found: DataFrame) -> DataFrame:
    """gid, members and n of the groups that ``shared`` found in all buckets."""
    return (found.where(F.col("kind") == GROUP).groupBy("members").agg(F.sum("n").alias("n"))
            .select(F.xxhash64("members").alias("gid"), "members", "n"))


def rare_elements(docs: DataFrame, classes: DataFrame, lacking: DataFrame) -> DataFrame:
    """gid, key, n, reach and size: the rarest elements of the lacking classes (key), those of the same sets counted as n of one gid.

    Only elements that several of these sets share are listed. Of similar sets with a and b elements both hold UP / DOWN of
    either and more: without the most shared ones up to that number, ties by gid, they still share one. The first they share has a
    ``reach`` (the elements from it on) of UP / (UP + DOWN) * (a + b) at least in both.
    """
    wanted = cut_lineage(lacking.join(classes, "key").select("doc_id", "key"))
    total, named = wanted.agg(F.count("*"), F.count("doc_id")).first()
    rows = rows_of(docs, wanted.select("doc_id").where("doc_id is not null").distinct(), total).select("doc_id", "text")
    if named < total:
        rows = rows.unionByName(docs.where("doc_id is null").select("doc_id", "text"))
    found = cut_lineage(shared(dealt(rows, max(12, -(-total // BUCKET_DOCS)), elements)))
    hot = found.where(F.col("kind") == SHARED).select(F.xxhash64("a", F.lit(1)).alias("gid"), F.col("b").alias("key"))
    hot = hot.join(hot.groupBy("gid").agg(F.count("*").alias("f")), "gid").withColumn("n", F.lit(1).cast("bigint"))
    listed = listed_groups(found).select(F.xxhash64("gid", F.lit(2)).alias("gid"), F.explode("members").alias("key"), F.size("members").cast("bigint").alias("f"), "n")
    last = Window.partitionBy("key").orderBy(F.desc("f"), "gid").rowsBetween(Window.unboundedPreceding, 0)
    return (hot.select("gid", "key", "f", "n").unionByName(listed).withColumn("reach", F.sum("n").over(last)).join(classes.select("key", "size"), "key")
            .where(F.col("reach") * DOWN >= F.col("size") * UP).select("gid", "key", "n", "reach", "size"))


def with_components(groups: DataFrame, known: DataFrame) -> DataFrame:
    return (groups.join(known.select(F.col("node").alias("key"), "component"), "key", "left")
            .select("gid", "key", "n", "reach", "size", "rest", F.coalesce("component", "key").alias("component")))


def candidates(left: DataFrame, right: DataFrame, apart: Column, enough: Column) -> DataFrame:
    """Pairs of keys (a, b) of one gid whose sizes allow a link and that share an element within reach, or ``enough`` signatures.

    ``left`` and ``right`` are rows of the groups whose columns end in _a and _b, ``apart`` tells which of them are paired.
    """
    close = F.least("size_a", "size_b") * DOWN >= F.greatest("size_a", "size_b") * UP
    near = F.col("reach_a").isNull() | (F.least("reach_a", "reach_b") * (UP + DOWN) >= (F.col("size_a") + F.col("size_b")) * UP)
    met = left.join(right, "gid").where(apart & close & near)
    met = met.select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b"), F.col("n_b").alias("n"),
                     F.when(F.col("reach_a").isNull(), F.greatest("rest_a", "rest_b")).alias("rest"))
    return met.groupBy("a", "b").agg(F.sum(F.when(F.col("rest").isNotNull(), F.col("n"))).alias("n"), F.max("rest").alias("rest"),
                                     F.max(F.col("rest").isNull()).alias("rare")).where(F.col("rare") | (F.col("n") >= enough)).select("a", "b")


def side_of(rows: DataFrame, side: str) -> DataFrame:
    return rows.select("gid", *(F.col(c).alias(f"{c}_{side}") for c in rows.columns if c != "gid"))


def linked_classes(docs: DataFrame, prints: DataFrame) -> DataFrame:
    """node and component for every set key that is linked with another; component is the least key.

    First sets are verified with a pivot of each group they are in, if they share LIKELY signatures or an element within
    reach: most copies are in one component then. What is left are groups with sets of several components. There all pairs
    are counted, and those that share as much as a similar pair must are verified too, so that no link is missed.
    """
    found = cut_lineage(shared(dealt(docs, max(12, -(-prints.count() // BUCKET_DOCS)))))
    classes = cut_lineage(prints.where("n_shingles > 0").groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.min_by("n_shingles", "key2").alias("size"), F.min_by("slack", "key2").alias("slack")))
    kinds = F.expr("transform(sequence(0, size(slack) - 2, 2), i -> struct(slack[i] as sort, slack[i + 1] as beyond))")
    beyond = classes.select("key", "size", F.explode(kinds).alias("x")).select("key", "size", "x.*")
    # hot signatures are left out; a set lacks others if these are too few to prove a link
    hot = found.where(F.col("kind") == SHARED).select(F.col("b").alias("key"), F.col("a").bitwiseAND(63).cast("int").alias("sort"))
    counted = hot.groupBy("key", "sort").agg(F.count("*").alias("n"))
    # what a similar set must share at least of the others, unless both lack them
    needs = cut_lineage(beyond.join(counted, ["key", "sort"], "left").groupBy("key", "size")
                 .agg((F.min("beyond") - F.sum(F.coalesce("n", F.lit(0)))).alias("rest"), F.max(F.coalesce(F.col("n") >= F.col("beyond"), F.lit(False))).alias("lacks")))
    listed = listed_groups(found).select("gid", F.explode("members").alias("key"), "n").join(needs.select("key", "size", "rest"), "key")
    groups = listed.select("gid", "key", "n", F.lit(None).cast("bigint").alias("reach"), "size", "rest")
    lacking = needs.where("lacks").select("key")
    if not lacking.isEmpty():
        groups = groups.unionByName(rare_elements(docs, classes, lacking).withColumn("rest", F.lit(None).cast("bigint")))
    groups = cut_lineage(groups)
    known, links = None, None
    for turn in range(PIVOT_ROUNDS + 1):
        if known is None:
            rest, last = groups.withColumn("component", F.col("key")), False
        else:
            rows = with_components(groups, known)
            open_groups = rows.groupBy("gid").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
            rest = cut_lineage(rows.join(open_groups.select("gid"), "gid"))
            size, cross = (int(x or 0) for x in rest.groupBy("gid", "component").agg(F.count("*").alias("c")).groupBy("gid")
                           .agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("own"))
                           .agg(F.sum("m"), F.sum(F.col("m") * F.col("m") - F.col("own"))).first())
            if not size:
                break
            last = turn == PIVOT_ROUNDS or cross // 2 <= FEW_PAIRS * size
        if last:
            fresh = candidates(side_of(rest.drop("n"), "a"), side_of(rest, "b"), F.col("component_a") < F.col("component_b"), F.col("rest"))
        else:
            picked = [F.min_by(F.struct("key", "reach", "size", "rest", "component"), F.xxhash64("key", F.lit(PIVOTS * turn + i))) for i in range(PIVOTS)]
            pivot = rest.groupBy("gid").agg(F.array(*picked).alias("p"))
            pivot = pivot.select("gid", F.explode(F.when(F.col("p")[0]["reach"].isNull(), F.slice("p", 1, 1)).otherwise(F.array_distinct("p"))).alias("p"))
            fresh = candidates(side_of(pivot.select("gid", "p.*"), "a"), side_of(rest, "b"), F.col("component_a") != F.col("component_b"),
                               F.least("rest", F.lit(LIKELY)))
        found_links = verified(cut_lineage(fresh), docs, classes)
        links = found_links if links is None else links.unionByName(found_links)
        known = components(links)
        if last:
            break
    return known


def with_class(docs: DataFrame, name: str) -> DataFrame:
    """All rows and columns with the class_id that jaccard_join gives to their text, as column ``name``."""
    columns = docs.columns

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, len(columns)):
            values, offsets = sets_of(batch, len(columns))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(set_keys(values, offsets)[0], mask=np.diff(offsets) == 0)], [*columns, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.select(*(F.col(f"`{c}`") for c in columns), F.col("text").cast("string").alias("__text")).mapInArrow(made, f"{fields}, `{name}` bigint")


def jaccard_join(docs: DataFrame) -> DataFrame:
    """Links of all documents: doc_id, n_shingles, component_id (the least doc_id reachable, its own included), class_id.

    Documents with equal sets are one class; classes are linked when 100 * intersection >= 75 * union. Null texts and
    texts without words have no shingles and are linked with nothing. Rows that share a doc_id are rows of their own;
    a null doc_id takes part, but names no component. An empty table gives no rows, other columns are not looked at.
    """
    return linked_rows(docs).drop("group_id")


def linked_rows(docs: DataFrame) -> DataFrame:
    """The rows of jaccard_join with group_id: components may have the same least doc_id where doc_ids repeat, groups are apart."""
    rows = pick(docs, doc_id="doc_id bigint", text="text string")
    prints = cut_lineage(fingerprints(rows))
    known = linked_classes(rows, prints)
    classes = (prints.where("n_shingles > 0").groupBy("key", "key2").agg(F.min("doc_id").alias("least"))
               .join(known.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key")))
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "component").select("key", "key2", "component_id", F.col("component").alias("group_id"))
    return prints.join(named, ["key", "key2"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n_shingles") > 0, F.col("key")).alias("class_id"), "group_id")
