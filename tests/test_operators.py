"""Operators against brute force, with hot keys, copies and NULL keys."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from freightmart.functions.semantics import ascending, descending
from freightmart.operators import dedupe, increment, joins, ledger, locks, ordinal, relations, stringagg, topk, totals, upsert
from freightmart.operators.horizon import trailing_totals

ONE = "k string, i string, a int"
MANY = "lk string, li string, b int"


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def full_join(one, many):
    out, met = Counter(), set()
    for m in many:
        hits = [n for n, o in enumerate(one) if None not in m[:2] and o[:2] == m[:2]]
        met.update(hits)
        for n in hits:
            out[one[n] + m] += 1
        if not hits:
            out[(None,) * 3 + m] += 1
    for n, o in enumerate(one):
        if n not in met:
            out[o + (None,) * 3] += 1
    return out


def test_link_full_join_keeps_both_sides_with_hot_keys(spark):
    rng = random.Random(7)
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", "c", "d", None])
    one = [(k, i, n) for n, (k, i) in enumerate([("hot", "x"), ("hot", "x"), ("a", "x"), ("b", "y"), ("z", "x"), (None, "x"), ("c", None)])]
    many = [(key(), rng.choice(["x", "y", None]), n) for n in range(200)]
    left, right = spark.createDataFrame(one, ONE), spark.createDataFrame(many, MANY)
    got = joins.link_full_join(left, right, [("k", "lk"), ("i", "li")])
    assert got.columns == ["k", "i", "a", "lk", "li", "b"]
    assert rows_of(got) == full_join(one, many)


def test_number_rows_equals_plain_numbering_with_copies_and_nulls(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), rng.randrange(40), rng.choice([1, 1, 2])) for _ in range(500)]
    rows += [("hot", 7, 1)] * 100
    df = spark.createDataFrame(rows, "k string, v int, w int")
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    want = Counter(row + (n,) for group in groups.values() for n, row in enumerate(sorted(group, key=lambda r: r[1:]), 1))
    got = ordinal.number_rows(df, ["k"], ["v"], "n")
    assert rows_of(got) == want
    old, ordinal.CHUNK = ordinal.CHUNK, 7  # copies expanded over several chunks
    try:
        assert rows_of(ordinal.number_rows(df, ["k"], ["v"], "n")) == want
    finally:
        ordinal.CHUNK = old


def test_number_rows_leaves_out_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, v int")
    got = ordinal.number_rows(df, ["k"], ["v"], "n", collapse=False, where=F.col("k").isNotNull())
    assert rows_of(got) == Counter([("a", 1, 1), ("a", 2, 2), (None, 3, 0), (None, 4, 0)])


def test_pairing_keeps_unpaired_left_rows(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), (None, 2)], "k string, l int")
    right = spark.createDataFrame([("a", 9), (None, 1)], "k string, r int")
    got = ordinal.pair_by_ordinal(left, right, ["k"], ["l"], ["r"])
    assert rows_of(got.select("k", "ordinal", "l", "r")) == Counter([("a", 1, 1, 9), ("a", 2, 5, None), (None, 1, 2, None)])


def test_first_per_key_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    best = topk.first_per_key(df, ["k"], [descending("v")])
    assert {r.k: r.v for r in best.collect()} == {0: 999, 1: 997, 2: 998}
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_null_order_of_first_rows(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (1, 7)], "k int, v int")
    assert topk.first_per_key(df, ["k"], [descending("v")]).head().v is None
    assert topk.first_per_key(df, ["k"], [ascending("v")]).head().v == 5


def test_ties_are_kept(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c")], "k int, v int, n string")
    assert {r.n for r in topk.first_with_ties(df, ["k"], [descending("v")]).collect()} == {"a", "b"}


def test_totals_on_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 4), (None, 5)], "k string, v int")
    got = totals.attach_totals(df, ["k"], {"total": F.sum("v")})
    assert rows_of(got) == Counter([("a", 1, 3), ("a", 2, 3), (None, 4, 9), (None, 5, 9)])


def test_tolerance_join_is_strict_and_keeps_unmatched(spark):
    at = lambda s: datetime(2023, 1, 1, 0, 0, s)
    left = spark.createDataFrame([("n", at(0)), ("n", at(30)), ("m", at(0))], "a string, t timestamp_ntz")
    right = spark.createDataFrame([("n", at(19)), ("n", at(20)), ("n", at(49))], "b string, u timestamp_ntz")
    got = joins.within_seconds(left, right, [("a", "b")], "t", "u", 20)
    assert rows_of(got) == Counter([
        ("n", at(0), "n", at(19)), ("n", at(30), "n", at(19)), ("n", at(30), "n", at(20)), ("n", at(30), "n", at(49)), ("m", at(0), None, None)])
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_either_key_counts_equal_the_or_join(spark):
    rng = random.Random(5)
    pick = lambda: rng.choice(["p", "q", "r", None])
    items = [(n, pick(), pick()) for n in range(60)]
    dim = [(pick(), pick(), rng.choice([True, None])) for _ in range(12)]
    df, d = spark.createDataFrame(items, "id int, c string, a string"), spark.createDataFrame(dim, "code string, art string, lo boolean")
    got = joins.match_counts(df, d, ("c", "code"), ("a", "art"), F.col("lo").isNotNull())
    want = {}
    for n, c, a in items:
        hits = [x for x in dim if (c is not None and x[0] == c) or (a is not None and x[1] == a)]
        want[n] = (len(hits), sum(x[2] is not None for x in hits))
    assert {r.id: (r.matches, r.flagged) for r in got.collect()} == want


def test_texts_with_copies(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)], "k int, v string")
    assert dict(stringagg.list_values(df, ["k"], "v", "; ", "t").collect()) == {1: "a; b", 2: None}
    assert dict(stringagg.list_values(df, ["k"], "v", "; ", "t", distinct=False).collect()) == {1: "a; b; b", 2: None}


def test_balance_is_the_sum_of_movements_so_far(spark):
    rng = random.Random(11)
    moves = [(rng.choice("ab"), date(2020 + rng.randrange(3), rng.randrange(1, 13), rng.randrange(1, 28)), rng.choice([0, 1]), rng.randrange(1, 5))
             for _ in range(80)]
    df = spark.createDataFrame(moves, "k string, period date, direction int, q int")
    as_of = date(2022, 12, 20)
    got = ledger.monthly_balance(df, ["k"], "period", ledger.signed(F.col("direction"), F.col("q")), ledger.months(spark, date(2020, 3, 1), as_of), as_of)
    want = {}
    for k in "ab":
        for y in range(2020, 2023):
            for m in range(1, 13):
                total = sum(q if d == 0 else -q for kk, p, d, q in moves if kk == k and (p.year, p.month) <= (y, m))
                if total and (y, m) >= (2020, 3) and any(kk == k and (p.year, p.month) <= (y, m) for kk, p, _, _ in moves):
                    want[(k, date(y, m, 1))] = total
    assert {(r.k, r.month): r.balance for r in got.collect()} == want
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_december_is_followed_by_january(spark):
    df = spark.createDataFrame([("a", date(2022, 12, 5), 3)], "k string, period date, q int")
    as_of = date(2022, 12, 31)
    got = ledger.monthly_balance(df, ["k"], "period", F.col("q"), ledger.months(spark, date(2022, 11, 1), as_of), as_of)
    assert [(r.month, r.month_end, r.balance) for r in got.collect()] == [(date(2022, 12, 1), date(2022, 12, 31), 3)]


def test_trailing_months_skip_the_current_one_and_gaps(spark):
    df = spark.createDataFrame([("a", date(2022, m, 1), m) for m in (1, 2, 7, 8)], "k string, month date, v int")
    got = trailing_totals(df, "k", "month", ["v"], {"6m": 6, "1y": 12})
    assert {r.month.month: (r.v_6m, r.v_1y) for r in got.collect()} == {1: (0, 0), 2: (1, 1), 7: (3, 3), 8: (9, 10)}


def test_dedupe_is_idempotent_and_logged(spark):
    rows = [("a", 1, datetime(2023, 1, 1)), ("a", 1, datetime(2023, 2, 1)), ("b", 2, None), ("b", 2, datetime(2023, 1, 1))]
    df = spark.createDataFrame(rows, "k string, v int, update_date timestamp_ntz")
    once = dedupe.keep_newest(df, "update_date")
    assert rows_of(once) == Counter([("a", 1, datetime(2023, 2, 1)), ("b", 2, None)])
    assert rows_of(dedupe.keep_newest(once, "update_date")) == rows_of(once)
    cleaned, log = dedupe.dedupe_tables({"t": df, "u": once}, "update_date", datetime(2023, 3, 1))
    assert [tuple(r)[:4] for r in log.collect()] == [("t", 4, 2, 2)]
    assert cleaned["t"].columns == df.columns


def test_upsert_twice_equals_once(spark):
    stored = spark.createDataFrame([("a", None, "x"), ("b", 0.0, "x"), ("c", 3.0, "x")], "code string, weight double, unit string")
    incoming = spark.createDataFrame([("a", 1.0, "kg"), ("c", 9.0, "kg"), ("d", 4.0, "kg")], "code string, weight double, unit string")

    def run(df):
        empty = F.coalesce(F.col("weight") == 0, F.lit(True))
        filled = upsert.fill_missing(df, incoming, "code", empty, ["weight", "unit"])
        return upsert.add_missing(filled, incoming, "code", {c: F.col(c) for c in df.columns})

    once = run(stored)
    assert rows_of(once) == Counter([("a", 1.0, "kg"), ("b", 0.0, "x"), ("c", 3.0, "x"), ("d", 4.0, "kg")])
    assert rows_of(run(once)) == rows_of(once)


def test_changed_rows_treat_null_as_a_value(spark):
    now = spark.createDataFrame([("a", 1), ("b", None), ("c", 2)], "k string, v int")
    old = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], "k string, v int")
    assert rows_of(increment.changed_rows(now, old, {"k": F.col("k"), "v": F.col("v")})) == Counter([("c", 2)])


def test_relations_are_symmetric_and_equal_to_probes(spark):
    from freightmart.functions.literals import ZERO_REF

    tables = {
        "orders": spark.createDataFrame([("1", "9"), (ZERO_REF, "8")], "id_key string, cust_key string"),
        "lines": spark.createDataFrame([("1", ZERO_REF), ("2", ZERO_REF)], "order_key string, empty_key string"),
        "people": spark.createDataFrame([("9",), ("7",)], "cust_key string"),
    }
    candidates = relations.candidate_columns(tables, "key")
    got = relations.column_relations(tables, candidates)
    pairs = {tuple(r) for r in got.where(F.col("rel_table_name").isNotNull()).collect()}
    assert pairs == {("orders", "id_key", "lines", "order_key"), ("lines", "order_key", "orders", "id_key"),
                     ("orders", "cust_key", "people", "cust_key"), ("people", "cust_key", "orders", "cust_key")}
    assert {tuple(r)[:2] for r in got.where(F.col("rel_table_name").isNull()).collect()} == {("lines", "empty_key")}
    zero = relations.only_zero_columns(relations.column_values(tables, candidates))
    assert [tuple(r) for r in zero.collect()] == [("lines", "empty_key")]
    assert relations.tables_not_covered(["orders", "new"], got) == ["new"]
    def index(chosen):
        return relations.index_values({n: tables[n] for n in chosen}, {n: candidates[n] for n in chosen})

    fresh = relations.pairs_with_new(index([n for n in tables if n != "people"]), index(["people"]))
    assert {r.table_name for r in fresh.collect()} == {"orders", "people"}
    words = {r.column_name: r.comment for r in relations.data_dictionary(got).where("table_name = 'orders'").collect()}
    assert words == {"id_key": "lines.order_key", "cust_key": "people.cust_key"}


def test_blocked_sessions_equal_the_pair_list(spark):
    rng = random.Random(2)
    rows = [(n, rng.randrange(6), rng.choice([True, False]), rng.choice(["o", "o", "p", None])) for n in range(80)]
    df = spark.createDataFrame(rows, "id int, pid int, granted boolean, obj string")
    want = {}
    for n, pid, granted, obj in rows:
        others = [p for _, p, _, o in rows if o == obj and p != pid]
        if not granted and others:
            want[n] = (len(others), len(set(others)), min(others), max(others))
    got = locks.blocked_sessions(df, "pid", "granted", ["obj"])
    assert {r.id: (r.blocking_rows, r.blocking_sessions, r.first_blocker, r.last_blocker) for r in got.collect()} == want


def spread(spark, run, partitions=12):
    """``run`` with so many ranges, none of them joined again for their small size."""
    settings = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return run()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_one_key_and_one_month_are_numbered_by_many_tasks(spark):
    rows = [("hot", date(2023, 5, 1), n) for n in range(600)] + [(None, date(2023, 5, 1), n) for n in range(300)] + [("x", None, 1)]
    df = spark.createDataFrame(rows, "k string, d date, v int").repartition(7)
    sort = [F.col("k"), F.col("d").asc_nulls_last(), F.col("v").asc_nulls_last()]
    ranged = spread(spark, lambda: ordinal.sorted_ranges(df, sort, "__part"))
    sizes = dict(ranged.where("k = 'hot'").groupBy("__part").count().collect())
    assert len(sizes) >= 5 and max(sizes.values()) < 200
    numbered = spread(spark, lambda: ordinal.number_rows(df, ["k"], ["d"], "n").collect())
    got = defaultdict(list)
    for r in numbered:
        got[r.k].append((r.n, r.v))
    assert {k: sorted(v) for k, v in got.items()} == {
        "hot": [(n + 1, n) for n in range(600)], None: [(n + 1, n) for n in range(300)], "x": [(1, 1)]}


def test_pairing_leaves_null_keys_of_the_right_out(spark):
    left = spark.createDataFrame([(None, 1), ("a", 1)], "k string, l int")
    right = spark.createDataFrame([(None, 1)] * 50 + [("a", 3)], "k string, r int")
    assert rows_of(ordinal.pair_by_ordinal(left, right, ["k"], ["l"], ["r"]).select("k", "l", "r")) == Counter([(None, 1, None), ("a", 1, 3)])


@pytest.mark.parametrize("distinct,size", [(True, 3), (False, 3), (False, 1000), (True, 1)])
def test_list_parts_in_order_are_the_whole_list(spark, distinct, size):
    rng = random.Random(size)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *[f"v{i:02d}" for i in range(20)]])) for _ in range(300)]
    rows += [("empty", None), ("copies", "same")] + [("copies", "same")] * 50
    df = spark.createDataFrame(rows, "k string, v string")
    parts = spread(spark, lambda: stringagg.list_parts(df, ["k"], "v", "; ", "t", distinct=distinct, size=size).collect())
    whole = dict(stringagg.list_values(df, ["k"], "v", "; ", "t", distinct=distinct).collect())
    got = defaultdict(list)
    for r in sorted(parts, key=lambda r: r.part):
        assert r.part == len(got[r.k])
        got[r.k].append(r.t)
        assert r.t is None or len(r.t.split("; ")) <= size
    assert {k: None if v == [None] else "; ".join(v) for k, v in got.items()} == whole


def test_a_chain_of_links_computes_every_side_once(spark):
    seen = {name: spark.sparkContext.accumulator(0) for name in "abcd"}

    def source(name, keys):
        def count(batches, counter=seen[name]):
            for batch in batches:
                counter.add(batch.num_rows)
                yield batch
        return spark.createDataFrame([(k, name) for k in keys], f"{name}_k int, {name}_v string").mapInArrow(count, f"{name}_k int, {name}_v string")

    chain = source("a", range(10))
    for name, keys in (("b", range(5, 15)), ("c", range(3)), ("d", [1] * 20)):
        chain = joins.link_full_join(chain, source(name, keys), [("a_k", f"{name}_k")])
    assert chain.count() == 9 + 20 + 5
    assert {name: counter.value for name, counter in seen.items()} == {"a": 10, "b": 10, "c": 3, "d": 20}


def test_many_totals_equal_single_totals(spark):
    rng = random.Random(8)
    rows = [(rng.choice([1, 2, None]), rng.choice(["x", None]), rng.randrange(9)) for _ in range(60)]
    df = spark.createDataFrame(rows, "a int, b string, v int")
    got = totals.attach_many_totals(df, [(["a"], {"s": F.sum("v")}), (["a", "b"], {"m": F.max("v")})])
    want = totals.attach_totals(totals.attach_totals(df, ["a"], {"s": F.sum("v")}), ["a", "b"], {"m": F.max("v")})
    assert rows_of(got) == rows_of(want)


def test_probe_finds_a_shared_value_or_none(spark):
    left = spark.range(1000).select(F.col("id").cast("string").alias("v"))
    assert relations.shared_value(left, "v", spark.createDataFrame([(999,), (5000,)], "w long"), "w") == "999"
    zero = spark.createDataFrame([("00000000-0000-0000-0000-000000000000",), (None,)], "v string")
    assert relations.shared_value(zero, "v", zero, "v") is None
    assert relations.shared_value(left, "v", spark.range(2000, 3000), "id") is None
