"""Sinks: refresh, guarded refresh, append, period close, retention."""

from collections import Counter
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from freightmart.operators.upsert import add_missing, fill_missing
from freightmart.session import cut_lineage
from freightmart.sources import publish, tables
from freightmart.sources.merge import merge_import, store_bucketed

MOMENT = datetime(2023, 5, 10, 12)


@pytest.fixture
def targets(spark, tmp_path):
    return publish.Target(spark, str(tmp_path / "target")), publish.Target(spark, str(tmp_path / "log"))


def ids(target):
    return sorted(r.id for r in target.read().collect())


def test_refresh_replaces_and_can_read_its_own_target(spark, targets):
    target, _ = targets
    assert not target.exists()
    with pytest.raises(FileNotFoundError):
        target.read()
    target.refresh(spark.range(3))
    target.refresh(target.read().where("id > 0"))
    assert ids(target) == [1, 2]


def test_failed_refresh_keeps_the_old_rows(spark, targets):
    target, _ = targets
    target.refresh(spark.range(2))
    with pytest.raises(Exception):
        target.refresh(spark.range(2).select(F.raise_error(F.lit("lost")).cast("long").alias("id")))
    assert ids(target) == [0, 1]


def test_append_adds_and_orders_columns(spark, targets):
    target, _ = targets
    target.append(spark.createDataFrame([(1, "a")], "id int, n string"))
    target.append(spark.createDataFrame([("b", 2)], "n string, id int"))
    assert sorted(tuple(r) for r in target.read().collect()) == [(1, "a"), (2, "b")]


def test_guarded_refresh_keeps_old_rows_and_says_so(spark, targets):
    target, log = targets
    assert publish.refresh_if_any(target, spark.range(2), log, "job", MOMENT, "done", "failed")
    later = datetime(2023, 5, 11)
    assert not publish.refresh_if_any(target, spark.range(0), log, "job", later, "done", "failed")
    rows = target.read().collect()
    assert sorted(r.id for r in rows) == [0, 1]
    assert {(r.update_date, r.comment) for r in rows} == {(later, "failed: 2023-05-10 12:00:00")}
    assert Counter(r.message for r in log.read().collect()) == Counter(["done", "failed"])


def test_period_is_closed_once(spark, targets):
    target, log = targets
    rows = spark.createDataFrame([(1, date(2023, 4, 3))], "id int, date_d date")
    assert publish.close_period(target, lambda stored: rows, log, "close", date(2023, 5, 10))
    assert not publish.close_period(target, lambda stored: rows, log, "close", date(2023, 5, 20))
    assert ids(target) == [1]
    assert publish.close_period(target, lambda stored: rows.withColumn("id", F.col("id") + stored.count()), log, "close", date(2023, 6, 10))
    assert ids(target) == [1, 2]
    assert log.read().count() == 3


def test_retention_and_the_row_that_says_nothing_happened(spark, targets):
    target, _ = targets
    schema = "pid int, update_date timestamp_ntz, note string"
    for day in (datetime(2023, 3, 31), datetime(2023, 4, 1)):
        publish.retain(target, spark.createDataFrame([(7, day, "")], schema), "update_date", day, "note", "none")
    publish.retain(target, spark.createDataFrame([], schema), "update_date", MOMENT, "note", "none")
    assert sorted((r.update_date, r.pid, r.note) for r in target.read().collect()) == [(datetime(2023, 4, 1), 7, ""), (MOMENT, None, "none")]


def test_metadata_as_rows(spark):
    described = tables.describe_columns(spark, {"t": spark.range(1).select("id", F.lit("x").alias("n"))})
    assert [tuple(r) for r in described.orderBy("position").collect()] == [("t", "id", 0, "bigint"), ("t", "n", 1, "string")]
    assert list(tables.without({"a": None, "b": None}, ["a"])) == ["b"]


def test_calendar_weeks(spark):
    rows = {r.date: (r.year_month, r.year_week) for r in tables.calendar(spark, "2022-12-31", "2023-01-02").collect()}
    assert rows == {date(2022, 12, 31): ("2022-12", "2022-52"), date(2023, 1, 1): ("2023-01", "2022-52"), date(2023, 1, 2): ("2023-01", "2023-01")}


def test_checkpoints_cut_the_plan(spark, tmp_path):
    cut = cut_lineage(spark.range(3).where("id > 0"), str(tmp_path))
    assert cut.count() == 2 and "Filter" not in cut._jdf.queryExecution().analyzed().toString()


def files(target):
    """Data files of the newest manifest with the times they were written."""
    root = Path(target.store.path)
    return {str(f): f.stat().st_mtime_ns for s in target.segments() for f in (root / s.folder).glob("*.parquet")}


def test_two_targets_show_together_or_not_at_all(spark, tmp_path):
    store = publish.Store(spark, str(tmp_path / "store"))
    with store.change() as change:
        change.replace("a", spark.range(2))
        change.replace("b", spark.range(3))
    with pytest.raises(Exception):
        with store.change() as change:
            change.replace("a", spark.range(7))
            change.replace("b", spark.range(2).select(F.raise_error(F.lit("lost")).cast("long").alias("id")))
    now = store.snapshot()
    assert now.number == 1 and now.read("a").count() == 2 and now.read("b").count() == 3
    with store.change() as change:
        change.replace("a", spark.range(7))
        change.append("b", now.read("a"))
    assert now.read("a").count() == 2  # a snapshot stays what it was
    later = store.snapshot()
    assert later.read("a").count() == 7 and later.read("b").count() == 5


def test_the_second_of_two_jobs_that_started_together_fails(spark, tmp_path):
    store = publish.Store(spark, str(tmp_path / "store"))
    with pytest.raises(Exception):
        with store.change() as slow:
            slow.replace("a", spark.range(2))
            with store.change() as quick:
                quick.replace("a", spark.range(5))
    assert store.snapshot().read("a").count() == 5


def test_views_see_one_state_while_a_refresh_runs(spark, tmp_path):
    store = publish.Store(spark, str(tmp_path / "store"))
    with store.change() as change:
        change.replace("reports.cost", spark.range(4))
        change.replace("reports.items", spark.range(4))
    store.snapshot().create_views({"v_cost": "reports.cost", "v_items": "reports.items"})
    with store.change() as change:
        # a report is computed through the view of the report that it replaces
        change.replace("reports.cost", spark.sql("SELECT id + 10 AS id FROM v_cost JOIN v_items USING (id)"))
        assert spark.sql("SELECT max(id) AS m FROM v_cost").first().m == 3
    assert spark.sql("SELECT max(id) AS m FROM v_cost").first().m == 3
    store.snapshot().create_views({"v_cost": "reports.cost"})
    assert spark.sql("SELECT max(id) AS m FROM v_cost").first().m == 13


def test_old_versions_are_removed_when_nothing_names_them(spark, tmp_path):
    target = publish.Target(spark, str(tmp_path / "t"))
    target.refresh(spark.range(1))
    for n in range(3):
        target.append(spark.range(n + 1))
    target.refresh(spark.range(9))
    running = target.store.snapshot().store.change()
    with running as change:
        unpublished = change.write("data", spark.range(2))
    gone = target.store.clean(versions=1)
    assert len(gone) == 4 and target.read().count() == 9
    assert len(target.store._manifests()) == 1 and target.store.names(unpublished[0].folder)


def test_close_leaves_old_files_alone(spark, targets):
    target, log = targets
    rows = spark.createDataFrame([(1, date(2023, 4, 3))], "id int, date_d date")
    publish.close_period(target, lambda stored: rows, log, "close", date(2023, 5, 10))
    before = files(target)
    publish.close_period(target, lambda stored: rows, log, "close", date(2023, 6, 10))
    assert before.items() <= files(target).items() and len(files(target)) > len(before)
    with pytest.raises(Exception):
        lost = rows.withColumn("id", F.raise_error(F.lit("lost")).cast("int"))
        publish.close_period(target, lambda stored: lost, log, "close", date(2023, 7, 10))
    assert ids(target) == [1, 1]


def test_retention_drops_folders_and_touches_no_others(spark, targets):
    target, _ = targets
    schema = "pid int, update_date timestamp_ntz, note string"
    for month in (1, 2, 3, 4):
        publish.retain(target, spark.createDataFrame([(month, datetime(2023, month, 5), "")], schema), "update_date", datetime(2023, month, 6), "note", "none")
    before = files(target)
    assert sorted(s.label for s in target.segments()) == ["2023-03", "2023-04"]
    publish.retain(target, spark.createDataFrame([(5, datetime(2023, 5, 5), "")], schema), "update_date", MOMENT, "note", "none")
    assert sorted(r.pid for r in target.read().collect()) == [4, 5]
    after = files(target)
    assert {f: t for f, t in before.items() if "2023-04" in f}.items() <= after.items()


def test_guarded_refresh_runs_its_plan_once(spark, targets):
    target, log = targets
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    publish.refresh_if_any(target, spark.range(6).mapInArrow(count, "id bigint"), log, "job", MOMENT, "done", "failed")
    assert seen.value == 6 and len(ids(target)) == 6


def test_an_empty_target_keeps_its_columns(spark, targets):
    target, _ = targets
    target.refresh(spark.createDataFrame([], "id int, m string"), F.col("m"))
    assert target.read().columns == ["id", "m"] and target.read().count() == 0
    target.append(spark.createDataFrame([("x", 5)], "m string, id long"), F.col("m"))
    assert [tuple(r) for r in target.read(["x"]).collect()] == [(5, "x")] and target.read(["y"]).count() == 0


STORED = "code string, unit string, weight int, factor int"


def merge(target, incoming, buckets=8):
    values = {"code": F.col("code"), "unit": F.col("unit"), "weight": F.col("weight"), "factor": F.lit(350)}
    return merge_import(target, incoming, "code", F.coalesce(F.col("weight") == 0, F.lit(True)), ["weight", "unit"], values, buckets)


def test_merge_rewrites_only_changed_buckets(spark, targets):
    target, _ = targets
    stored = [(f"c{i:03d}", "kg", None if i % 10 == 0 else 0 if i % 10 == 1 else 7, 100) for i in range(200)] + [(None, "x", None, 1)]
    store_bucketed(target, spark.createDataFrame(stored, STORED), "code", 8)
    before = files(target)
    incoming = [("c000", "t", 5), ("c001", "t", None), ("c002", "t", 9), ("n1", "t", 4), (None, "t", 4)]
    frame = spark.createDataFrame(incoming, "code string, unit string, weight int")
    changed = {r.code: (r.change, r.weight, r.unit, r.factor) for r in merge(target, frame).collect()}
    assert changed == {"c000": ("filled", 5, "t", 100), "c001": ("filled", None, "t", 100), "n1": ("added", 4, "t", 350)}
    after = files(target)
    touched = {s.label for s in target.segments()} - {label for label in {s.label for s in target.segments()} if any(f in before for f in after if f"={label}/" in f)}
    assert 1 <= len(touched) <= 3
    want = {r[0]: r for r in stored} | {"c000": ("c000", "t", 5, 100), "c001": ("c001", "t", None, 100), "n1": ("n1", "t", 4, 350)}
    assert {r.code: tuple(r) for r in target.read().collect()} == want
    # the same import again fills c001 once more with nothing new: no file moves
    assert merge(target, frame).collect() == [] and files(target) == after


def test_merge_equals_the_plain_upsert(spark, targets):
    target, _ = targets
    stored = spark.createDataFrame([(f"c{i}", "kg", i % 3, 100) for i in range(50)], STORED)
    incoming = spark.createDataFrame([(f"c{i}", "t", i) for i in range(25, 80, 2)], "code string, unit string, weight int")
    store_bucketed(target, stored, "code", 4)
    merge(target, incoming, 4)
    values = {"code": F.col("code"), "unit": F.col("unit"), "weight": F.col("weight"), "factor": F.lit(350)}
    plain = add_missing(fill_missing(stored, incoming, "code", F.col("weight") == 0, ["weight", "unit"]), incoming, "code", values)
    assert Counter(tuple(r) for r in target.read().collect()) == Counter(tuple(r) for r in plain.collect())
    with pytest.raises(ValueError):
        merge(target, incoming, 5)
