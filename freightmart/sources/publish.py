"""Writing results: full refresh, guarded refresh, append, period close, logs, views.

A store is a shared folder of published tables. Data is written to folders of
its own first; a manifest then names the folders of every table, and writing
the next manifest is the one step that publishes, for one table or several. A
failed or lost job leaves the old manifest, appended rows leave old files as
they are, and rows go by leaving their folder out. A table can be read while
its replacement is computed from it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABEL = "__label"
NO_LABEL = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Segment:
    """A folder of rows of a table; ``label`` says which month or bucket they are of, where that matters."""

    folder: str
    label: str | None = None


@dataclass(frozen=True)
class Published:
    """What a manifest says of a table: its schema, and the folders that hold its rows."""

    schema: str
    segments: tuple[Segment, ...] = ()


class Snapshot:
    """The tables of a store as one manifest names them; later changes do not show."""

    def __init__(self, store: Store, number: int, tables: Mapping[str, Published]):
        self.store, self.number, self.tables = store, number, dict(tables)

    def read(self, name: str, labels: Sequence[str] | None = None) -> DataFrame:
        """A table, or only its rows with one of the ``labels``; the folders of other rows are not opened."""
        if name not in self.tables:
            raise FileNotFoundError(f"nothing published as {name} at {self.store.path}")
        table = self.tables[name]
        schema = T.StructType.fromJson(json.loads(table.schema))
        folders = [f"{self.store.path}/{s.folder}" for s in table.segments if labels is None or s.label in labels]
        if not folders:
            return self.store.spark.createDataFrame([], schema)
        return self.store.spark.read.schema(schema).parquet(*folders)

    def create_views(self, names: Mapping[str, str]) -> None:
        """Temporary views on tables of this one moment, by view name; SQL over several of them sees one state."""
        for view, name in names.items():
            self.read(name).createOrReplaceTempView(view)


@dataclass
class Change:
    """What a job publishes together. Rows are written at once and show when the change ends without an error."""

    start: Snapshot
    tables: dict[str, Published] = field(default_factory=dict)

    def __post_init__(self):
        self.store = self.start.store

    def _now(self, name: str) -> Published | None:
        return self.tables.get(name, self.start.tables.get(name))

    def write(self, name: str, df: DataFrame, by: Column | None = None) -> tuple[Segment, ...]:
        """Rows in new folders, one for each value of ``by``; nothing is published yet."""
        folder = f"{name}/{uuid4().hex}"
        path = f"{self.store.path}/{folder}"
        if by is None:
            df.write.mode("error").parquet(path)
            return (Segment(folder),)
        df.withColumn(LABEL, by.cast("string")).write.mode("error").partitionBy(LABEL).parquet(path)
        parts = [p for p in self.store.names(folder) if p.startswith(f"{LABEL}=")]
        labels = [p.removeprefix(f"{LABEL}=") for p in parts]
        return tuple(Segment(f"{folder}/{p}", None if l == NO_LABEL else l) for p, l in zip(parts, labels, strict=True))

    def publish(self, name: str, schema: T.StructType, segments: Sequence[Segment]) -> None:
        self.tables[name] = Published(schema.json(), tuple(segments))

    def replace(self, name: str, df: DataFrame, by: Column | None = None) -> None:
        self.publish(name, df.schema, self.write(name, df, by))

    def append(self, name: str, df: DataFrame, by: Column | None = None) -> None:
        """Add rows under the columns of the table; the first append publishes it. Stored files stay as they are."""
        now = self._now(name)
        if now is None:
            self.replace(name, df, by)
            return
        schema = T.StructType.fromJson(json.loads(now.schema))
        rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        self.publish(name, schema, [*now.segments, *self.write(name, rows, by)])

    def swap(self, name: str, df: DataFrame, by: Column, labels: Sequence[str]) -> None:
        """Replace the rows with one of the ``labels``; the folders of all other rows stay."""
        now = self._now(name)
        stay = [s for s in now.segments if s.label not in labels]
        self.publish(name, T.StructType.fromJson(json.loads(now.schema)), [*stay, *self.write(name, df, by)])

    def drop(self, name: str, gone: Callable[[str | None], bool]) -> None:
        """Leave out the rows whose label is ``gone``: only the manifest changes."""
        now = self._now(name)
        if now is not None:
            self.tables[name] = Published(now.schema, tuple(s for s in now.segments if not gone(s.label)))


class Store:
    """Published tables in a shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _fs(self):
        return self._path("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def names(self, folder: str = "") -> list[str]:
        fs, path = self._fs(), self._path(folder) if folder else self._path("x").getParent()
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _manifests(self) -> list[int]:
        return sorted(int(n.removeprefix("manifest-")) for n in self.names() if n.startswith("manifest-"))

    def _load(self, number: int) -> dict[str, Published]:
        stream = self._fs().open(self._path(f"manifest-{number:09d}"))
        try:
            said = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return {name: Published(t["schema"], tuple(Segment(*s) for s in t["segments"])) for name, t in said.items()}

    def snapshot(self) -> Snapshot:
        numbers = self._manifests()
        return Snapshot(self, numbers[-1], self._load(numbers[-1])) if numbers else Snapshot(self, 0, {})

    @contextmanager
    def change(self) -> Iterator[Change]:
        """Changes that show together at the end of the block, or not at all."""
        made = Change(self.snapshot())
        yield made
        if made.tables:
            self._commit(made.start.number + 1, made.start.tables | made.tables)

    def _commit(self, number: int, tables: Mapping[str, Published]) -> None:
        """The next manifest takes its name by a rename that fails if another job has taken it first."""
        said = {n: {"schema": t.schema, "segments": [[s.folder, s.label] for s in t.segments]} for n, t in tables.items()}
        fresh, final = self._path(f"fresh-{uuid4().hex}"), self._path(f"manifest-{number:09d}")
        out = self._fs().create(fresh, False)
        out.write(bytearray(json.dumps(said), "utf-8"))
        out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(fresh, final, self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))

    def clean(self, versions: int = 2) -> list[str]:
        """Remove all manifests but the newest ``versions`` and the data folders that only the removed ones name.

        Folders that no manifest ever named stay: a running job may be about to publish them.
        """
        numbers = self._manifests()
        old, kept = numbers[:-versions], numbers[-versions:]

        def named(some: Sequence[int]) -> set[str]:
            return {s.folder for n in some for t in self._load(n).values() for s in t.segments}

        gone = sorted(named(old) - named(kept))
        for name in [*gone, *(f"manifest-{n:09d}" for n in old)]:
            self._fs().delete(self._path(name), True)
        return gone


class Target:
    """One published table of a store; a path alone is a store with one table."""

    def __init__(self, spark: SparkSession, path: str, name: str = "data"):
        self.spark, self.store, self.name = spark, Store(spark, path), name

    def exists(self) -> bool:
        return self.name in self.store.snapshot().tables

    def read(self, labels: Sequence[str] | None = None) -> DataFrame:
        return self.store.snapshot().read(self.name, labels)

    def segments(self) -> tuple[Segment, ...]:
        return self.store.snapshot().tables[self.name].segments

    def refresh(self, df: DataFrame, by: Column | None = None) -> None:
        """Replace the whole content, or keep the old content if anything fails on the way."""
        with self.store.change() as change:
            change.replace(self.name, df, by)

    def append(self, df: DataFrame, by: Column | None = None) -> None:
        """Add rows; the first append publishes the table."""
        with self.store.change() as change:
            change.append(self.name, df, by)


def log_row(spark: SparkSession, name: str, started: datetime, ended: datetime, message: str) -> DataFrame:
    return spark.createDataFrame(
        [(name, started, ended, message)], "name string, started_at timestamp_ntz, ended_at timestamp_ntz, message string"
    )


def refresh_if_any(
    target: Target, df: DataFrame, log: Target, name: str, as_of: datetime, done: str, failed: str
) -> bool:
    """Replace the target only when there is something to put there.

    Otherwise the old rows stay, stamped with a comment that says from when
    they are and with the new date. The target has update_date and comment.
    The plan runs once: its rows are written, and published if there are any.
    """
    spark = target.spark
    stamp = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    with target.store.change() as change:
        fresh = df.withColumns({"update_date": stamp, "comment": F.lit(done)})
        written = change.write(target.name, fresh)
        if any_rows := not spark.read.schema(fresh.schema).parquet(f"{target.store.path}/{written[0].folder}").isEmpty():
            change.publish(target.name, fresh.schema, written)
    if not any_rows and target.exists():
        old = target.read()
        since = F.date_format("update_date", "yyyy-MM-dd HH:mm:ss")
        target.refresh(old.withColumn("comment", F.concat(F.lit(f"{failed}: "), since)).withColumn("update_date", stamp))
    log.append(log_row(spark, name, as_of, as_of, done if any_rows else failed))
    return any_rows


def close_period(target: Target, rows: Callable[[DataFrame | None], DataFrame], log: Target, name: str, as_of: date) -> bool:
    """Append the increment of last month once.

    A month counts as closed when a stored row has a ``date_d`` in it or
    later. ``rows`` gets the stored rows (None on the first close) and returns
    what to append. Stored months keep their files; a lost job shows nothing.
    """
    spark = target.spark
    month = F.add_months(F.trunc(F.lit(as_of.isoformat()).cast("date"), "month"), -1)
    stored = target.read() if target.exists() else None
    stamp = datetime(as_of.year, as_of.month, as_of.day)
    # Messages of the load log
    if stored is not None and not stored.where(F.col("date_d") >= month).isEmpty():
        log.append(log_row(spark, name, stamp, stamp, "Предыдущий месяц уже был зафиксирован! Данные не записались!"))
        return False
    target.append(rows(stored))
    log.append(log_row(spark, name, stamp, stamp, "Данные записались!"))
    return True


def retain(target: Target, fresh: DataFrame, stamp: str, as_of: datetime, comment: str, note: str) -> None:
    """Keep two months of a log and add the new rows, or one row that says there were none.

    ``comment`` is the column that carries ``note`` in that row. Rows lie in
    folders by month: an old month goes by leaving its folder out.
    """
    spark = target.spark
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    before = (as_of.year * 12 + as_of.month - 2)
    oldest = f"{before // 12:04d}-{before % 12 + 1:02d}"
    nothing = spark.range(1).select(*[
        (now if f.name == stamp else F.lit(note) if f.name == comment else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in fresh.schema.fields
    ])
    added = fresh.unionByName(nothing.join(fresh.limit(1).select(F.lit(1).alias("__any")), F.lit(True), "left_anti"))
    with target.store.change() as change:
        change.drop(target.name, lambda month: month is None or month < oldest)
        change.append(target.name, added, F.date_format(stamp, "yyyy-MM"))
