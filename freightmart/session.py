"""Session settings the reports rely on, and the checkpoint folder rule."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution is part of the design: it picks broadcast sides from
# measured sizes and splits skewed join partitions at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join also where a later step then needs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(app: str, cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster job brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Spark's own setting: an execution's shuffle files are removed when it ends, not when the driver's memory is cleaned up
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Executions inside leave no shuffle files behind: for those whose result is kept elsewhere or is a single value."""
    before = spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)


def cut_lineage(df: DataFrame, fallback_dir: str | None = None) -> DataFrame:
    """``df`` computed once and kept in the shared folder named by ``spark.checkpoint.dir``, read as often as needed.

    The rows are kept as compressed column files: a reader takes only the columns it names, and they take a fraction of
    the space of a checkpoint's serialized rows. The shuffle files they were made of are removed at once.
    Types that such files cannot hold are checkpointed.
    ``fallback_dir`` is used only where neither that setting nor a checkpoint
    folder of the context exists; a local session, as in tests, gets a folder of
    its own.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if context.getCheckpointDir() is None:
        folder = shared or fallback_dir
        if folder is None and context.master.startswith("local["):
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        if folder is None:
            raise ValueError("set spark.checkpoint.dir to a folder every executor can read")
        context.setCheckpointDir(folder)
    if any(word in df.schema.simpleString() for word in ("void", "interval", "variant")):
        return df.checkpoint(eager=True)
    path = f"{context.getCheckpointDir()}/kept-{uuid.uuid4().hex}"
    # plain names stay as they are: a renaming on top moves within a plan, and equal shuffles of the rows are not seen as one
    names = df.columns
    plain = all(re.fullmatch(r"[a-zA-Z_]\w*", c, re.ASCII) for c in names) and len({c.lower() for c in names}) == len(names)
    kept = df if plain else df.toDF(*[f"c{i}" for i in range(len(names))])
    with freed_shuffles(spark):
        kept.write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(kept.schema).parquet(path)
    return rows if plain else rows.toDF(*names)


def forget(*read: DataFrame) -> None:
    """Remove the kept files that ``read`` reads. For steps whose successor is kept, where nothing else reads them."""
    for df in read:
        context = df.sparkSession.sparkContext
        folder = context.getCheckpointDir()
        for name in sorted({m[1] for f in df.inputFiles() if (m := re.search(r"/(kept-[0-9a-f]{32})/[^/]*$", f))}):
            path = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
