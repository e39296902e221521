"""What the operators share: checkpoints, clash-free columns, batches of bounded size."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step works on; a single longer text is one step of its own.
STEP_BYTES = 1 << 18


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once for each application; Spark's file server hands it out."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        into = tempfile.mkdtemp(prefix="package-")
        context.addPyFile(shutil.make_archive(f"{into}/{package.name}", "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def keep(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session without that setting gets a folder of its own.
    """
    context = df.sparkSession.sparkContext
    shared = df.sparkSession.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if context.getCheckpointDir() is None:
        if shared is None and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint(eager=True)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names: others cannot clash.

    ``columns`` maps the new name to ``"old name type"``.
    """
    out = []
    for new, what in columns.items():
        old, kind = what.rsplit(" ", 1)
        out.append(F.col(f"`{old}`").cast(kind).alias(new))
    return df.select(*out)


def steps(batches: Iterator[pa.RecordBatch], text: int = 1, size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``size`` bytes of text in column ``text``; rows stay in order."""
    for batch in batches:
        at, rows = 0, batch.num_rows
        if rows == 0:
            continue
        column = batch.column(text)
        if column.nbytes <= size:
            yield batch
            continue
        lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        while at < rows:
            n, total = 1, int(lengths[at])
            while at + n < rows and total + lengths[at + n] <= size:
                total += int(lengths[at + n])
                n += 1
            yield batch.slice(at, n)
            at += n
