"""Helpers shared by the operators: shipping code, bounded Arrow batches, stored tables."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialwright.session import shared_dir

WORD = r"[^\x20\x09-\x0D]+"  # a word: a run of anything but ASCII white space


def prepare(spark: SparkSession) -> None:
    """Make this package importable on executors and bound what one Arrow batch holds.

    A batch ends at 2,000 rows or about 16 MB, whichever comes first, so a
    Python worker's memory follows the longest text, not the number of rows.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    context = spark.sparkContext
    if getattr(context, "_dialwright_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, str(path.relative_to(root.parent)))
    # The driver's own folder: Spark's file server hands the archive to executors.
    folder = tempfile.mkdtemp(prefix="dialwright-code-")
    name = os.path.join(folder, "dialwright_code.zip")
    Path(name).write_bytes(packed.getvalue())
    context.addPyFile(name)
    context._dialwright_shipped = True


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: evaluated once, lineage cut.

    The table survives the loss of any executor, unlike a local checkpoint.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession, df: DataFrame) -> None:
    """Delete a table made by :func:`stored` once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def first_of_each(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per key: the one whose text has the smallest hash, so a rerun keeps the same text.

    Spark keeps one row per key and task before the shuffle, so a frequent key is no hot group.
    """
    place = Window.partitionBy(key).orderBy(F.xxhash64(text), text)
    return df.withColumn("__place", F.row_number().over(place)).where("__place = 1").drop("__place")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def runs(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[pa.Table]:
    """The rows of each run of equal values in ``columns``, for input sorted by them.

    Holds one batch and the unfinished run, so the caller bounds its groups.
    """
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.Table.from_batches([batch])
        held = new if held is None else pa.concat_tables([held, new])
        cuts = _cuts(held, columns)
        start = 0
        for cut in cuts:
            yield held.slice(start, cut - start)
            start = cut
        held = held.slice(start)
    if held is not None and held.num_rows:
        yield held


def _cuts(rows: pa.Table, columns: tuple[str, ...]) -> list[int]:
    """Places where a new run starts."""
    changed = np.zeros(max(rows.num_rows - 1, 0), bool)
    for column in columns:
        values = rows.column(column).to_numpy()
        changed |= values[1:] != values[:-1]
    return (np.flatnonzero(changed) + 1).tolist()
