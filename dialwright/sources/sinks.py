"""Writing tables, exports and configuration."""

from __future__ import annotations

import uuid
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dialwright import fixed_values as fv
from dialwright.operators.dimensions import merge_by_key
from dialwright.sources.readers import is_missing
from pyspark.errors import AnalysisException


def _path(spark: SparkSession, path: str):
    """Hadoop path object and its file system, so every store Spark reads works."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _balanced(df: DataFrame, keys: list[str]) -> DataFrame:
    """Bring rows of a partition together before writing, in files of sensible size.

    Without this every task writes a file into every partition.  A plain
    repartition would give a dominant partition to one task; REBALANCE lets
    AQE split large ones and merge small ones.
    """
    return df.hint("rebalance", *keys)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet table, optionally partitioned (facts: by year and month)."""
    if partition_by:
        _balanced(df, partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def write_counted(
    df: DataFrame,
    path: str,
    counts: dict[str, Column] | None = None,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> dict[str, object]:
    """Write a table and return ``n_rows`` and the named aggregates of the written rows.

    The figures are collected by the tasks that write, so no second job reads
    the table or computes the rows again.  They stand behind the last shuffle:
    a lost executor's repeated stages are not counted twice.  Nothing written
    gives 0 rows, and aggregates as Spark gives them for no rows.
    """
    seen = Observation()
    balanced = _balanced(df, partition_by) if partition_by else df
    named = [column.alias(name) for name, column in (counts or {}).items()]
    writer = balanced.observe(seen, F.count(F.lit(1)).alias("n_rows"), *named).write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return seen.get


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Table ``name`` at ``path``, cut into buckets by ``keys`` and sorted inside them; returns it as read back.

    Tables bucketed alike by their join keys meet bucket by bucket: the shuffle
    is paid once, by the write, and not again by every join.  Choose
    ``buckets`` so that one holds some hundred megabytes, the same for all
    tables that meet.  One file per bucket.
    """
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table's folder; a missing one is fine."""
    folder, fs = _path(spark, path)
    fs.delete(folder, True)


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append to a Parquet table; appending nothing is free."""
    write_table(df, path, "append", partition_by)


def replace_partition(df: DataFrame, path: str, keys: list[str], runs: list[dict[str, object]] | None = None) -> None:
    """Replace exactly the partitions that occur in ``df`` or are named in ``runs``; others stay.

    Re-running a load therefore replaces its own rows instead of adding to
    them.  A run that now yields nothing is only known by its name: ``runs``
    lists the key values being loaded, and those without rows are cleared.
    Which ones have rows is seen by the write itself.
    """
    seen = Observation()
    balanced = _balanced(df, keys)
    if runs:
        named = [reduce(and_, (F.col(k).eqNullSafe(F.lit(run[k])) for k in keys)) for run in runs]
        # One flag per named run, so what comes back is bounded by ``runs``.
        balanced = balanced.observe(seen, *(F.max(condition).alias(f"r{i}") for i, condition in enumerate(named)))
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    if runs:
        filled = seen.get
        for i, run in enumerate(runs):
            if not filled[f"r{i}"]:
                folder, fs = _path(df.sparkSession, f"{path.rstrip('/')}/{_partition_folder(run, keys)}")
                fs.delete(folder, True)


def _partition_folder(run: dict[str, object], keys: list[str]) -> str:
    """The folder Spark gives a partition: ``key=value`` with special characters escaped."""
    special = '"#%\'*/:=?\\{[]^'
    escape = lambda text: "".join(f"%{ord(c):02X}" if c in special or ord(c) < 32 else c for c in text)
    values = [fv.NULL_PARTITION if run[k] is None else escape(str(run[k])) for k in keys]
    return "/".join(f"{escape(k)}={v}" for k, v in zip(keys, values, strict=True))


def _swap_in(spark: SparkSession, base: str, staging: str, mark: str) -> None:
    """Replace the folder ``base`` by the finished folder ``staging``."""
    retired = f"{base}.old-{mark}"
    target, fs = _path(spark, base)
    if fs.exists(target) and not fs.rename(target, _path(spark, retired)[0]):
        raise OSError(f"could not retire {base}; the new state is in {staging}")
    if not fs.rename(_path(spark, staging)[0], target):
        raise OSError(f"could not move {staging} to {base}; the old state is in {retired}")
    fs.delete(_path(spark, retired)[0], True)


def staged_overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a table by a new state that was computed from it.

    The state is written next to the table, then swapped in by two renames.
    If the job dies before the swap the old table is untouched; if it dies
    between the renames the old table is found under ``<path>.old-<id>``.
    """
    base, mark = path.rstrip("/"), uuid.uuid4().hex
    staging = f"{base}.new-{mark}"
    write_table(df, staging, "errorifexists", partition_by)
    _swap_in(df.sparkSession, base, staging, mark)


def export_csv(df: DataFrame, path: str, single: bool = False, sep: str = ",") -> None:
    """Headered UTF-8 CSV folder, replaced on re-run.

    ``single`` funnels everything through one task to get one part file.  Use
    it for reports whose size is bounded by their grain, such as one row per
    day, unit and status.
    """
    out = df.coalesce(1) if single else df
    out.write.mode("overwrite").option("header", True).option("sep", sep).option("encoding", "UTF-8").csv(path)


def promote_part(spark: SparkSession, folder: str, final: str, suffix: str = ".csv") -> None:
    """Give the only part file of a folder a clean name and drop the folder."""
    source, fs = _path(spark, folder)
    parts = [s.getPath() for s in fs.listStatus(source) if s.getPath().getName().endswith(suffix)]
    if len(parts) != 1:
        raise FileNotFoundError(f"expected one {suffix} file in {folder}, found {len(parts)}")
    target, _ = _path(spark, final)
    fs.delete(target, False)
    if not fs.rename(parts[0], target):
        raise OSError(f"could not move {parts[0]} to {final}")
    fs.delete(source, True)


def write_config(new: DataFrame, path: str, key: list[str]) -> None:
    """Merge rows into a JSON configuration folder by key; incoming fields win.

    The old document is read with whatever fields it has, so that fields the
    new rows lack survive.  It is swapped, not overwritten, as it is being read.
    """
    spark = new.sparkSession
    try:
        merged = merge_by_key(spark.read.json(path), new, key)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        merged = new
    base, mark = path.rstrip("/"), uuid.uuid4().hex
    staging = f"{base}.new-{mark}"
    merged.coalesce(1).write.mode("errorifexists").json(staging)
    _swap_in(spark, base, staging, mark)
