"""Picking up new files and routing rows by file name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialwright.functions.text import route_of


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Names, sizes and times of the files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            "path",
            "length",
            F.col("modificationTime").alias("modified_at"),
        )
    )


def new_files(source: DataFrame, done: DataFrame, on: str = "file_name") -> DataFrame:
    """Files of the source listing whose name is not among the ingested ones."""
    return source.join(done.select(on).distinct(), on, "left_anti")


def with_file_name(df: DataFrame, out: str = "file_name") -> DataFrame:
    """Name of the file each row was read from."""
    return df.withColumn(out, F.col("_metadata.file_name"))


def route_by_filename(df: DataFrame, file_name: str = "file_name", out: str = "route") -> DataFrame:
    """Add the target folder decided by a token in the file name."""
    return df.withColumn(out, route_of(file_name))
