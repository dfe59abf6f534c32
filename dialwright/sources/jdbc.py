"""Reading from and appending to a relational database."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    """Connection address and driver properties."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {"url": self.url, **self.properties}


def range_options(column: str, lower: object, upper: object, partitions: int) -> dict[str, str]:
    """Options that split a scan into ranges of a numeric or date column."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc(
    spark: SparkSession, target: JdbcTarget, table: str, ranges: dict[str, str] | None = None
) -> DataFrame:
    """Table scan; pass ``range_options`` to read large tables in parallel."""
    return spark.read.format("jdbc").options(**target.options(), dbtable=table, **(ranges or {})).load()


def read_jdbc_query(
    spark: SparkSession, target: JdbcTarget, sql: str, ranges: dict[str, str] | None = None
) -> DataFrame:
    """Let the database evaluate a whole query.

    It is sent as a derived table, because the ``query`` option excludes range
    partitioning.
    """
    return read_jdbc(spark, target, f"({sql}) q", ranges)


def append_jdbc(
    df: DataFrame, target: JdbcTarget, table: str, batch_rows: int = 20_000, connections: int = 8
) -> None:
    """Batched append over a bounded number of connections."""
    (
        df.write.format("jdbc")
        .mode("append")
        .options(**target.options(), dbtable=table, batchsize=batch_rows, numPartitions=connections)
        .save()
    )
