"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Options the library relies on.  All of them can be overridden by the caller.
SESSION_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "dialwright", master: str | None = None, **options: str) -> SparkSession:
    """Create (or reuse) a session with the options above; ``options`` win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_OPTIONS, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``.  Only a
    session in one process, where driver and executors are the same machine,
    may go without; it then uses a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="dialwright-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def local_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A fixed lookup frame of a few rows.

    Going through Arrow gives Catalyst a local relation of known size, so it
    can decide on a broadcast from statistics instead of from a hint.
    """
    struct = T._parse_datatype_string(schema)
    arrow_schema = to_arrow_schema(struct)
    columns = [pa.array([r[i] for r in rows], type=arrow_schema.field(i).type) for i in range(len(arrow_schema))]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow_schema), schema=struct)
