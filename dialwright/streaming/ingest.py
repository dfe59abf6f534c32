"""Structured Streaming counterparts of the batch loads."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dialwright.operators import timeseries
from dialwright.sources.readers import is_missing
from dialwright.sources.sinks import drop_table, replace_partition, write_table


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: str | T.StructType,
    format_: str = "parquet",
    files_per_batch: int | None = None,
    pattern: str | None = None,
    **options: object,
) -> DataFrame:
    """Stream of the files that appear in a folder; each is picked up once."""
    reader = spark.readStream.format(format_).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def run_available(writer) -> StreamingQuery:
    """Process everything that has arrived, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def ingest_new_files(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append new files to a Parquet table exactly once."""
    return run_available(
        stream.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
    )


def _with_watermark(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark on ``__event_time``: Spark accepts only zoned timestamps as event time."""
    return stream.withColumn("__event_time", F.col(ts).cast("timestamp")).withWatermark("__event_time", delay)


def dedupe_stream(stream: DataFrame, ts: str, keys: list[str], delay: str) -> DataFrame:
    """First row per key; a key is forgotten once the watermark has passed it."""
    return _with_watermark(stream, ts, delay).dropDuplicatesWithinWatermark(keys).drop("__event_time")


def tumbling(
    stream: DataFrame, ts: str, keys: list[str], aggs: dict[str, Column], delay: str, width: str = "15 minutes"
) -> DataFrame:
    """Aggregates per fixed window, final once the watermark has passed the window."""
    type_ = stream.schema[ts].dataType
    grouped = _with_watermark(stream, ts, delay).groupBy(F.window("__event_time", width), *keys)
    return grouped.agg(*[c.alias(name) for name, c in aggs.items()]).select(
        F.col("window.start").cast(type_).alias("window_start"),
        F.col("window.end").cast(type_).alias("window_end"),
        *keys,
        *aggs,
    )


def upsert_batches(
    stream: DataFrame, table: str, checkpoint: str, partition_keys: list[str], merge: Callable[[DataFrame, DataFrame | None], DataFrame]
) -> StreamingQuery:
    """Merge each micro-batch into a partitioned table, replacing touched partitions only.

    ``merge(batch, current)`` returns the new rows of the touched partitions;
    ``current`` is None before the first write.  ``merge`` must be keyed: a
    batch replayed after a failure finds its own rows in ``current`` and has to
    come to the same result.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            # Read with the schema the merge gives, so an empty table is just empty.
            shape = merge(batch, None).schema
            try:
                stored = spark.read.schema(shape).parquet(table)
            except AnalysisException as error:
                if not is_missing(error):
                    raise
                replace_partition(merge(batch, None), table, partition_keys)
                return
            current = stored.join(batch.select(*partition_keys).distinct(), partition_keys, "left_semi")
            # The merged rows read the partitions they replace, so they are
            # written aside first.
            aside = f"{checkpoint.rstrip('/')}-merged/batch={batch_id}"
            write_table(merge(batch, current), aside)
            replace_partition(spark.read.schema(shape).parquet(aside), table, partition_keys)
            drop_table(spark, aside)
        finally:
            batch.unpersist()

    return run_available(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint))


class _MeterDelta:
    """One bucket of series: its state is the last emitted reading of each series and the readings that wait for their turn."""

    def __init__(self, fields: T.StructType, result: T.StructType, series: list[str], ts: str, value: str, order: list[str], grace_ms: int) -> None:
        self.fields, self.result, self.series, self.ts, self.value = fields, result, series, ts, value
        self.order, self.grace_ms = order, grace_ms

    def _arrived(self, part: pd.DataFrame) -> pd.DataFrame:
        """Readings of a batch: whole numbers and microseconds with missing values, the rest as it comes."""
        return pd.DataFrame({f.name: _column(f, part[f.name], part.get(f"{_MISSING}{f.name}")) for f in self.fields})

    def _remembered(self, state: GroupState) -> pd.DataFrame:
        lists = state.get if state.exists else [[] for _ in range(len(self.fields) + 1)]
        columns = {f.name: _stored_column(f, stored) for f, stored in zip(self.fields, lists, strict=False)}
        return pd.DataFrame({**columns, "__last": np.array(lists[len(self.fields)], dtype=bool)})

    def __call__(self, key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old = self._remembered(state)
        arrived = [p.assign(__last=False) for p in map(self._arrived, parts) if len(p)]
        rows = pd.concat([old, *arrived], ignore_index=True) if arrived else old
        if rows.empty:
            return
        rows["__new"] = np.arange(len(rows)) >= len(old)
        rows["__at"] = np.arange(len(rows))
        rows["__series"] = rows.groupby(self.series, dropna=False, sort=False).ngroup()
        # Missing values first; of equal readings the older one.
        rows = rows.sort_values(["__series", *self.order, "__at"], na_position="first", ignore_index=True)
        # What comes before the last emitted reading of its series comes too late.
        emitted_up_to = pd.Series(np.where(rows["__last"], rows.index, -1)).groupby(rows["__series"]).transform("max")
        is_late = rows["__new"].to_numpy() & (rows.index.to_numpy() < emitted_up_to.to_numpy())
        late, rows = rows[is_late], rows[~is_late].reset_index(drop=True)
        now = state.getCurrentWatermarkMs() + self.grace_ms
        due = _due(rows[self.ts])
        known = rows["__last"].to_numpy()
        emit = ~known & (due < now)
        value = rows[self.value]
        before = value.shift()
        both = (rows["__series"].diff().eq(0) & value.notna() & before.notna()).to_numpy(dtype=bool)
        step = (value[both] - before[both])[(value[both] >= before[both]).to_numpy(dtype=bool)]
        found = [
            rows[emit].assign(__step=step.reindex(rows.index)[emit], __is_late=False),
            late.assign(__step=None, __is_late=True),
        ]
        # Emitted rows lead their series, so the newest of them is the last one in order.
        done = rows[known | emit].drop_duplicates("__series", keep="last").assign(__last=True)
        waiting = rows[~known & ~emit]
        state.update(tuple(_as_list(pd.concat([done[c], waiting[c]])) for c in [*self.fields.names, "__last"]))
        if len(waiting):
            # A timeout has to lie ahead of the watermark.
            state.setTimeoutTimestamp(max(int(due[~known & ~emit].min()) - self.grace_ms, now - self.grace_ms + 1))
        for part in found:
            if len(part):
                yield self._emitted(part)

    def _emitted(self, part: pd.DataFrame) -> pd.DataFrame:
        columns = dict(zip(self.result.names, [*(f.name for f in self.result.fields[:-2]), "__step", "__is_late"], strict=True))
        types = {f.name: f.dataType for f in self.result}
        return pd.DataFrame({out: _output(types[out], part[c]) for out, c in columns.items()})


# Marks a missing whole number: pandas would turn a column with missing ones into floats.
_MISSING = "__missing_"


def _is_time(type_: T.DataType) -> bool:
    return isinstance(type_, (T.TimestampType, T.TimestampNTZType))


def _column(field: T.StructField, column: pd.Series, missing: pd.Series | None) -> object:
    """A column of Spark rows: whole numbers and times (microseconds) as nullable integers."""
    if _is_time(field.dataType):
        return pd.arrays.IntegerArray(column.to_numpy().astype("datetime64[us]").astype("int64"), column.isna().to_numpy(copy=True))
    if isinstance(field.dataType, T.IntegralType):
        return pd.arrays.IntegerArray(column.to_numpy(dtype="int64", copy=True), missing.to_numpy(dtype=bool, copy=True))
    if isinstance(field.dataType, T.FractionalType) and not isinstance(field.dataType, T.DecimalType):
        return column.to_numpy(dtype="float64")
    return column.astype(object).where(column.notna(), None).to_numpy()


def _stored_column(field: T.StructField, stored: list) -> object:
    """A column of the state."""
    if _is_time(field.dataType) or isinstance(field.dataType, T.IntegralType):
        missing = np.array([v is None for v in stored], dtype=bool)
        return pd.arrays.IntegerArray(np.array([0 if v is None else v for v in stored], dtype="int64"), missing)
    if isinstance(field.dataType, T.FractionalType) and not isinstance(field.dataType, T.DecimalType):
        return np.array(stored, dtype="float64")
    return pd.Series(stored, dtype=object).to_numpy()


def _as_list(column: pd.Series) -> list:
    """Python values, missing ones as None."""
    return column.astype(object).where(column.notna(), None).tolist() if column.hasnans else column.tolist()


def _output(type_: T.DataType, column: pd.Series) -> pd.Series:
    """A column for Spark."""
    if _is_time(type_):
        times = column.to_numpy(dtype="int64", na_value=np.iinfo("int64").min)
        return pd.Series(times.view("datetime64[us]"))
    return pd.Series(_as_list(column), dtype=object)


def _due(times: pd.Series) -> np.ndarray:
    """The millisecond from which a reading may be emitted; one without a time is due at once."""
    return np.where(times.isna(), 0, -(-times.to_numpy(dtype="int64", na_value=0) // 1000))


_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """State outside the heap, saved as changes; a running query keeps its store."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _interval_ms(spark: SparkSession, text: str) -> int:
    span = spark.sql(f"SELECT timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', timestamp_ntz'1970-01-01' + INTERVAL {text}) AS n")
    return span.first()["n"] // 1000


def _state_name(field: T.StructField) -> str:
    """Times are stored as microseconds, with their type before their name."""
    return f"__{field.dataType.simpleString()}__{field.name}" if _is_time(field.dataType) else field.name


def _from_state(name: str) -> Column:
    """A column under the name and type that it has in the stream."""
    found = re.fullmatch(r"__(timestamp|timestamp_ntz)__(.*)", name)
    if not found:
        return F.col(name)
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.col(name), epoch).cast(found[1]).alias(found[2])


def stream_meter_delta(
    stream: DataFrame,
    series: list[str],
    ts: str,
    value: str,
    table: str,
    checkpoint: str,
    out: str = "delta",
    tie: list[str] | None = None,
    delay: str = "0 seconds",
    late_for: str = "365 days",
    buckets: int = 256,
) -> StreamingQuery:
    """Reset-aware meter deltas over a stream of files, with keyed state.

    Readings wait in the state of their series until the newest reading of the
    stream is ``delay`` ahead of them, and are then emitted in time order by an
    event-time timer.  :func:`pending_meter_delta` gives the deltas of what still
    waits.  A reading older than the last emitted one of its series comes too
    late and is emitted at once with ``is_late`` and no delta.  What comes later
    than ``delay`` and ``late_for`` together is dropped by Spark and counted in
    the query's progress.

    The series are dealt by hash to ``buckets`` keys, whose readings of a batch
    are handled together, column by column; one call per series costs more than
    its few readings.  The state is the last reading and the waiting ones of
    each series of a bucket, in RocksDB; a batch touches the buckets that it
    brings or that are due, and no table is rewritten.  Output is appended
    exactly once.  A bucket's readings of one batch are handled by one task, so
    ``buckets`` has to follow the size of the stream; it is part of the
    checkpoint and stays as it was at the first start.  ``ts`` is a timestamp
    without a zone.
    """
    spark = stream.sparkSession
    order = [ts, *(tie or [])]
    others = [f for f in stream.schema.fields if f.name not in series]
    fields = T.StructType([*[stream.schema[s] for s in series], *others])
    result = T.StructType([*fields.fields, T.StructField(out, stream.schema[value].dataType), T.StructField("is_late", T.BooleanType())])
    grace_ms = _interval_ms(spark, late_for)
    marked = _with_watermark(stream, ts, f"{_interval_ms(spark, delay) + grace_ms} milliseconds")
    whole = [f.name for f in fields if isinstance(f.dataType, T.IntegralType)]
    # xxhash64 passes over missing values, so a series without a name has a bucket too.
    bucket = F.pmod(F.xxhash64(*series), F.lit(buckets)).cast("int")
    marked = marked.withColumns({"__bucket": bucket, **{f"{_MISSING}{c}": F.col(c).isNull() for c in whole}})
    marked = marked.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(fields[c].dataType)) for c in whole})
    state = T.StructType(
        [
            *[T.StructField(_state_name(f), T.ArrayType(T.LongType() if _is_time(f.dataType) else f.dataType)) for f in fields],
            T.StructField("__last", T.ArrayType(T.BooleanType())),
        ]
    )
    deltas = marked.groupBy("__bucket").applyInPandasWithState(
        _MeterDelta(fields, result, series, ts, value, order, grace_ms), result, state, "append", GroupStateTimeout.EventTimeTimeout
    )
    with _state_in_rocksdb(spark):
        return ingest_new_files(deltas, table, checkpoint)


def pending_meter_delta(
    spark: SparkSession,
    checkpoint: str,
    series: list[str],
    ts: str,
    value: str,
    out: str = "delta",
    tie: list[str] | None = None,
) -> DataFrame:
    """Deltas of the readings that wait in the state of :func:`stream_meter_delta`."""

    with _state_in_rocksdb(spark):
        states = spark.read.format("statestore").option("path", checkpoint).load().select("value.groupState.*")
        rows = states.select(F.inline(F.arrays_zip(*states.columns)))
        delta = timeseries.meter_delta(rows.select(*map(_from_state, rows.columns)), series, ts, value, out, tie)
    return delta.filter("NOT __last").drop("__last")
