"""Windows over long series that stay parallel when one series dominates.

A window partitioned by series alone puts a whole series into one task; a
window without a partition puts everything there.  Both break when one meter
holds a third of the data.  The operators below run inside the segments of
:mod:`dialwright.operators.scans`: the rows are range-partitioned by series and
time once and stored, and each segment starts from one carried row.  Missing
series keys form a series of their own.

The largest unit of work is one segment.  ``segments`` fixes their number; by
default it follows Spark's shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialwright.operators import scans


def _order(ts: str, tie: list[str] | None) -> list[str]:
    return [ts, *(tie or [])]


def _last_known(name: str) -> Column:
    return F.last(name, ignorenulls=True)


def _with_previous(
    df: DataFrame, series: list[str], ts: str, value: str, tie: list[str] | None, segments: int | None
) -> DataFrame:
    """Add ``__prev``: the value of the previous row of the series."""
    return scans.with_previous(df, series, _order(ts, tie), value, "__prev", segments)


def meter_delta(
    df: DataFrame,
    series: list[str],
    ts: str,
    value: str,
    out: str = "delta",
    tie: list[str] | None = None,
    segments: int | None = None,
) -> DataFrame:
    """Consumption between readings of a cumulative meter.

    NULL on the first reading and where the counter went backwards (a reset:
    the true amount is unknown).  ``tie`` orders readings of the same instant.
    """
    previous = _with_previous(df, series, ts, value, tie, segments)
    step = F.col(value) - F.col("__prev")
    return previous.withColumn(out, F.when(F.col(value) >= F.col("__prev"), step)).drop("__prev")


def sensor_delta(
    df: DataFrame,
    series: list[str],
    ts: str,
    value: str,
    out: str = "delta",
    tie: list[str] | None = None,
    segments: int | None = None,
) -> DataFrame:
    """Change of an instantaneous sensor since its previous reading."""
    previous = _with_previous(df, series, ts, value, tie, segments)
    return previous.withColumn(out, F.col(value) - F.col("__prev")).drop("__prev")


def fill_forward(
    df: DataFrame,
    series: list[str],
    ts: str,
    cols: list[str],
    mode: str = "last",
    tie: list[str] | None = None,
    segments: int | None = None,
) -> DataFrame:
    """Fill NULLs of ``cols`` from the past of the same series.

    ``mode="last"`` carries the last observation forward.
    ``mode="running_mean"`` replaces every value by the mean of all
    observations so far, including its own.
    """
    if mode == "last":
        return _carry_last(df, series, ts, cols, tie, segments)
    if mode == "running_mean":
        return _running_mean(df, series, ts, cols, tie, segments)
    raise ValueError(f"unknown fill mode {mode!r}: use 'last' or 'running_mean'")


def _carry_last(
    df: DataFrame, series: list[str], ts: str, cols: list[str], tie: list[str] | None, segments: int | None
) -> DataFrame:
    order = _order(ts, tie)
    data = scans.segmented(df, series, order, segments)
    newest = {c: scans.last_of_segment(c, order, F.col(c).isNotNull()) for c in cols}
    seeds = scans.carried(data, series, newest, _last_known)
    frame = scans.inside(series, order).rowsBetween(Window.unboundedPreceding, 0)
    filled = scans.with_carried(data, seeds).withColumns({c: _last_known(c).over(frame) for c in cols})
    return scans.without_carried(filled).select(*df.columns)


def _running_mean(
    df: DataFrame, series: list[str], ts: str, cols: list[str], tie: list[str] | None, segments: int | None
) -> DataFrame:
    order = _order(ts, tie)
    sums = {f"__sum_{c}": F.col(c).cast("double") for c in cols}
    counts = {f"__n_{c}": F.col(c).isNotNull().cast("bigint") for c in cols}
    summed = scans.running_sums(scans.segmented(df, series, order, segments), series, order, {**sums, **counts})
    means = {c: F.try_divide(F.col(f"__sum_{c}"), F.col(f"__n_{c}")) for c in cols}
    return summed.withColumns(means).select(*df.columns)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    ts: str,
    values: list[str],
    tolerance_minutes: int | None = None,
    right_tie: list[str] | None = None,
    segments: int | None = None,
) -> DataFrame:
    """For each left row the latest right row at or before it, same ``by`` keys.

    Rows of both sides are merged in time order and the last right row is
    carried forward, so neither side is paired with the other and a dominant
    key is spread over segments.  Every left row comes back once; values
    are NULL when there is no right row, or none within the tolerance.
    ``right_tie`` decides between right rows of the same instant.
    """
    tie = right_tie or []
    found = F.struct(F.col(ts).alias("__at"), *values)
    ties = [f"__tie_{t}" for t in tie]
    marks = right.select(*by, ts, *[F.col(t).alias(f"__tie_{t}") for t in tie], found.alias("__found"))
    merged = left.withColumn("__side", F.lit(1)).unionByName(marks.withColumn("__side", F.lit(0)), allowMissingColumns=True)

    order = [ts, "__side", *ties]
    data = scans.segmented(merged, by, order, segments)
    newest = scans.last_of_segment("__found", order, F.col("__side") == 0)
    seeds = scans.carried(data, by, {"__found": newest}, _last_known)
    frame = scans.inside(by, order).rowsBetween(Window.unboundedPreceding, 0)
    found_last = scans.with_carried(data, seeds).withColumn("__hit", _last_known("__found").over(frame))
    hit = F.col("__hit")
    if tolerance_minutes is not None:
        longest = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(tolerance_minutes))
        hit = F.when(F.col(ts) - F.col("__hit.__at") <= longest, hit)
    rows = scans.without_carried(found_last).filter(F.col("__side") == 1).withColumn("__hit", hit)
    return rows.select(*left.columns, *[F.col(f"__hit.{v}").alias(v) for v in values])


def first_per_group(df: DataFrame, keys: list[str], order_by: list[Column | str], n: int = 1) -> DataFrame:
    """The first ``n`` rows per group (for example the shortest forecast horizon).

    Spark limits each group to ``n`` rows before the shuffle as well as after.
    """
    order = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__nth", F.row_number().over(order)).filter(F.col("__nth") <= n).drop("__nth")


def onto_grid(grid: DataFrame, df: DataFrame, on: list[str]) -> DataFrame:
    """Observations on a regular grid; grid points without one hold NULLs."""
    return grid.join(df, on, "left")
