"""Wide/long reshaping, slot expansion and regular time grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialwright.functions.keys import floor_minutes

_MINUTES_PER_DAY = 1440


def unpivot_groups(
    df: DataFrame,
    ids: list[str],
    unit_col: str,
    groups: dict[int | str, dict[str, str]],
    types: dict[str, str],
) -> DataFrame:
    """Repeated column groups to one row per (row, unit) with all measures.

    ``groups`` maps a unit to ``{measure: source column}``.  The expansion is a
    narrow ``inline`` over an array of structs: no shuffle.
    """
    # Converting after the expansion needs one cast per measure instead of one
    # per measure and unit; measures whose sources differ in type go first.
    early = {m for m in types if len({df.schema[g[m]].dataType for g in groups.values()}) > 1}
    structs = [
        F.struct(
            F.lit(unit).alias(unit_col),
            *[(F.col(g[m]).try_cast(types[m]) if m in early else F.col(g[m])).alias(m) for m in types],
        )
        for unit, g in groups.items()
    ]
    long = df.select(*ids, F.inline(F.array(*structs)))
    return long.select(*ids, unit_col, *[F.col(m).try_cast(t).alias(m) for m, t in types.items()])


def pivot_measures(
    df: DataFrame,
    keys: list[str],
    name_col: str,
    value_col: str,
    names: dict[str, str],
    agg=F.avg,
) -> DataFrame:
    """Long to wide: one column per entry of ``names`` (value -> column name).

    The value list is mandatory, so Spark needs no extra job to find it and
    the result schema is stable.
    """
    wide = df.groupBy(*keys).pivot(name_col, list(names)).agg(agg(value_col))
    return wide.select(*keys, *[F.col(f"`{value}`").alias(alias) for value, alias in names.items()])


def explode_slots(
    df: DataFrame,
    start: str,
    end: str,
    slot: str = "slot",
    step_minutes: int = 15,
    end_inclusive: bool = False,
) -> DataFrame:
    """One row per step-minute slot an interval touches.

    Both ends are floored to the step.  By default an interval is half-open:
    08:00-09:00 covers four 15-minute slots, and an end inside a slot counts
    that slot.  ``end_inclusive=True`` also counts the slot starting at the
    floored end.  Days are expanded before slots, so one long interval never
    builds an array longer than a day of slots.
    """
    first = floor_minutes(start, step_minutes)
    last = floor_minutes(end, step_minutes)
    if not end_inclusive:
        on_boundary = last == F.col(end).cast("timestamp_ntz")
        last = F.when(on_boundary, F.timestamp_add("MINUTE", F.lit(-step_minutes), last)).otherwise(last)
    ranged = df.withColumns({"__first": first, "__last": last})
    day = F.expr("interval 1 day")
    days = F.sequence(F.col("__first").cast("date"), F.col("__last").cast("date"), day)
    # An empty interval explodes a NULL, which yields no row.
    daily = ranged.withColumn("__day", F.explode(F.when(F.col("__first") <= F.col("__last"), days)))
    midnight = F.col("__day").cast("timestamp_ntz")
    last_of_day = F.timestamp_add("MINUTE", F.lit(_MINUTES_PER_DAY - step_minutes), midnight)
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(step_minutes))
    return daily.withColumn(
        slot,
        F.explode(F.sequence(F.greatest("__first", midnight), F.least("__last", last_of_day), step)),
    ).drop("__first", "__last", "__day")


def time_grid(
    bounds: DataFrame,
    lo: str,
    hi: str,
    ts: str = "ts",
    step_minutes: int = 15,
) -> DataFrame:
    """Regular grid from ``lo`` to at most ``hi`` for every row of ``bounds``.

    ``bounds`` has one row per series (or one row in all).  Steps are expanded
    in blocks of a day, so the arrays stay short whatever the range.
    """
    block = max(_MINUTES_PER_DAY // step_minutes, 1)
    span = F.timestamp_diff("SECOND", F.col(lo), F.col(hi))
    blocks = bounds.withColumn("__n", F.floor(span / (step_minutes * 60))).withColumn(
        "__block", F.explode(F.sequence(F.lit(0), F.floor(F.col("__n") / block)))
    )
    return (
        blocks.withColumn(
            "__i",
            F.explode(F.sequence(F.col("__block") * block, F.least(F.col("__block") * block + (block - 1), F.col("__n")))),
        )
        .withColumn(ts, F.timestamp_add("MINUTE", (F.col("__i") * step_minutes).cast("int"), F.col(lo)))
        .drop(lo, hi, "__n", "__block", "__i")
    )


def heatmap(df: DataFrame, row: str, hour: str, metric: Column, prefix: str = "h") -> DataFrame:
    """Matrix of ``row`` by hour of day (24 columns), empty cells 0."""
    wide = df.groupBy(row).pivot(hour, list(range(24))).agg(metric)
    return wide.select(row, *[F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias(f"{prefix}{h:02d}") for h in range(24)])
