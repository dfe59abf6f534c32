"""Look-ups, alignments and effective-date joins.

No operator here carries a broadcast hint.  Small dimensions are broadcast by
Catalyst when their statistics are below ``spark.sql.autoBroadcastJoinThreshold``
or by AQE when their measured size is; anything larger is shuffled, and AQE
splits skewed partitions of the fact side.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialwright.operators import scans


def lookup_key(
    fact: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    keys: list[str],
    default: dict[str, object] | None = None,
    trim: bool = False,
) -> DataFrame:
    """Add the ``keys`` columns of ``dim`` to ``fact``.

    ``on`` maps fact columns to natural-key columns, which must be unique in
    ``dim``.  Unknown members get ``default`` values, else NULL.  ``trim``
    ignores blanks around text keys.
    """

    def normal(c: Column) -> Column:
        return F.trim(c) if trim else c

    right = dim.select(*[normal(F.col(d)).alias(f"__{d}") for d in on.values()], *keys)
    condition = [normal(fact[f]) == right[f"__{d}"] for f, d in on.items()]
    joined = fact.join(right, condition, "left").drop(*[f"__{d}" for d in on.values()])
    if default:
        joined = joined.withColumns(
            {k: F.coalesce(F.col(k), F.lit(v).cast(dim.schema[k].dataType)) for k, v in default.items()}
        )
    return joined


def new_members(src: DataFrame, dim: DataFrame, key: list[str]) -> DataFrame:
    """Distinct source keys the dimension does not hold yet."""
    return src.select(*key).dropna(subset=key).distinct().join(dim.select(*key), key, "left_anti")


def align_outer(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Full outer alignment; keys come from whichever side has them, and a missing key matches nothing.

    A full join with a key that holds a large part of both sides stays in one
    task.  A left join and the rows of ``b`` that it does not meet give the same
    rows, and AQE splits a skewed left side of either.
    """
    only_b = b.join(a.select(*on), on, "left_anti")
    return a.join(b, on, "left").unionByName(only_b, allowMissingColumns=True)


def join_on(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi join on one or several key columns."""
    return a.join(b, on, how)


def join_default(a: DataFrame, b: DataFrame, on: list[str], defaults: dict[str, object]) -> DataFrame:
    """Left join where columns missing on the right take a default."""
    joined = a.join(b, on, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def star_join(fact: DataFrame, dims: list[tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """Inner joins of a fact with ``(dimension, key, attributes)`` entries."""
    for dim, key, attributes in dims:
        fact = fact.join(dim.select(key, *attributes), key)
    return fact


def scaffold_days(entities: DataFrame, lo: Column, hi: Column, day: str = "day") -> DataFrame:
    """Every entity on every day from ``lo`` to ``hi``: an expansion, not a cross join.

    The bounds are columns, usually literals or scalar subqueries.  The
    entities are few but grow by the number of days, so they are spread over
    the shuffle partitions first; a given number keeps AQE from merging them.
    """
    partitions = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = entities.repartition(partitions, *entities.columns)
    return spread.withColumn(day, F.explode(F.sequence(lo.cast("date"), hi.cast("date"), F.expr("interval 1 day"))))


def scaffold_minutes(days: DataFrame, step_minutes: int = 15, key: str = "time_key") -> DataFrame:
    """Every row once per step of the day (minutes since midnight)."""
    steps = F.sequence(F.lit(0), F.lit(1440 - step_minutes), F.lit(step_minutes))
    return days.withColumn(key, F.explode(steps))


def left_join_filtered(left: DataFrame, right: DataFrame, on: list[str], keep: Column) -> DataFrame:
    """Left join with constant conditions on the right side only.

    Conditions inside ON that mention only the right side are the same as a
    filter below the join, where they reach the scan.
    """
    return left.join(right.filter(keep), on, "left")


def scalar_lookup(df: DataFrame, value: str, where: Column) -> Column:
    """Single value as a scalar subquery; NULL if absent, the largest if repeated."""
    return df.filter(where).agg(F.max(value)).scalar()


def join_agg(
    left: DataFrame, right: DataFrame, on: list[str], aggs: list[Column], how: str = "left"
) -> DataFrame:
    """Join to an aggregate of the right side."""
    return left.join(right.groupBy(*on).agg(*aggs), on, how)


def price_at(
    fact: DataFrame,
    tariff: DataFrame,
    day: str,
    price: str,
    valid_from: str,
    valid_to: str,
    by: dict[str, str] | None = None,
) -> DataFrame:
    """Add the price in force on ``day``.

    ``by`` pairs fact columns with the tariff columns that name a tariff (fact
    column -> tariff column); without it the table has to hold one tariff.
    Validity ranges are spread to the days the facts span, which turns the
    range condition into an equi join on the day.  The spread side has one row
    per calendar day and tariff line, whatever the size of the fact.  A NULL
    ``valid_to`` is open.  Lines of one tariff that overlap would multiply
    facts, so a day with two prices stops the job.
    """
    by = by or {}
    span = fact.agg(F.struct(F.min(day).cast("date").alias("lo"), F.max(day).cast("date").alias("hi")).alias("s")).scalar()
    names = [F.col(t).alias(f"__by_{f}") for f, t in by.items()]
    bounded = tariff.select(*names, valid_from, valid_to, price, span.alias("__span")).select(
        *[f"__by_{f}" for f in by],
        F.greatest(F.col(valid_from), F.col("__span.lo")).alias("__first"),
        F.least(F.coalesce(F.col(valid_to), F.col("__span.hi")), F.col("__span.hi")).alias("__last"),
        price,
    )
    spread = bounded.filter(F.col("__first") <= F.col("__last")).withColumn(
        "__day", F.explode(F.sequence("__first", "__last", F.expr("interval 1 day")))
    )
    overlap = F.raise_error(F.concat(F.lit("two prices in force on "), F.first("__day").cast("string")))
    per_day = spread.groupBy(*[f"__by_{f}" for f in by], "__day").agg(
        F.when(F.count(F.lit(1)) > 1, overlap.cast(tariff.schema[price].dataType)).otherwise(F.first(price)).alias(price)
    )
    same = [F.col(f) == F.col(f"__by_{f}") for f in by]
    matching = reduce(and_, same, F.col(day).cast("date") == F.col("__day"))
    return fact.join(per_day, matching, "left").drop("__day", *[f"__by_{f}" for f in by])


def price_at_instant(
    fact: DataFrame,
    tariff: DataFrame,
    ts: str,
    price: str,
    valid_from: str,
    valid_to: str,
    by: dict[str, str] | None = None,
) -> DataFrame:
    """Add the price in force at the instant ``ts``; ranges are half-open, a NULL ``valid_to`` is open.

    Ranges are cut to bins of time, facts fall into one bin each, and an equi
    join on tariff and bin is followed by the exact check.  The width of a bin is
    the mean length of the ranges inside the facts' span, so the cut table has
    at most about three rows per range, whatever the lengths.  ``by`` pairs fact
    columns with tariff columns, as in :func:`price_at`.  Ranges of one tariff
    that overlap would multiply facts and stop the job.
    """
    by = by or {}
    names = [f"__by_{f}" for f in by]
    lines = tariff.select(
        *[F.col(t).alias(n) for n, t in zip(names, by.values(), strict=True)],
        _micros(tariff, valid_from).alias("__from"),
        _micros(tariff, valid_to).alias("__to"),
        price,
    ).filter(F.col("__to").isNull() | (F.col("__from") < F.col("__to")))
    clash = F.raise_error(F.lit(f"two values of {price} in force at one time")).cast("boolean")
    checked = scans.with_previous(lines.withColumn("__end", F.coalesce("__to", F.lit(_FAR))), names, ["__from"], "__end", "__before").filter(
        F.when(F.col("__before") > F.col("__from"), clash).otherwise(F.lit(True))
    )
    span = fact.agg(F.struct(F.min(_micros(fact, ts)).alias("lo"), F.max(_micros(fact, ts)).alias("hi")).alias("s")).scalar()
    inside = (
        checked.withColumn("__span", span)
        .withColumn("__first", F.greatest("__from", "__span.lo"))
        .withColumn("__last", F.least(F.col("__end") - 1, F.col("__span.hi")))
        .filter("__first <= __last")
        .drop("__span", "__before", "__end")
    )
    width = inside.agg(F.coalesce(F.ceil(F.avg(F.col("__last") - F.col("__first") + 1)), F.lit(1)).alias("w")).scalar()
    bins = inside.withColumn("__width", width).withColumn("__bin", F.explode(F.expr("sequence(__first div __width, __last div __width)"))).drop("__first", "__last", "__width")
    placed = fact.withColumn("__at", _micros(fact, ts)).withColumn("__width", width).withColumn("__bin", F.expr("__at div __width")).drop("__width")
    facts, ranges = placed.alias("f"), bins.withColumnRenamed("__bin", "__of").alias("r")
    same = reduce(and_, [F.col(f"f.{f}") == F.col(f"r.{n}") for f, n in zip(by, names, strict=True)], F.col("__bin") == F.col("__of"))
    within = (F.col("__at") >= F.col("__from")) & (F.col("__to").isNull() | (F.col("__at") < F.col("__to")))
    return facts.join(ranges, same & within, "left").drop("__at", "__bin", "__of", "__from", "__to", *names)


_FAR = (1 << 63) - 1


def _micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since 1970: of the instant, or of the clock where there is no zone."""
    if isinstance(df.schema[ts].dataType, T.TimestampType):
        return F.unix_micros(ts)
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))


def backfill(
    df: DataFrame,
    actuals: DataFrame,
    on: list[str],
    targets: dict[str, str],
    only: Column | None = None,
) -> DataFrame:
    """Update ``targets`` (target column -> source column) from matching rows.

    Rows without a match, with a NULL source, or outside ``only`` keep what
    they have.  ``actuals`` must be unique on ``on``.
    """
    right = actuals.select(*on, *[F.col(s).alias(f"__{t}") for t, s in targets.items()])
    joined = df.join(right, on, "left")
    eligible = F.lit(True) if only is None else only
    return joined.withColumns(
        {t: F.coalesce(F.when(eligible, F.col(f"__{t}")), F.col(t)) for t in targets}
    ).select(*df.columns)


def union_kinds(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL of frames that miss each other's columns (filled with NULL)."""
    first, *others = frames
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def union_distinct(frames: list[DataFrame]) -> DataFrame:
    """UNION DISTINCT."""
    first, *others = frames
    for other in others:
        first = first.unionByName(other)
    return first.distinct()


def missing_from(src: DataFrame, target: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``src`` whose key does not occur in ``target``."""
    return src.join(target.select(*on), on, "left_anti")
