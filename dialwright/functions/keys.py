"""Smart keys: yyyymmdd day keys, minute-of-day keys and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# md5 gives 16**3 = 4096 groups from its first three hex digits.
_KEY_GROUP_DIGITS = 3
_KEY_SEPARATOR = "\u0001"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(ts: Column | str) -> Column:
    """Day as an ``int`` yyyymmdd."""
    ts = _col(ts)
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def time_key(ts: Column | str) -> Column:
    """Minutes since midnight (0-1439)."""
    ts = _col(ts)
    return (F.hour(ts) * 60 + F.minute(ts)).cast("int")


def key_to_date(key: Column | str) -> Column:
    """Inverse of :func:`date_key`; an impossible key gives NULL."""
    return F.try_to_date(_col(key).cast("string"), "yyyyMMdd")


def minutes_of_clock(text: Column | str) -> Column:
    """``HH:mm`` or ``H:mm`` text to minutes since midnight, NULL if malformed or not a time of day."""
    text = F.trim(_col(text))
    hour = F.substring_index(text, ":", 1).try_cast("int")
    minute = F.substring_index(F.substring_index(text, ":", 2), ":", -1).try_cast("int")
    return F.when(text.contains(":") & hour.between(0, 23) & minute.between(0, 59), hour * 60 + minute)


def floor_minutes(ts: Column | str, minutes: int) -> Column:
    """Floor to a step counted from midnight; the result has no time zone.

    Counted in whole minutes since a day long before any data, so there is no
    detour over epoch seconds or the session time zone, and the generated code
    stays small wherever the expression is repeated.
    """
    start = F.lit("0001-01-01").cast("timestamp_ntz")
    passed = F.timestamp_diff("MINUTE", start, _col(ts).cast("timestamp_ntz"))
    return F.timestamp_add("MINUTE", (passed - passed % minutes).cast("int"), start)


def assign_keys(
    members: DataFrame,
    natural_key: list[str],
    key: str,
    start: Column | int = 0,
) -> DataFrame:
    """Number distinct members ``start+1 .. start+n`` without a global sort.

    Members are spread over md5 groups, ranked inside their group, and shifted
    by the sizes of the groups before it.  The order (md5 prefix, natural key)
    is fixed by the data, so a retried task yields the same numbers.  The only
    un-partitioned window runs over the group sizes: at most 4096 rows.
    """
    text = F.concat_ws(_KEY_SEPARATOR, *[F.col(c).cast("string") for c in natural_key])
    start = F.lit(start) if isinstance(start, int) else start
    grouped = members.withColumn("__group", F.substring(F.md5(text), 1, _KEY_GROUP_DIGITS))
    sizes = grouped.groupBy("__group").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__group", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    rank = F.row_number().over(Window.partitionBy("__group").orderBy(*natural_key))
    return (
        grouped.withColumn("__rank", rank)
        .join(offsets, "__group")
        .withColumn(key, (F.coalesce(start, F.lit(0)) + F.col("__offset") + F.col("__rank")).cast("bigint"))
        .drop("__group", "__rank", "__offset")
    )
