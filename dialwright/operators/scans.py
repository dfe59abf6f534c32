"""Running values over ordered groups of any size: a segmented prefix scan.

A window partitioned by a group puts the whole group into one task.  Here the
rows are range-partitioned once by group and order and stored; the number of a
partition is the *segment* of its rows.  Ranges follow the data, so a dominant
group is cut into as many segments as its rows need, even inside one instant of
a busy hour.

1. each segment of a group is summarised to one row by a map-side-combined
   aggregate;
2. an exclusive scan over the summaries gives what a segment needs to know about
   the past; a group has at most one summary per segment, and only groups that
   begin in an earlier segment keep a row;
3. those rows are united with the data as the first row of their segment, and
   the window runs inside (group, segment).

A row number that is stored with the rows comes last in the order, so that rows
of one instant can be split, too, and every pass sees them in the same order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from dialwright.session import shared_dir

SEGMENT = "__segment"
PLACE = "__place"  # tells rows of equal order apart
_KIND = "__kind"  # 0: carried from earlier segments, 1: data


def segmented(df: DataFrame, keys: list[str], order: list[str], segments: int | None = None) -> DataFrame:
    """The rows with ``__segment`` and ``__place``, stored in the shared folder.

    ``segments`` fixes the number of ranges; by default Spark's shuffle
    partitions, which AQE merges where they are small.  Storing matters: the
    ranges come from a sample, and every later pass has to see the same ones.
    """
    spark = df.sparkSession
    columns = [*keys, *order, PLACE]
    numbered = df.withColumn(PLACE, F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(segments, *columns) if segments else numbered.repartitionByRange(*columns)
    placed = ranged.withColumn(SEGMENT, F.spark_partition_id())
    path = shared_dir(spark, "segments")
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def last_of_segment(value: str, order: list[str], known: Column | None = None) -> Column:
    """Summary: ``value`` of the last row, or of the last row for which ``known`` holds."""
    place = F.struct(*order, PLACE)
    return F.max_by(value, place if known is None else F.when(known, place))


def carried(segments: DataFrame, keys: list[str], summary: dict[str, Column], how: Callable[[str], Column]) -> DataFrame:
    """Per group and segment what all earlier segments of the group come to.

    ``summary`` reduces one segment, ``how`` reduces the earlier summaries (for
    example ``F.sum`` or the last one).  Groups without an earlier segment have
    no row, so the result has fewer rows than there are segments.
    """
    per = segments.groupBy(*keys, SEGMENT).agg(*[c.alias(n) for n, c in summary.items()])
    past = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    seen = per.select(*keys, SEGMENT, *[how(n).over(past).alias(n) for n in summary], F.count(F.lit(1)).over(past).alias("__n"))
    return seen.filter("__n > 0").drop("__n")


def inside(keys: list[str], order: list[Column | str]) -> WindowSpec:
    """Rows of one segment of a group, the carried row first."""
    return Window.partitionBy(*keys, SEGMENT).orderBy(_KIND, *order, PLACE)


def with_carried(data: DataFrame, seeds: DataFrame) -> DataFrame:
    """The data with the carried rows among them."""
    return data.withColumn(_KIND, F.lit(1)).unionByName(seeds.withColumn(_KIND, F.lit(0)), allowMissingColumns=True)


def without_carried(df: DataFrame) -> DataFrame:
    """The data rows again; they keep their segment and place."""
    return df.filter(F.col(_KIND) == 1).drop(_KIND)


def running_sums(segments: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Add the running sums of ``sums`` (name to addend), own row included; ``segments`` comes from :func:`segmented`."""
    data = segments.withColumns(sums)
    seeds = carried(data, keys, {n: F.sum(n) for n in sums}, F.sum)
    frame = inside(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return without_carried(with_carried(data, seeds).withColumns({n: F.sum(n).over(frame) for n in sums}))


def with_previous(
    df: DataFrame, keys: list[str], order: list[str], value: str, out: str, segments: int | None = None
) -> DataFrame:
    """Add ``out``: ``value`` of the previous row of the group, NULL on its first row."""
    data = segmented(df, keys, order, segments)
    seeds = carried(data, keys, {value: last_of_segment(value, order)}, F.last)
    previous = F.lag(value).over(inside(keys, order))
    return without_carried(with_carried(data, seeds).withColumn(out, previous)).drop(SEGMENT, PLACE)
