"""Mix sources to target weights by Poisson replication.

A document of a source whose target rate is r appears Poisson(r) times.  The
draw inverts the distribution at a number hashed from seed, key and text, so a
rerun, a retry or another partitioning gives the same corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialwright.llm.common import stored

#: A larger rate is drawn as the sum of equal parts, each at most this.
PART_RATE = 1000.0
#: Copies that one row makes at once; more come from several rows.
BLOCK = 1000


def uniform(*parts: Column) -> Column:
    """A double in [0, 1) hashed from the parts: the first 52 bits of their MD5."""
    digits = F.substring(F.md5(F.concat_ws(":", *(p.cast("string") for p in parts))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_cdf(rate: Column) -> Column:
    """Distribution function at 0, 1, 2, ... until what is left is below a double's precision."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")
    start = F.struct(
        (-rate).alias("log_term"), F.exp(-rate).alias("total"), F.array(F.exp(-rate)).alias("values")
    )

    def step(state: Column, k: Column) -> Column:
        log_term = state["log_term"] + F.log(rate) - F.log(k.cast("double"))
        total = state["total"] + F.exp(log_term)
        return F.struct(
            log_term.alias("log_term"), total.alias("total"), F.concat(state["values"], F.array(total)).alias("values")
        )

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda state: state["values"])


def source_rates(
    docs: DataFrame, weights: dict[str, float] | None, *, budget_rows: float | None = None, source: str = "source"
) -> DataFrame:
    """``__source``, ``__parts``, and ``__rate`` and distribution function ``__cdf`` of each part, per source.

    A sum of independent Poisson draws is a Poisson draw of the summed rate, so
    a rate above ``PART_RATE`` is cut into ``__parts`` equal ones.

    ``weights`` are shares of the result (any scale); a source not named gets
    none.  Without weights all sources count alike.  ``budget_rows`` is the
    expected size of the result, by default that of ``docs``.
    """
    held = docs.groupBy(F.coalesce(F.col(source), F.lit("\0")).alias("__source")).agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for name, share in weights.items():
            weight = F.when(F.col("__source") == name, float(share)).otherwise(weight)
    # One row per source; totals over them come from an aggregate joined back as a scalar.
    held = stored(held.withColumn("weight", weight), "source-sizes")
    total = held.agg(F.sum("weight").alias("w"), F.sum("n").alias("n")).first()
    budget = float(budget_rows if budget_rows is not None else total["n"] or 0)
    rate = F.col("weight") / F.lit(float(total["w"] or 1)) * F.lit(budget) / F.col("n")
    parts = F.greatest(F.ceil(rate / PART_RATE), F.lit(1).cast("long"))
    rated = held.select("__source", parts.alias("__parts"), (rate / parts).alias("__rate"))
    return rated.withColumn("__cdf", F.when(F.col("__rate") > 0, poisson_cdf(F.col("__rate"))))


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    *,
    budget_rows: float | None = None,
    seed: int = 7,
    key: str = "doc_id",
    text: str | None = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` with every row repeated by its draw, in a global random order.

    Adds ``copy`` (from 0) and ``shuffle_key``, which replace columns of those
    names; range partitions of ``shuffle_key``, sorted inside, are the order.
    All other columns are kept.  Draw and place depend on key and text, so rows
    without a key or with a common one are drawn apart and spread like others;
    only rows equal in both share their draw, and each keeps its own copies.
    ``text=None`` is for tables whose keys are unique.  A null key or text
    counts as empty, a null source is a source of its own; an empty table gives
    an empty result.

    The rates are a stored table of one row per source: Spark joins it by
    broadcast when the file is small, so texts move once, in the final shuffle.
    """
    rates = stored(source_rates(docs, weights, budget_rows=budget_rows, source=source), "source-rates")
    keyed = docs.withColumn("__source", F.coalesce(F.col(source), F.lit("\0")))
    known = F.coalesce(F.col(key).cast("string"), F.lit(""))
    own = known if text is None else F.concat_ws(":", known, F.md5(F.coalesce(F.col(text), F.lit(""))))
    name = F.col("__name")
    named = keyed.withColumn("__name", own).join(rates, "__source")
    drawn = named.withColumn("__u", uniform(F.lit(seed), name))

    def quantile(u: Column) -> Column:
        return F.size(F.filter("__cdf", lambda c: c <= u))

    # The first part's number is that of a rate without parts.
    others = F.sequence(F.lit(1).cast("long"), F.col("__parts") - 1)
    summed = F.aggregate(others, quantile(F.col("__u")), lambda n, i: n + quantile(uniform(F.lit(seed), name, i)))
    count = F.when(F.col("__rate") > 0, F.when(F.col("__parts") > 1, summed).otherwise(quantile(F.col("__u")))).otherwise(0)
    # A separate column first: copies are made of the kept columns only.
    spare = ["__source", "__parts", "__rate", "__cdf", "__u", "copy", "shuffle_key"]

    def counted(rows: DataFrame) -> DataFrame:
        return rows.withColumn("__n", count).where("__n > 0").drop(*spare)

    if rates.where("__parts > 1").isEmpty():
        copies = counted(drawn).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("__n") - 1))).drop("__n")
    else:
        few = counted(drawn.where("__parts = 1")).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("__n") - 1))).drop("__n")
        # One document's blocks of copies go to different tasks.
        blocks = counted(drawn.where("__parts > 1")).withColumn("__from", F.explode(F.sequence(F.lit(0), F.col("__n") - 1, F.lit(BLOCK))))
        dealt = blocks.repartition(F.xxhash64(name, "__from"))
        last = F.least(F.col("__from") + (BLOCK - 1), F.col("__n") - 1)
        copies = few.union(dealt.withColumn("copy", F.explode(F.sequence("__from", last))).drop("__n", "__from"))
    place = F.md5(F.concat_ws(":", F.lit(seed + 1), name, "copy"))
    placed = copies.withColumn("shuffle_key", place).drop("__name")
    return placed.repartitionByRange("shuffle_key").sortWithinPartitions("shuffle_key")
