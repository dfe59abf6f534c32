"""Filter interaction audit: what each filter removes at each place of every order of the filters.

Documents are first reduced to mask cells: per part and per set of filters that
fail, the number of documents and of labelled ones.  Everything after that works
on cells, whose number depends on the parts and the filters, not on documents.
The orders grow in a recursive common table expression: each level extends the
prefixes by a letter that they lack, meets the part's cells with the bits applied
so far, and gives the metrics of that step.
"""

from __future__ import annotations

import math
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialwright.llm.common import stored
from dialwright.session import local_frame

LETTERS = "ABCDE"
_SPACE = r"[\x20\x09-\x0D]+"
#: Characters whose presence fails filter D.
SYMBOLS = r"[#$%&*|]"


def own_mask(text: Column) -> Column:
    """Bits of the filters that look at one text only, A to D; the words of a text are made once."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")

    def few_or_repeated(w: Column) -> Column:
        n, distinct = F.size(w), F.size(F.array_distinct(w))
        return F.when(n < 200, 1).otherwise(0) + F.when(2 * distinct < n, 2).otherwise(0)

    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return (
        F.element_at(F.transform(F.array(words), few_or_repeated), 1)
        + F.when(100 * capitals.cast("long") > 2 * F.length(text).cast("long"), 4).otherwise(0)
        + F.when(text.rlike(SYMBOLS), 8).otherwise(0)
    )


def masked_documents(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per document: key, ``part`` and ``mask``, the bits of the filters that it fails (A is the lowest).

    The last filter fails where a smaller key has the same text.  Texts are
    compared by their SHA-256; only those that occur twice take part in the
    look-up, which goes against a stored table so that a text with very many
    copies can be split over tasks.  A row without a key has no smaller or
    larger one: it neither fails for its text nor makes another fail.
    """
    rows = docs.select(
        F.col(key).alias("doc"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("__text"),
    )
    own = stored(
        rows.select("doc", "part", own_mask(F.col("__text")).alias("own"), F.unhex(F.sha2("__text", 256)).alias("digest")),
        "filter-masks",
    )
    ranges = own.groupBy("digest").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    repeated = stored(ranges.filter("first < last").select("digest", "first"), "filter-copies")
    joined = own.join(repeated, "digest", "left")
    copied = F.when(F.col("doc") > F.col("first"), 1 << LETTERS.index("E")).otherwise(0)
    return joined.select("doc", "part", (F.col("own") + copied).alias("mask"))


def mask_cells(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part and mask: ``n`` documents, ``good`` and ``toxic`` ones.

    A document counts as good (toxic) when any of its labels says so.  Equal
    rows of key, part and mask are one weighted row before the join, so a
    repeated or missing key is no hot one there.
    """
    flags = (
        labels.filter(F.col("doc_id").isNotNull() & ((F.col("quality") == 1) | (F.col("toxic") == 1)))
        .groupBy(F.col("doc_id").alias("doc"))
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    )
    weighted = masked.groupBy("doc", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    return (
        weighted.join(flags, "doc", "left")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("good"),
            F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), F.lit(0)).alias("toxic"),
        )
    )


def _steps_sql() -> str:
    """Metrics of every prefix of every order, per part; a part's cells travel as one array of at most 32."""

    def count(of: str, condition: str) -> str:
        return f"aggregate(filter(cells, c -> {condition}), 0L, (a, c) -> a + c.{of})"

    remaining = f"filter(array({', '.join(f'{1 << i}' for i in range(len(LETTERS)))}), b -> applied & b = 0)"
    here, passed = "c.mask & bit <> 0", "c.mask & applied"
    return f"""
WITH RECURSIVE steps AS (
  SELECT part, cells, '' AS prefix, 0 AS applied, 0 AS step, 0L AS kept, 0L AS removed, 0L AS redundant,
         0L AS unique_fails, 0L AS good_lost, 0L AS toxic_lost
  FROM {{parts}}
  UNION ALL
  SELECT part, cells, concat(prefix, substr('{LETTERS}', CAST(log2(bit) AS INT) + 1, 1)), applied | bit, step + 1,
         {count('n', f'({passed}) = 0 AND c.mask & bit = 0')},
         {count('n', f'({passed}) = 0 AND {here}')},
         {count('n', f'({passed}) <> 0 AND {here}')},
         {count('n', 'c.mask = bit')},
         {count('good', f'({passed}) = 0 AND {here}')},
         {count('toxic', f'({passed}) = 0 AND {here}')}
  FROM (SELECT *, explode({remaining}) AS bit FROM steps)
)
SELECT part, prefix, step, right(prefix, 1) AS letter, kept, removed, redundant, unique_fails, good_lost, toxic_lost
FROM steps WHERE step > 0"""


def filter_audit(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """One row per part, order of the five filters and step.

    Columns: ``part`` (the source; a null one counts as the empty string),
    ``filter_order``, ``step`` (1 to 5), and counts inside the part: ``kept``
    after the step, ``removed`` by it, ``redundant`` (fail its filter but were
    removed before), ``unique_fails`` (fail its filter only), ``good_lost`` and
    ``toxic_lost`` (removed here, by ``labels``), ``shapley`` (what its filter
    removes, summed over all orders).

    A null text is empty.  Repeated rows count each.  Labels without a document
    or without an id change nothing; several labels of one id are united.  An
    empty table of documents has no part and gives no row.
    """
    spark = docs.sparkSession
    cells = mask_cells(masked_documents(docs, key=key, text=text, source=source), labels)
    cell = F.struct("mask", "n", "good", "toxic")
    parts = stored(cells.groupBy("part").agg(F.collect_list(cell).alias("cells")), "filter-cells")
    # A prefix grows once per level, so a part has 325 rows in all; their number is not bounded otherwise.
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        steps = stored(spark.sql(_steps_sql(), parts=parts), "filter-steps")
    finally:
        spark.conf.set(limit, before)
    # A prefix of k letters begins (5 - k)! orders.
    begun = F.element_at(F.array(*[F.lit(math.factorial(len(LETTERS) - k)) for k in range(1, len(LETTERS) + 1)]), F.col("step"))
    shapley = steps.groupBy("part", "letter").agg(F.sum(F.col("removed") * begun).alias("shapley"))
    orders = local_frame(spark, [(o, k, o[:k]) for o in _orders() for k in range(1, len(o) + 1)], "filter_order string, step int, prefix string")
    return (
        steps.drop("step")
        .join(shapley, ["part", "letter"])
        .join(F.broadcast(orders), "prefix")  # 600 rows, whatever the data
        .select(
            "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
        )
    )


def _orders() -> list[str]:
    """All orders of the letters, alphabetically."""
    return ["".join(p) for p in permutations(LETTERS)]
