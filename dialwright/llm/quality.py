"""Quality rules: base counts, then a log-likelihood ratio between trusted texts and the raw corpus.

Word n-grams are hashed into a fixed number of buckets.  Two multinomials over
the buckets are counted, one over all documents and one over those that labels
call good; the log ratio of a bucket's two probabilities is its weight.  A
document's score adds up, for each n-gram length, the mean weight of its
n-grams, so long and short texts compare.  A fixed threshold decides, so the
verdict on a text depends on the two counts only.  Built-in functions do all
of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialwright.llm.common import WORD, stored

SYMBOLS = "#*$%&|<>"
WINDOW = 5  # words of the windows that count as repeated
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
BUCKETS = 1 << 18  # per n-gram length; bounds the weights at 2 x 262,144 rows
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SMOOTHING = 5.0
TRUSTED_DOCUMENTS = 20_000
THRESHOLD = -0.5


def words_of(text: Column) -> Column:
    """The words of a text, none for a null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _gram_buckets(hashes: str) -> tuple[Column, Column]:
    """Buckets of the single words and of the word pairs in a column of word hashes."""
    singles = F.transform(hashes, lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))
    pairs = F.transform(
        F.slice(hashes, 1, F.greatest(F.size(hashes) - 1, F.lit(0))),
        lambda h, i: (F.pmod(F.xxhash64(h, F.get(F.col(hashes), i + 1)), F.lit(BUCKETS)) + BUCKETS).cast("int"),
    )
    return singles, pairs


def _with_word_hashes(docs: DataFrame, text: str) -> DataFrame:
    hashed = F.transform(F.col("__words"), lambda w: F.xxhash64(w))
    return docs.withColumn("__words", words_of(F.col(text))).withColumn("__hashes", hashed)


def trusted_ids(labels: DataFrame, *, most: int = TRUSTED_DOCUMENTS, key: str = "doc_id") -> DataFrame:
    """Keys of documents labelled good and not toxic in all their labels.

    ``most`` bounds this sample of labelled documents, taken by a hash of the
    key; the bound is what lets it be broadcast.
    """
    judged = labels.groupBy(key).agg(F.min("quality").alias("__quality"), F.max("toxic").alias("__toxic"))
    good = judged.where(F.col(key).isNotNull() & (F.col("__quality") == 1) & (F.col("__toxic") == 0))
    return good.orderBy(F.xxhash64(key), key).limit(most).select(F.col(key).alias("__trusted"))


def bucket_weights(
    docs: DataFrame, trusted: DataFrame, *, most: int = TRUSTED_DOCUMENTS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``bucket`` and ``weight``: the log ratio of every bucket that the corpus fills.

    Counts cover all n-grams of all documents; they are summed per bucket before
    the shuffle, so a frequent word costs one row per task.  Both multinomials
    get pseudo-counts of the same weight (``SMOOTHING`` per bucket on the scale
    of the trusted one), so a rare bucket's ratio stays near 1 whether or not
    its texts are labelled.  Without any trusted text all weights are 0.  More
    than ``most`` trusted keys raise: choosing among them is the caller's part.
    """
    chosen = stored(trusted.distinct(), "trusted-keys")
    if chosen.count() > most:
        raise ValueError(f"more than {most} trusted keys; choose with trusted_ids(most={most}) or raise the bound")
    # The sample's size is checked; joined this way no text is shuffled.
    sample = F.broadcast(chosen)
    marked = docs.select(key, text).join(sample, F.col(key) == F.col("__trusted"), "left")
    flagged = marked.select(F.col("__trusted").isNotNull().cast("long").alias("__good"), F.col(text).alias("__text"))
    singles, pairs = _gram_buckets("__hashes")
    grams = _with_word_hashes(flagged, "__text").select("__good", F.explode(F.concat(singles, pairs)).alias("bucket"))
    counted = stored(
        grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("__good").alias("good")), "bucket-counts"
    )
    # At most 2 x BUCKETS rows from here on.
    pair = F.col("bucket") >= BUCKETS
    totals = counted.groupBy(pair.alias("pair")).agg(F.sum("raw").alias("all_raw"), F.sum("good").alias("all_good"))
    expected = F.col("raw") * (F.col("all_good") / F.col("all_raw"))
    ratio = F.log((F.col("good") + SMOOTHING) / (expected + SMOOTHING))
    weighed = counted.withColumn("pair", pair).join(totals, "pair")
    return stored(weighed.select("bucket", F.when(F.col("all_good") > 0, ratio).otherwise(0.0).alias("weight")), "bucket-weights")


def _with_base_counts(docs: DataFrame, text: str) -> DataFrame:
    """Add the base counts and ``__hashes``; repeated windows are found inside each text's own row."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD))
    counted = (
        _with_word_hashes(docs, text)
        .withColumn("__lines", lines)
        .withColumns(
            {
                "n_words": F.size("__hashes").cast("long"),
                "word_chars": F.length(F.array_join("__words", "")).cast("long"),
                "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
                "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            }
        )
        .drop("__words", "__lines", text)
    )
    windows = F.transform(
        F.slice("__hashes", 1, F.greatest(F.size("__hashes") - (WINDOW - 1), F.lit(0))),
        lambda h, i: F.xxhash64(h, *(F.get(F.col("__hashes"), i + k) for k in range(1, WINDOW))),
    )
    repeated = F.size(F.array_distinct("__windows")) < F.size("__windows")
    placed = F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def equals(at: Column, window: Column) -> Column:
        return F.coalesce(window["h"] == F.get(F.col("__placed"), at)["h"], F.lit(False))

    again = F.filter("__placed", lambda x, i: equals(i - 1, x) | equals(i + 1, x))
    covered = F.transform(
        "__starts", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("__starts"), i + 1) - p, F.lit(WINDOW)))
    )
    return (
        counted.withColumn("__windows", windows)
        .withColumn("__placed", F.when(repeated, F.sort_array(placed)))
        .drop("__windows")
        .withColumn("__starts", F.when(F.col("__placed").isNotNull(), F.sort_array(F.transform(again, lambda x: x["i"]))))
        .drop("__placed")
        .withColumn("n_repeat_words", F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"))
        .drop("__starts")
    )


def score_documents(
    docs: DataFrame,
    trusted: DataFrame,
    *,
    threshold: float = THRESHOLD,
    most: int = TRUSTED_DOCUMENTS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row the key, ``text_hash`` (XXH64, null for a null text), the base counts, ``base_failed``, ``score`` and ``kept``.

    A null or empty text has no words and fails the base rules; a null key is
    never trusted but judged like any other row; repeated rows come back as
    often as they came with the same verdict; an empty table gives an empty
    result; other columns are left out.

    The weights have at most 2 x ``BUCKETS`` rows whatever the corpus, so they
    are broadcast.  A document's n-grams are summed in its own task; one row per
    document is shuffled.
    """
    weights = bucket_weights(docs, trusted, most=most, key=key, text=text)
    body = docs.select(
        F.monotonically_increasing_id().alias("__row"),
        F.col(key).alias("__key"),
        F.when(F.col(text).isNotNull(), F.xxhash64(text)).alias("text_hash"),
        F.col(text).alias("__text"),
    )
    singles, pairs = _gram_buckets("__hashes")
    counts = ["__key", "text_hash", *COUNTS]
    grams = _with_base_counts(body, "__text").select(
        "__row", *counts, F.explode_outer(F.concat(singles, pairs)).alias("bucket")
    )
    single = F.col("bucket") < BUCKETS
    summed = (
        grams.join(F.broadcast(weights), "bucket", "left")
        .groupBy("__row")
        .agg(
            *(F.first(c).alias(c) for c in counts),
            F.coalesce(F.sum(F.when(single, F.col("weight"))), F.lit(0.0)).alias("of_words"),
            F.coalesce(F.sum(F.when(~single, F.col("weight"))), F.lit(0.0)).alias("of_pairs"),
        )
    )
    n = F.col("n_words")
    score = F.col("of_words") / F.greatest(n, F.lit(1)) + F.col("of_pairs") / F.greatest(n - 1, F.lit(1))
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * n)
    return (
        summed.select(F.col("__key").alias(key), "text_hash", *COUNTS, failed.alias("base_failed"), score.alias("score"))
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    )


def keep_good(
    docs: DataFrame, trusted: DataFrame, *, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    A verdict depends on the text alone, so kept rows are recognised by key and
    text hash; rows with null keys are matched too.
    """
    kept = score_documents(docs, trusted, threshold=threshold, key=key, text=text).where("kept")
    names = kept.select(F.col(key).alias("__key"), F.col("text_hash").alias("__hash")).distinct()
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.xxhash64(text) == F.col("__hash"))
    return docs.join(names, same, "left_semi")
