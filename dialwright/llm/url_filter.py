"""URL verdicts: host and path rules, then a list of canonical URLs behind a blocked Bloom filter.

The Bloom filter is a table: one row per 256-bit block, built with a grouped
bitwise OR.  A URL looks at one block only.  What passes goes to an exact join
with the list, so false positives of the filter cost a look-up and change no
verdict.  All of it is built-in SQL functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid)(=|$)"
KEYS_PER_BLOCK = 16  # 256 bits for 16 URLs: about 0.1 % of other URLs pass
WORDS, BITS_PER_WORD = 4, 2


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains and every path that starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for a null URL."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def canonical(url: Column, host: Column, path: Column) -> Column:
    """One spelling per page: no scheme, ``www.``, fragment, closing slash or tracking parameters; parameters sorted."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"/+$", ""), tail)


def with_url_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host``, ``path`` and ``canonical_url``."""
    host, path = host_and_path(F.col(url))
    parted = pages.withColumns({"host": host, "path": path})
    return parted.withColumn("canonical_url", canonical(F.col(url), F.col("host"), F.col("path")))


def matching_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null if none does.

    Rules are configuration, a few hundred at most; longer lists of whole URLs
    belong into the Bloom filter.
    """
    name = verdict = F.lit(None).cast("string")
    # The last condition built is tested first, so the longest comes last.
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _masks(url: str) -> list[Column]:
    """The bits of a URL in each word of its block."""
    spread = f"xxhash64('bits', {url})"
    slices = [f"cast(shiftrightunsigned({spread}, {6 * i}) & 63 as int)" for i in range(WORDS * BITS_PER_WORD)]
    return [
        F.expr(" | ".join(f"shiftleft(1L, {s})" for s in slices[w * BITS_PER_WORD : (w + 1) * BITS_PER_WORD]))
        for w in range(WORDS)
    ]


def bloom_blocks(listed: DataFrame, blocks: int, url: str = "listed_url") -> DataFrame:
    """The filter: ``block`` and its words, for the blocks that hold any URL."""
    block = F.pmod(F.xxhash64(F.lit("block"), url), F.lit(blocks)).alias("block")
    marked = listed.select(block, *(m.alias(f"m{w}") for w, m in enumerate(_masks(url))))
    return marked.groupBy("block").agg(*(F.bit_or(f"m{w}").alias(f"w{w}") for w in range(WORDS)))


def judge(
    pages: DataFrame,
    rules: list[Rule],
    listed: DataFrame,
    *,
    key: str = "page_id",
    url: str = "url",
    listed_url: str = "listed_url",
) -> DataFrame:
    """``host``, ``path``, ``rule`` and ``verdict`` for every row of ``pages``.

    A fitting rule decides.  Otherwise a page is blocked if its canonical URL is
    in ``listed`` (duplicates and nulls there do not matter), else allowed.

    The filter's table is joined by block number and the list by URL; Spark
    broadcasts either only when its statistics show it to be small, and shuffles
    otherwise.  Pages that the filter stops get a join key of their own that no
    list holds, so they spread evenly instead of meeting under one null.  Null
    and malformed URLs have empty host and path and are allowed; repeated rows
    stay; an empty list blocks nothing; other columns are left out.
    """
    once = listed.select(F.col(listed_url).alias("listed_url")).where(F.col("listed_url").isNotNull()).distinct()
    blocks = max(1, -(-once.count() // KEYS_PER_BLOCK))
    parted = with_url_parts(pages.select(key, url), url)
    probe = parted.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "canonical_url"), F.lit(blocks)))
    seen = probe.join(bloom_blocks(once, blocks), "block", "left")
    passes = F.lit(True)
    for w, mask in enumerate(_masks("canonical_url")):
        passes = passes & (F.col(f"w{w}").bitwiseAND(mask) == mask)
    nowhere = F.concat(F.lit("\0"), F.xxhash64(key, "canonical_url").cast("string"))
    looked_up = seen.withColumn("listed_url", F.when(F.coalesce(passes, F.lit(False)), F.col("canonical_url")).otherwise(nowhere))
    name, verdict = matching_rule(rules, F.col("host"), F.col("path"))
    return looked_up.join(once.withColumn("is_listed", F.lit(True)), "listed_url", "left").select(
        key,
        "host",
        "path",
        name.alias("rule"),
        F.coalesce(verdict, F.when(F.col("is_listed"), "block").otherwise("allow")).alias("verdict"),
    )


def repeated_urls(pages: DataFrame, *, url: str = "url") -> DataFrame:
    """``listed_url``: canonical URLs that more than one page carries."""
    counted = with_url_parts(pages.select(url), url).groupBy("canonical_url").count()
    return counted.where("count > 1 and canonical_url != ''").select(F.col("canonical_url").alias("listed_url"))
