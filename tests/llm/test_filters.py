"""Quality rules, mixing, URL verdicts and the fixity audit against brute force."""

from __future__ import annotations

import gzip
import hashlib
import math
import re
from collections import Counter

import pytest
import xxhash
from llm.fixtures import collected, documents, texts
from pyspark.sql import functions as F

from dialwright.llm import mixing, quality, url_filter, warc
from dialwright.llm.url_filter import Rule
from dialwright.session import shared_dir


def spark_hash(*values):
    """XXH64 chained over the values, as a signed number."""
    seed = 42
    for value in values:
        data = value.encode() if isinstance(value, str) else (value & (1 << 64) - 1).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_scores(rows, good):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, _ in rows]
    grams = []
    for own in words:
        h = [spark_hash(w) for w in own]
        grams.append(([x % quality.BUCKETS for x in h], [spark_hash(a, b) % quality.BUCKETS for a, b in zip(h, h[1:], strict=False)]))
    out = []
    totals = []
    for order in (0, 1):
        raw, trusted = Counter(), Counter()
        for (key, _, _), g in zip(rows, grams, strict=True):
            raw.update(g[order])
            if key in good:
                trusted.update(g[order])
        totals.append((raw, trusted, sum(raw.values()), sum(trusted.values())))
    for (key, text, _), own, g in zip(rows, words, grams, strict=True):
        score = 0.0
        for order in (0, 1):
            raw, trusted, all_raw, all_good = totals[order]
            for b in g[order]:
                if all_good:
                    score += math.log((trusted[b] + 5) / (raw[b] * all_good / all_raw + 5)) / max(len(own) - order, 1)
        windows = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
        repeated = {i + k for i in range(len(own) - 4) if windows[tuple(own[i : i + 5])] > 1 for k in range(5)}
        lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        failed = len(own) < 10 or 100 * len(repeated) > 20 * len(own)
        counts = (len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated))
        out.append((key, *counts, failed, round(score, 9), not failed and score >= quality.THRESHOLD))
    return sorted(out, key=repr)


@pytest.mark.parametrize("good", [set(range(20)), set()])
def test_quality_scores(spark, good):
    trusted = spark.createDataFrame([(k,) for k in good], "__trusted long")
    found = quality.score_documents(documents(spark), trusted).withColumn("score", F.round("score", 9)).drop("text_hash")
    assert collected(found) == plain_scores(texts(), good)


def test_quality_keeps_whole_rows(spark):
    trusted = spark.createDataFrame([(k,) for k in range(20)], "__trusted long")
    docs = documents(spark)
    kept = quality.keep_good(docs, trusted)
    assert kept.columns == docs.columns
    want = sorted((repr(r[0]) for r in plain_scores(texts(), set(range(20))) if r[-1]))
    assert sorted(repr(r.doc_id) for r in kept.collect()) == want


def test_trusted_needs_all_labels_good(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 0), (3, 1, 1), (4, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert collected(quality.trusted_ids(labels).where("__trusted is not null")) == [(2,)]


def poisson_quantile(rate, u):
    k, total = 0, math.exp(-rate)
    term = total
    while total <= u:
        k += 1
        term *= rate / k
        total += term
    return k


def test_mixing(spark):
    rows = texts()
    weights = {"hot": 1.0, "s1": 3.0, "s2": 0.0}
    mixed = mixing.mix(documents(spark), weights, budget_rows=200, seed=3)
    sizes = Counter(s for _, _, s in rows)
    want = Counter()
    for key, text, source in rows:
        rate = weights.get(source, 0) / 4 * 200 / sizes[source]
        name = f"{'' if key is None else key}:{hashlib.md5((text or '').encode()).hexdigest()}"
        u = int(hashlib.md5(f"3:{name}".encode()).hexdigest()[:13], 16) / 2**52
        want[key, text, source] += poisson_quantile(rate, u) if rate else 0
    assert Counter((r.doc_id, r.text, r.source) for r in mixed.collect()) == +want
    keys = [r.shuffle_key for r in mixed.collect()]
    assert keys == sorted(keys)
    assert set(mixed.columns) == {*documents(spark).columns, "shuffle_key"}


def test_mixing_defaults_to_equal_shares(spark):
    docs = spark.range(9000).selectExpr("id as doc_id", "if(id % 10 < 7, 'a', if(id % 10 < 9, 'b', null)) as source")
    shares = Counter(r.source for r in mixing.mix(docs, text=None).collect())
    assert all(abs(n - 3000) < 250 for n in shares.values()) and set(shares) == {"a", "b", None}
    assert mixing.mix(docs.limit(0), text=None).count() == 0


def test_mixing_draws_rows_without_a_key_apart(spark):
    docs = spark.range(6000).selectExpr("if(id % 3 = 0, null, if(id % 3 = 1, 5, id)) as doc_id", "concat('text ', id) as text", "'a' as source")
    mixed = mixing.mix(docs).cache()
    for part in ("doc_id is null", "doc_id = 5"):
        own = mixed.where(part)
        assert abs(own.count() - 2000) < 250 and abs(own.select("text").distinct().count() - 2000 * (1 - math.exp(-1))) < 150
    assert mixed.select("shuffle_key").distinct().count() == mixed.count()
    assert collected(mixed) == collected(mixing.mix(docs.repartition(5)))


def test_more_trusted_keys_than_the_bound_stop_the_count(spark):
    docs = documents(spark)
    with pytest.raises(ValueError, match="more than 3 trusted keys"):
        quality.bucket_weights(docs, docs.selectExpr("doc_id as __trusted"), most=3)


def test_mixing_repeats_a_rare_source_as_often_as_its_share_asks(spark):
    n = 9000
    docs = spark.range(n).selectExpr("id as doc_id", "if(id = 5, null, if(id = 6, 'rare', 'common')) as source")
    mixed = mixing.mix(docs, seed=7, text=None).cache()

    def u(*parts):
        return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 2**52

    def quantile(rate, at):
        k, total = 0, math.exp(-rate)
        while total <= at:
            k += 1
            total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        return k

    for key in (5, 6):
        want = sum(quantile(n / 9, u(7, key, *([i] if i else []))) for i in range(3))
        copies = sorted(r.copy for r in mixed.where(f"doc_id = {key}").collect())
        assert copies == list(range(want)) and abs(want - n / 3) < 300
    assert mixed.where("source = 'common'").count() > 2700
    keys = [r.shuffle_key for r in mixed.collect()]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


RULES = [Rule("allow", "org", "/"), Rule("block", "a.org", "/x/"), Rule("allow", "a.org", "/x/y"), Rule("block", "com", "/de/")]
URLS = [
    None, "", "no scheme", "http://", "HTTP://A.Org/x/1", "https://www.a.org/x/y/2?q=1", "http://b.org", "http://b.org/", "http://xa.org/x/",
    "http://shop.com/de/1", "http://shop.com/de/1/?utm_source=z&b=2&a=1#top", "https://www.shop.com/fr?a=1&b=2", "http://shop.com/fr/?b=2&ref=q&a=1",
    "http://ü.com/fr", "http://c.com:80/p?next=http://a.org/x/", "http://c.com#frag/de/", "x://c.com/p//", "x://c.com/p",
]


def plain_verdict(url, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    query = re.match(r"[^?#]*\?([^#]*)", url or "")
    kept = sorted(p for p in (query[1] if query else "").split("&") if p and not re.match(r"(utm_[^=]*|ref|gclid|fbclid)(=|$)", p))
    name = re.sub(r"^www\.", "", host) + path.rstrip("/") + ("?" + "&".join(kept) if kept else "")
    fitting = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fitting, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best.verdict if best else "block" if name in listed else "allow"


def test_url_verdicts(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(3, URLS[10]), (None, URLS[11])]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'h' as host", "1 as block", "'l' as listed_url")
    listed = ["shop.com/fr?a=1&b=2", "c.com/p", "c.com/p", None, "never.seen/"]
    found = collected(url_filter.judge(pages, RULES, spark.createDataFrame([(x,) for x in listed], "listed_url string")))
    assert found == sorted([(k, *plain_verdict(u, listed)) for k, u in rows], key=repr)
    assert any(r[-1] == "block" and r[-2] is None for r in found)
    nothing = url_filter.judge(pages, RULES, spark.createDataFrame([], "listed_url string"))
    assert collected(nothing) == sorted([(k, *plain_verdict(u, [])) for k, u in rows], key=repr)


def test_bloom_filter_has_no_false_negatives(spark):
    listed = spark.range(4000).selectExpr("concat('h.org/', id) as listed_url")
    pages = spark.range(8000).selectExpr("id as page_id", "concat('http://h.org/', id) as url")
    found = url_filter.judge(pages, [], listed)
    assert found.where("(verdict = 'block') != (page_id < 4000)").count() == 0
    blocks = url_filter.bloom_blocks(listed, 250)
    assert blocks.count() <= 250


def test_repeated_urls(spark):
    pages = spark.createDataFrame([(u,) for u in URLS], "url string")
    assert collected(url_filter.repeated_urls(pages)) == [("b.org",), ("c.com/p",), ("shop.com/fr?a=1&b=2",)]


PAGES = [(i, f"http://h.org/{i}", f"<p>page {i} é</p>" * (i % 7)) for i in range(90)] + [
    (5, "http://h.org/5", "<p>page 5 é</p>" * 5), (200, None, None), (None, "http://h.org/n", "x"), (201, "http://h.org/\r\nWARC-Type: evil", ""),
    (202, "http://h.org/long", "y" * 300_000),
]


def pages_of(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as offset", "'p' as path")


def test_warc_round_trip(spark):
    folder = shared_dir(spark, "w")
    index = warc.write_warc(pages_of(spark), folder, records_per_file=20)
    back = collected(warc.read_warc(index, folder).select("page_id", "url", "html"))
    clean = [(i, re.sub(r"[\r\n]+", " ", u or ""), h or "") for i, u, h in PAGES]
    assert back == sorted(clean, key=repr)
    again = warc.write_warc(pages_of(spark).repartition(5), shared_dir(spark, "w"), records_per_file=20)
    assert collected(again.drop("path")) == collected(index.drop("path"))


@pytest.mark.parametrize("per_file", [1000, 20, 1])
def test_audit_finds_exactly_the_damage(spark, per_file):
    folder = shared_dir(spark, "w")
    found = warc.fixity_audit(pages_of(spark), folder, damage_every=9, records_per_file=per_file).collect()
    assert len(found) == len(PAGES)
    members = Counter()
    for number, url, html in PAGES:
        member = gzip.compress(warc.warc_record(number, url, html), compresslevel=6, mtime=0)
        members[hashlib.sha256(member).hexdigest(), warc.damaged(member, 0, 9) == member] += 1
    assert Counter((r.digest, r.intact) for r in found) == members and any(not r.intact for r in found)


def test_audit_of_missing_and_surplus_records(spark):
    folder = shared_dir(spark, "w")
    index = warc.write_warc(pages_of(spark), folder, records_per_file=40)
    leaves = warc.leaf_hashes(index, folder).cache()
    less = leaves.where("not (warc_file = 0 and ordinal >= 16)")
    bad = {(r.warc_file, r.ordinal) for r in warc.audit(leaves, less).where("not intact").collect()}
    want = {(r.warc_file, r.ordinal) for r in leaves.where("warc_file = 0 and ordinal >= 16").collect()}
    assert bad == want and {(r.warc_file, r.ordinal) for r in warc.audit(less, leaves).where("not intact").collect()} == want
    trees = warc.merkle_trees(leaves)
    assert warc.root_digest(trees) == warc.root_digest(warc.merkle_trees(leaves.repartition(7)))
    assert warc.root_digest(trees) != warc.root_digest(warc.merkle_trees(less))


def test_empty_tables(spark):
    none = documents(spark, [])
    trusted = spark.createDataFrame([], "__trusted long")
    assert quality.score_documents(none, trusted).count() == 0
    assert quality.keep_good(none, trusted).count() == 0
    assert mixing.mix(none).count() == 0
    assert url_filter.judge(pages_of(spark, []), RULES, spark.createDataFrame([], "listed_url string")).count() == 0
    assert warc.fixity_audit(pages_of(spark, []), shared_dir(spark, "w")).count() == 0
