"""Operators on small tables against plain Python, and their behaviour on hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from sitegauge.functions import contacts as C
from sitegauge.functions import html as H
from sitegauge.operators import aggregates as A
from sitegauge.operators import crawl as W
from sitegauge.operators import evidence as E
from sitegauge.operators import streaks
from sitegauge.operators.joins import lookup_join
from sitegauge.operators.ranking import per_group_top_k
from sitegauge.plans import gold as G
from sitegauge.sources import robots as B
from sitegauge.sources import sitemaps as M
from sitegauge.sources import tables as I


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("parts", [1, 7])
def test_streak_over_chunks(spark, parts):
    rng = random.Random(5)
    data = [(site, i, rng.random() < 0.7) for site in ("hot", "cold") for i in range(600 if site == "hot" else 20)]
    want, run = {}, {}
    for site, i, bad in data:
        run[site] = run.get(site, 0) + 1 if bad else 0
        want[site, i] = run[site]
    df = spark.createDataFrame(data, "site string, i int, bad boolean").repartition(parts)
    for width in (1, 7, 1000):
        out = streaks.running_streak(df, ["site"], ["i"], F.col("bad"), F.floor(F.col("i") / width))
        assert {(r.site, r.i): r.streak for r in out.collect()} == want


def test_failure_streak_kinds(spark):
    log = [("a", i, "http_error", 404) for i in range(6)] + [("b", i, "blocked", 403) for i in range(5)] + [("c", i, "http_error", 500) for i in range(4)]
    df = spark.createDataFrame(log, "site string, i int, fetch_status string, http_status int")
    out = streaks.failure_streak(df, "site", ["i"], F.lit(0))
    assert rows(out) == [("a", 0, False), ("b", 5, True), ("c", 4, False)]


def plan_input(spark, products, contacts, others):
    data = [("s", "u/", "u", "", "home", 0)]
    data += [("s", f"u/products/{i:03}", f"u/products/{i:03}", f"products/{i:03}", "product", 2) for i in range(products)]
    data += [("s", f"u/contact/{i:03}", f"u/contact/{i:03}", f"contact/{i:03}", "about", 2) for i in range(contacts)]
    data += [("s", f"u/other/{i:03}", f"u/other/{i:03}", f"other/{i:03}", "other", 2) for i in range(others)]
    return spark.createDataFrame(data, "serial_no string, url string, url_key string, relative_path string, page_type string, depth int")


@pytest.mark.parametrize("parts", [1, 5])
def test_crawl_plan_caps(spark, parts):
    got = {r.visit_order: r.page_type for r in W.crawl_plan(
        plan_input(spark, 100, 12, 30).repartition(parts), max_pages=100, max_products=80, max_contacts=10).collect()}
    assert len(got) == 100 and got[0] == "home"
    assert [got[i] for i in range(1, 11)] == ["about"] * 10
    assert sum(t == "product" for t in got.values()) == 80
    assert [got[i] for i in range(11, 91)] == ["product"] * 80


def test_crawl_plan_small_site(spark):
    assert W.crawl_plan(plan_input(spark, 2, 1, 1)).count() == 5


def test_crawl_plan_without_limits_is_the_whole_order(spark):
    got = W.crawl_plan(plan_input(spark, 100, 12, 30)).collect()
    assert sorted(r.visit_order for r in got) == list(range(143))


def test_crawl_plan_has_one_start_page(spark):
    two = plan_input(spark, 2, 1, 1).unionByName(spark.createDataFrame(
        [("s", "u/en", "u/en", "en", "home", 1)], "serial_no string, url string, url_key string, relative_path string, page_type string, depth int"))
    start = [r.url for r in W.crawl_plan(two).where("visit_order = 0").collect()]
    assert start == ["u/"]
    keyed = two.withColumn("start_key", F.lit("u/en"))
    assert [r.url for r in W.crawl_plan(keyed).where("visit_order = 0").collect()] == ["u/en"]
    closed = two.withColumn("allowed", F.col("url") != "u/")
    assert W.crawl_plan(closed).count() == 0


def test_rows_with_nulls_stay(spark):
    df = spark.createDataFrame([(None, 1), ("a", 3), ("a", 1)], "brand string, n int")
    assert sorted((r.brand or "", r.share) for r in A.share_of_partition(df, "n", "brand", "share", spread=["n"]).collect()) == [("", 1.0), ("a", 0.25), ("a", 0.75)]
    log = spark.createDataFrame([("s", None, "error"), ("s", 1, "error"), (None, 1, "error")], "site string, i int, fetch_status string")
    runs = streaks.running_streak(log, ["site"], ["i"], F.col("fetch_status") == "error", F.col("i"))
    assert sorted((r.site or "", r.i or 0, r.streak) for r in runs.collect()) == [("", 1, 1), ("s", 0, 1), ("s", 1, 2)]


def test_many_contacts_stay(spark):
    found = F.transform(F.sequence(F.lit(0), F.lit(59)), lambda i: F.struct(
        (i % 30).cast("string").alias("value"), i.cast("string").alias("context"), F.lit("text").alias("source")))
    got = spark.range(1).select(C.contacts_first_wins(found).alias("c")).first().c
    assert [(r.value, r.context) for r in got] == [(str(k), str(k)) for k in range(30)]


def test_whole_texts_and_blocks_stay(spark):
    long = "word " * 20_000
    html = f"<html><head><title>{long}</title></head><body><main>{long} end</main></body></html>"
    row = spark.createDataFrame([(html,)], "html string").select(
        F.length(H.html_title("html")).alias("t"), F.length(H.html_main_text("html")).alias("m")).first()
    assert (row.t, row.m) == (99_999, 100_003)


def test_zip_in_two_states(spark):
    addresses = spark.createDataFrame([("1", "TX", "10001"), ("2", None, "10001"), ("3", "NY", "10001")], "serial_no string, state string, zip string")
    places = spark.createDataFrame([("10001", "tx", 1.0, 2.0, "A", "a"), ("10001", "OH", 3.0, 4.0, "B", "b"), ("10001", None, 5.0, 6.0, "C", "c")],
                                   "zip string, state string, latitude double, longitude double, geocoded_city string, geocoded_place string")
    got = {r.serial_no: r.geocoded_city for r in E.geo_lookup(addresses, places).collect()}
    assert got == {"1": "A", "2": None, "3": "C"}


def test_failed_and_repeated_sitemaps(spark):
    files = spark.createDataFrame([("s", 0, "x/1", "https://a.com/t", None), ("s", 1, "x/1", "https://a.com/t", None), ("s", 2, "x/2", "https://a.com/u", "timeout")],
                                  "site string, file_order int, file_url string, text string, error string")
    assert [r.url for r in M.parse_sitemap_text(files).collect()] == ["https://a.com/t"]
    assert rows(M.sitemap_stats(files)) == [("s", 1, 1)]


def test_top_k_same_with_and_without_salt(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), (F.col("id") * 7919 % 5000).alias("v"), "id")
    plain = per_group_top_k(df, ["k"], ["v", "id"], 20)
    assert rows(per_group_top_k(df.repartition(6), ["k"], ["v", "id"], 20, spread=["id"])) == rows(plain)


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_on_hot_key(spark, threshold, how):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        facts = spark.range(2000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("k"), "id")
        lookup = spark.range(0, 900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        assert rows(lookup_join(facts, lookup, "k", how, spread=["id"])) == rows(facts.join(lookup, ["k"], how))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_shares_sum_to_one(spark):
    df = spark.range(1, 400).select((F.col("id") % 5).alias("g"), F.col("id").alias("v"))
    sums = A.share_of_partition(df, "v", "g", "s", spread=["v"]).groupBy("g").agg(F.round(F.sum("s"), 9).alias("s"))
    assert {r.s for r in sums.collect()} == {1.0}


def test_median_is_exact_and_truncated(spark):
    df = spark.createDataFrame([("a", 3), ("a", 4), ("b", 7), ("c", None)], "site string, word_count int").withColumn("fetch_status", F.lit("ok"))
    assert rows(A.median_words(df, "site")) == [("a", 3), ("b", 7), ("c", None)]


def test_pick_prefers_score_then_pages_then_value(spark):
    data = [("s", "v1", 1, "u1"), ("s", "v1", 1, "u2"), ("s", "v2", 3, "u9"), ("t", "b", 0, "u1"), ("t", "a", 0, "u1"), ("r", "x", 0, "u1"), ("r", "y", 0, "u1"), ("r", "y", 0, "u2")]
    df = spark.createDataFrame(data, "serial_no string, value string, score int, url string").withColumn("context", F.lit(""))
    out = E.pick_best_evidence(df, F.struct("score", F.lit("m").alias("match")))
    assert {r.serial_no: r.value for r in out.collect()} == {"s": "v2", "t": "a", "r": "y"}


def test_dedup_keeps_null_texts(spark):
    data = [("1", u, t, "ok", f"https://a.com/{u}", "other", None, 50, None) for u, t in [("b", "same"), ("a", "same"), ("c", None), ("d", None)]]
    pages = spark.createDataFrame(data, "serial_no string, url string, body_text string, fetch_status string, final_url string, page_type string, h1 string, word_count int, meta_description string")
    status = spark.createDataFrame([("1", "https://A.com/")], "serial_no string, base_url string")
    assert sorted(r.url for r in G.clean_pages(pages, status).collect()) == ["a", "c", "d"]
    assert sorted(r.url for r in G.clean_pages(G.page_features(pages), status).collect()) == ["a", "c", "d"]


def test_page_texts_are_not_shuffled(spark):
    schema = "serial_no string, url string, body_text string, fetch_status string, final_url string, page_type string, h1 string, word_count int, meta_description string"
    status = spark.createDataFrame([("1", "https://A.com/")], "serial_no string, base_url string")
    plan = G.clean_pages(G.page_features(spark.createDataFrame([], schema)), status)
    assert "body_text" not in plan.columns


def test_theme_threshold(spark):
    company = spark.createDataFrame([(1, "A", "A"), (2, "B", "B"), (3, "C", "C")], "serial_no int, company_name string, brand string")
    data = [(1, i, "gps") for i in range(20)] + [(2, i, "gps") for i in range(19)]
    pages = spark.createDataFrame(data, "serial_no int, i int, body_text string").withColumn("word_count", F.lit(20))
    flagged = pages.select("*", *A.theme_flags("body_text", {"T": "gps", "U": "zzz"}))
    out = {(r.serial_no, r.theme): (r.pages_mentioning, r.pct_pages, r.has_data) for r in G.tech_mentions(company, flagged, {"T": "gps", "U": "zzz"}).collect()}
    assert len(out) == 6
    assert out[1, "T"] == (20, 100.0, True) and out[1, "U"] == (0, 0.0, True)
    assert out[2, "T"] == (None, None, False) and out[3, "T"] == (None, None, False)


def test_news_grid_has_zeros(spark):
    company = spark.createDataFrame([(1, "A", "A"), (2, "B", "B")], "serial_no int, company_name string, brand string")
    urls = spark.createDataFrame([("1", "u1", "news/2024/x", "news"), ("1", "u1", "news/2024/x", "news"), ("2", "u2", "news/1999/x", "news")],
                                 "serial_no string, url string, relative_path string, page_type string")
    out = {r.year: r.news_pages for r in G.news_by_year(company, urls, 2026).collect()}
    assert out == {2022: 0, 2023: 0, 2024: 1, 2025: 0, 2026: 0}


ROBOTS = """User-agent: *
Disallow: /a
Allow: /a/b

User-agent: Gauge
User-agent: Other
Crawl-delay: 4
Disallow:

Disallow: /ignored
Sitemap: https://x.com/s.xml"""


def test_robots(spark):
    files = spark.createDataFrame([("h1", 200, ROBOTS), ("h2", 403, ""), ("h3", 404, "User-agent: *\nDisallow: /"), ("h4", None, "")],
                                  "host string, http_status int, text string")
    urls = spark.createDataFrame([(h, f"https://{h}/a/b") for h in ("h1", "h2", "h3", "h4", "h5")] + [("h1", "https://h1/c")], "host string, url string")

    def allowed(agent):
        return {r.url: r.allowed for r in B.robots_allow(urls, B.robots_policy(files, agent)).collect()}
    general = allowed("nobody/1.0")
    assert general == {"https://h1/a/b": False, "https://h1/c": True, "https://h2/a/b": False, "https://h3/a/b": True, "https://h4/a/b": True, "https://h5/a/b": True}
    assert allowed("GaugeBot/1.0")["https://h1/a/b"] is True
    policy = {r.host: r for r in B.robots_policy(files, "gauge").collect()}
    assert policy["h1"].crawl_delay == 4 and policy["h1"].sitemaps == ["https://x.com/s.xml"]


def test_sitemaps(spark):
    xml = "<urlset><ns:url><ns:loc><![CDATA[ https://a.com/x ]]></ns:loc></ns:url><url><loc>https://a.com/y&amp;z</loc><lastmod> 2024 </lastmod></url><url><loc>https://a.com/x</loc><lastmod>9</lastmod></url></urlset>"
    files = spark.createDataFrame([("s", 0, xml, None), ("s", 1, "<sitemapindex><loc>https://a.com/1.xml</loc></sitemapindex>", None), ("s", 2, "https://a.com/t\r\n  https://a.com/x \nnope", None),
                                   ("s", 3, None, "timeout")], "site string, file_order int, text string, error string")
    assert {(r.url, r.lastmod) for r in M.sitemap_entries(files).collect()} == {("https://a.com/x", None), ("https://a.com/y&z", "2024"), ("https://a.com/t", None)}
    assert [r.child_url for r in M.parse_sitemap_index(files).collect()] == ["https://a.com/1.xml"]
    assert rows(M.sitemap_stats(files)) == [("s", 3, 1)]
    assert rows(M.sitemap_stats(files, limit=2)) == [("s", 2, 0)]


def test_geo(spark):
    addresses = spark.createDataFrame([("1", "TX", "10001"), ("2", "OH", "10002"), ("3", "TX", "10003")], "serial_no string, state string, zip string")
    gazetteer = spark.createDataFrame([("10001", "TX", 1.0, 2.0, "A", "P"), ("10002", "TX", 3.0, 4.0, "B", "Q"), ("10003", None, 5.0, 6.0, "C", "R")],
                                      "zip string, state string, latitude double, longitude double, geocoded_city string, geocoded_place string")
    assert {r.serial_no: r.latitude for r in E.geo_lookup(addresses, gazetteer).collect()} == {"1": 1.0, "2": None, "3": 5.0}
    earlier = spark.createDataFrame([("TX", "10001", 9.0, 9.0, None, None)], "state string, zip string, latitude double, longitude double, geocoded_city string, geocoded_place string")
    reused = {r.serial_no: (r.latitude, r.geocoded_city) for r in E.geo_cache_reuse(addresses, earlier, gazetteer).collect()}
    assert reused["1"] == (9.0, None) and reused["3"] == (5.0, "C")


def test_landing_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿Serial No,Company Name,Company Site URL\n1, Acme ,https://a.com\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("Serial No,Company Name,Company Site URL\n2,Bold,https://b.com\n")
    (tmp_path / "c.txt").write_text("ignored")
    table = I.ingest_landing(spark, str(tmp_path))
    assert rows(table.select("serial_no", "company_name")) == [("1", " Acme "), ("2", "Bold")]
    assert {r._source_file.rsplit("/", 1)[1] for r in table.collect()} == {"a.csv", "b.csv"}


def test_swapped_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Serial No,Company Name,Company Site URL\n1,Acme,https://a.com\n")
    (tmp_path / "b.csv").write_text("Company Name,Serial No,Company Site URL\nBold,2,https://b.com\n")
    with pytest.raises(Exception):
        I.ingest_landing(spark, str(tmp_path)).collect()


def test_missing_column_and_empty_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Serial No,Company Name\n1,Acme\n")
    with pytest.raises(ValueError, match="Company Site URL"):
        I.ingest_landing(spark, str(tmp_path))
    with pytest.raises(ValueError):
        I.guard_nonempty(spark.range(0))
    with pytest.raises(RuntimeError):
        I.guard_any_success(spark.createDataFrame([(0,)], "pages_ok int"))


def test_overwrite_and_snapshot(spark):
    assert I.overwrite_table(spark.range(5), "gauge_t") == 5
    assert I.overwrite_table(spark.range(3).withColumn("b", F.lit(1)), "gauge_t") == 3
    assert spark.table("gauge_t").columns == ["id", "b"]
    assert I.read_previous_snapshot(spark, "gauge_t", "id bigint, b int", "b").count() == 3
    assert I.read_previous_snapshot(spark, "gauge_t", "id bigint, b int", "absent").count() == 0
    assert I.read_previous_snapshot(spark, "gauge_none", "id bigint", "id").count() == 0
