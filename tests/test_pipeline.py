"""One run from fetched pages to dashboard tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sitegauge.functions.rules import rules_table
from sitegauge.operators.joins import lookup_join
from sitegauge.plans import pipeline, serving, silver
from sitegauge.sources import tables


def page(title, body, links=""):
    return f"<html><head><title>{title}</title></head><body><main><h1>{title}</h1><p>{body}</p>{links}</main></body></html>"


def test_whole_run(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS gauge_run")
    companies = spark.createDataFrame([("1", "The Acme Company", "https://www.acme.com/"), ("2", "Bold Inc", "https://bold.com/")],
                                      "serial_no string, company_name string, company_site_url string")
    rules = rules_table(spark, {"acme.com": {"product_pattern": "^machines(/|$)", "category_segment": 1}})
    listed = ["machines/excavators/e1", "machines/excavators/e2", "machines/electric-mowers/m1", "machines/offers", "news/2025/a", "contact", "secret/x"]
    xml = "<urlset>" + "".join(f"<url><loc>https://www.acme.com/{p}</loc></url>" for p in listed) + "</urlset>"
    sitemap_files = spark.createDataFrame([("1", 0, xml, None), ("2", 0, None, "404")], "serial_no string, file_order int, text string, error string")
    robots_files = spark.createDataFrame([("www.acme.com", 200, "User-agent: *\nDisallow: /secret/"), ("bold.com", 404, "")],
                                         "host string, http_status int, text string")
    when = dt.datetime(2026, 1, 1)
    fill = "We were founded in 1950. " + "gps word " * 30
    rows = [("1", "https://www.acme.com/", 200, page("Acme", fill), 0),
            ("1", "https://www.acme.com/contact", 200, page("Contact", "Headquarters: Racine, WI 53403 Tel 262-555-1234 " + "word " * 60), 1)]
    rows += [("1", f"https://www.acme.com/{p}", 200, page(f"{p} | Acme", f"{p} gps " + "word " * 60), i + 2) for i, p in enumerate(listed[:5])]
    rows += [("1", f"https://www.acme.com/other/{i}", 200, page(f"t{i}", f"n{i} gps " + "word " * 60), i + 10) for i in range(15)]
    rows += [("2", "https://bold.com/", 200, page("Bold", "x " * 60, "<a href='/tractors/t1'>t</a><a href='https://else.com/'>e</a>"), 0),
             ("2", "https://bold.com/tractors/t1", 503, None, 1)]
    fetched = spark.createDataFrame([(s, u, u, c, "text/html", h, None, v, when) for s, u, c, h, v in rows],
                                    "serial_no string, url string, final_url string, http_status int, content_type string, html string, error string, visit_order int, scraped_at timestamp")
    gazetteer = spark.createDataFrame([("53403", "WI", 42.7, -87.8, "Racine", "Racine, WI")],
                                      "zip string, state string, latitude double, longitude double, geocoded_city string, geocoded_place string")

    pipeline.build_silver(spark, "gauge_run", companies, rules, sitemap_files, robots_files, fetched, "gaugebot")
    status = {r.serial_no: r for r in spark.table("gauge_run.scrape_status").collect()}
    assert status["1"].status == "ok" and status["1"].robots_skipped == 1 and status["1"].sitemap_files_read == 1
    assert status["2"].status == "partial" and status["2"].sitemap_errors == 1 and status["2"].urls_found == 2
    urls = {r.relative_path: r for r in spark.table("gauge_run.site_urls").where("serial_no = '1'").collect()}
    assert urls["machines/excavators/e1"].category == "excavators" and urls[""].page_type == "home"
    for _ in range(2):  # the second run reads its own last result
        pipeline.build_contacts(spark, "gauge_run", companies, gazetteer, 2026)
    contact = spark.table("gauge_run.company_contacts").where("serial_no = '1'").first()
    assert (contact.hq_address, contact.phone, contact.phone_match, contact.founded_year) == ("Racine, WI 53403", "262-555-1234", "next to address", 1950)
    counts = pipeline.build_gold(spark, "gauge_run", companies, 2026)
    assert counts == {"dim_company": 2, "company_categories": 3, "electric_products": 1, "tech_mentions": 14, "news_by_year": 5, "unmapped_pages": 0}
    categories = serving.ds_categories(spark.table("gauge_run.company_categories")).where(F.col("brand") == "Acme")
    assert {r.category: round(r.share_of_company, 3) for r in categories.collect()} == {"Excavators": 0.667, "Mowers & Turf": 0.333}
    gps = spark.table("gauge_run.tech_mentions").where("serial_no = 1 AND theme = 'GPS & Precision'").first()
    assert gps.has_data and gps.pages_mentioning == gps.text_pages - 1


FETCHED = "serial_no string, url string, final_url string, http_status int, content_type string, html string, error string, scraped_at timestamp"


def _fetched(spark, rows):
    return spark.createDataFrame([(s, u, u, c, "text/html", h, None, dt.datetime(2026, 1, 1, 0, 0, i)) for i, (s, u, c, h) in enumerate(rows)], FETCHED)


def test_landing_folder_to_replayed_crawl(spark, tmp_path):
    """Companies from a folder, sitemaps by address with an index, a site without any, and no visit order."""
    spark.sql("CREATE DATABASE IF NOT EXISTS gauge_replay")
    (tmp_path / "a.csv").write_text("Serial No,Company Name,Company Site URL\n1,Acme,https://acme.com/\n2,Bold,https://bold.com/\n3,Cold,https://cold.com/\n")
    assert pipeline.build_bronze(spark, "gauge_replay", str(tmp_path)) == 3
    (tmp_path / "a.csv").write_text("Serial No,Company Name,Company Site URL\n")
    with pytest.raises(ValueError):
        pipeline.build_bronze(spark, "gauge_replay", str(tmp_path))
    companies = spark.table("gauge_replay.companies")
    assert companies.count() == 3

    thin = [f"products/t{k:02d}" for k in range(14)]
    xml = "<urlset>" + "".join(f"<url><loc>https://acme.com/{p}</loc></url>" for p in [*thin, "about-us", "secret/x"]) + "</urlset>"
    files = spark.createDataFrame([("https://acme.com/root", "<sitemapindex><loc>https://acme.com/m</loc><loc>https://acme.com/root</loc></sitemapindex>", None),
                                   ("https://acme.com/m", xml, None), ("https://bold.com/sitemap.xml", None, "404")], "file_url string, text string, error string")
    robots = spark.createDataFrame([("acme.com", 200, "User-agent: *\nDisallow: /secret/\nSitemap: https://acme.com/root"), ("bold.com", 404, ""), ("cold.com", 403, "")],
                                   "host string, http_status int, text string")
    text = "word " * 60
    rows = [("1", "https://acme.com/", 200, page("Acme", text)), ("1", "https://acme.com/about-us", 200, page("About", text)), ("1", "https://acme.com/secret/x", 200, page("No", text))]
    rows += [("1", f"https://acme.com/{p}", 200, page("t", "few")) for p in thin]
    rows += [("2", "https://bold.com/", 200, page("Bold", text, "<a href='/a'>a</a>")), ("2", "https://bold.com/a", 200, page("A", text, "<a href='/b'>b</a>")),
             ("2", "https://bold.com/b", 200, page("B", text)), ("2", "https://bold.com/island", 200, page("I", text))]
    rules = rules_table(spark, {})
    pipeline.build_silver(spark, "gauge_replay", companies, rules, files, robots, _fetched(spark, rows), "gaugebot")
    status = {r.serial_no: r for r in spark.table("gauge_replay.scrape_status").collect()}
    assert (status["1"].sitemap_files_read, status["1"].robots_skipped, status["1"].pages_attempted) == (2, 1, 12)
    assert status["1"].message == "pages have little text; content is likely loaded by JavaScript; skipped remaining product pages after 10 empty ones"
    assert (status["2"].sitemap_errors, status["2"].urls_found, status["2"].pages_ok) == (1, 3, 3)
    assert status["3"].status == "blocked" and status["3"].pages_attempted == 0
    pages = spark.table("gauge_replay.site_pages")
    assert pages.columns == pipeline.PAGE_COLUMNS and pages.count() == 15
    assert {r.url for r in pages.where("serial_no = '2'").collect()} == {"https://bold.com/", "https://bold.com/a", "https://bold.com/b"}
    gazetteer = spark.createDataFrame([], "zip string, state string, latitude double, longitude double, geocoded_city string, geocoded_place string")
    pipeline.build_contacts(spark, "gauge_replay", companies, gazetteer, 2026)
    assert pipeline.build_gold(spark, "gauge_replay", companies, 2026)["unmapped_pages"] == 14
    assert [tuple(r) for r in spark.table("gauge_replay.unmapped_pages").orderBy("path").limit(2).collect()] == [(1, "products/t00", 1), (1, "products/t01", 1)]
    # a run without any page leaves the tables as they are
    with pytest.raises(RuntimeError):
        pipeline.build_silver(spark, "gauge_replay", companies, rules, files, robots, _fetched(spark, [(s, u, 503, None) for s, u, _, _ in rows]), "gaugebot")
    assert spark.table("gauge_replay.site_pages").count() == 15 and spark.table("gauge_replay.scrape_status").where("pages_ok > 0").count() == 0
    # budgets
    pipeline.build_silver(spark, "gauge_replay", companies, rules, files, robots, _fetched(spark, rows), "gaugebot", max_pages=5, max_products=2, max_rounds=1)
    status = {r.serial_no: r for r in spark.table("gauge_replay.scrape_status").collect()}
    assert (status["1"].pages_attempted, status["2"].urls_found) == (4, 2)


def test_no_page_text_is_shuffled(spark):
    fetched = _fetched(spark, [("1", "https://acme.com/", 200, page("Acme", "x"))])
    settings = spark.createDataFrame([("1", "Acme", "https://acme.com/", "https://acme.com/", None, None, 1)],
                                     "serial_no string, company_name string, base_url string, start_url string, exclude string, product_pattern string, category_segment int")
    spark.sql("CREATE DATABASE IF NOT EXISTS gauge_plan")
    tables.overwrite_table(settings, "gauge_plan.settings")
    settings = spark.table("gauge_plan.settings")
    pages = silver.with_page_type(silver.extract_pages(lookup_join(fetched, settings, "serial_no", "inner", spread=["url"])))
    plan = pages._jdf.queryExecution().executedPlan().toString()
    for line in plan.split("\n"):
        assert "Exchange hashpartitioning" not in line and "Exchange RoundRobin" not in line, line
    row = pages.first()
    assert (row.page_type, row.body_text) == ("home", "Acme x")


def test_failed_write_keeps_the_last_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS gauge_versions")
    name = "gauge_versions.t"
    spark.range(4).write.mode("overwrite").saveAsTable(name)  # a plain table of earlier days
    assert tables.overwrite_table(spark.range(6), name) == 6
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|division"):
        tables.overwrite_table(spark.range(0, 100, 1, 4).select((F.lit(1) / (F.col("id") - 77)).alias("id")), name)
    assert spark.table(name).count() == 6
    with pytest.raises(ValueError):
        tables.overwrite_table(spark.range(0), name, nonempty=True)
    assert spark.table(name).count() == 6
    assert tables.overwrite_table(spark.table(name).where("id > 2"), name) == 3  # made from itself
    assert tables.overwrite_table(spark.table(name).withColumn("b", F.lit(1)), name) == 3
    assert spark.table(name).columns == ["id", "b"] and len(tables.versions_of(spark, name)) == 2
    assert tables.written_rows(spark, name).first().written == 3
