"""The whole run: fetched material to silver tables, silver tables to gold tables.

Every stage reads tables and writes tables, so a later stage can be run again alone and a lost
executor costs no more than the stage it worked on.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.functions import rules as R
from sitegauge.functions import urls as U
from sitegauge.operators import aggregates, crawl, ranking, replay
from sitegauge.operators.joins import lookup_join
from sitegauge.operators.ranking import first_per_group
from sitegauge.plans import gold, silver
from sitegauge.sources import robots, sitemaps, tables

PAGE_COLUMNS = [
    "serial_no", "company_name", "url", "final_url", "page_type", "section", "category", "http_status", "fetch_status",
    "error", "title", "meta_description", "h1", "headings", "body_text", "word_count", "json_ld", "contact_phones",
    "contact_addresses", "internal_link_count", "scraped_at"]
LOCATION_SCHEMA = ("state string, zip string, latitude double, longitude double, "
                   "geocoded_city string, geocoded_place string")


def build_bronze(spark: SparkSession, database: str, folder: str, columns: dict = presets.LANDING_COLUMNS,
                 name: str = "companies") -> int:
    """Landing folder to the raw company table; a folder without rows leaves the last table in place."""
    return tables.overwrite_table(tables.ingest_landing(spark, folder, columns), f"{database}.{name}", nonempty=True)


def address_inventory(sites: DataFrame, sitemap_files: DataFrame, links: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """Addresses from sitemaps, the start pages, and, for sites whose sitemaps name no page below
    the base address, what is reached from the start page over the links of the pages.

    links: (serial_no, page, url), `page` being the page that holds the link."""
    listed = sitemaps.sitemap_entries(sitemap_files, "serial_no").select(
        "serial_no", "url", "lastmod", F.lit("sitemap").alias("source"), F.struct("file_order", "position").alias("position"))
    no_position = F.lit(None).cast(listed.schema["position"].dataType).alias("position")
    no_date = F.lit(None).cast("string").alias("lastmod")
    starts = sites.select("serial_no", F.col("start_url").alias("url"), no_date, F.lit("start").alias("source"), no_position)
    mapped = crawl.in_scope(listed, sites).select("serial_no").distinct()
    unmapped = sites.join(mapped, "serial_no", "left_anti")
    reached = crawl.discover_links(
        unmapped.select("serial_no", F.col("start_url").alias("url")), links.join(unmapped.select("serial_no"), "serial_no", "left_semi"), sites, max_rounds)
    followed = reached.where("round > 0").select("serial_no", "url", no_date, F.lit("links").alias("source"), no_position)
    return crawl.url_inventory(ranking.url_set_union([listed, starts, followed]), sites)


def build_silver(spark: SparkSession, database: str, companies: DataFrame, site_rules: DataFrame,
                 sitemap_files: DataFrame, robots_files: DataFrame, fetched: DataFrame, agent: str,
                 max_pages: int | None = None, max_products: int | None = None, max_contacts: int | None = None,
                 max_rounds: int | None = None) -> None:
    """Write scrape_status, site_urls and site_pages.

    fetched: serial_no, url, final_url, http_status, content_type, html, error, scraped_at, and
    visit_order where the crawl has taken place.  Without it `fetched` is what reading an address
    gives, and the crawl is replayed: its stops and budgets decide which pages count as read.

    sitemap_files: (serial_no, file_order, text, error) as they were read, or (file_url, text, error)
    by address; then they are read from the site's first sitemaps on, index files included.

    The new page table is written once, beside the one in use.  The status table is replaced first;
    without a single page read the run stops there and the other tables stay as they are."""
    limits = {"max_pages": max_pages, "max_products": max_products, "max_contacts": max_contacts}

    def kept(df, name):
        """Written once, read by several steps; its size is known to the planner then."""
        tables.overwrite_table(df, f"{database}.{name}")
        return spark.table(f"{database}.{name}")

    sites = kept(R.site_rule_defaults(companies.select("serial_no", "company_name", "company_site_url"), site_rules), "site_settings")
    settings = sites.select("serial_no", "company_name", *crawl.SITE_SETTINGS)
    extracted = silver.with_page_type(silver.extract_pages(lookup_join(fetched, settings, "serial_no", "inner", spread=["url"])))
    page_version = tables.write_version(extracted, f"{database}.site_pages")
    pages = spark.table(page_version.table)

    policy = kept(robots.robots_policy(robots_files, agent), "robots_policy")
    if "serial_no" not in sitemap_files.columns:
        roots = sitemaps.root_sitemaps(sites, policy)
        sitemap_files = sitemaps.expand_sitemaps(roots, sitemap_files, "serial_no")
    links = pages.select("serial_no", F.col("url").alias("page"), F.explode("links").alias("url"))
    found = address_inventory(sites, sitemap_files, links, max_rounds)
    hosted = found.withColumn("host", F.regexp_extract("url", r"//([^/]*)", 1))
    inventory = kept(robots.robots_allow(hosted, policy).drop("host"), "url_inventory")
    logged = ["serial_no", "url", "page_type", "visit_order", "fetch_status", "http_status", "word_count", "error", "scraped_at"]
    if "visit_order" in fetched.columns:
        log = kept(pages.select(*logged), "crawl_log")
        plan = kept(crawl.crawl_plan(inventory, **limits), "crawl_plan")
        skipped = crawl.robots_skipped(inventory, plan, **limits)
        read = None
    else:
        started = inventory.join(sites.select("serial_no", U.url_key("start_url").alias("start_key")), "serial_no")
        outcomes = first_per_group(pages.select("serial_no", "url_key", "url", *replay.OUTCOME), ["serial_no", "url_key"], ["url"])
        replayed = replay.replay(started, outcomes, **limits)
        times = pages.groupBy("serial_no", "url_key").agg(F.min("scraped_at").alias("scraped_at"))
        log = kept(replayed.visits.join(times, ["serial_no", "url_key"], "left").select(*logged), "crawl_log")
        skipped = replayed.sites.select("serial_no", "robots_skipped")
        read = log.select("serial_no", U.url_key("url").alias("url_key")).distinct()
    status = crawl.scrape_status(sites, log, inventory, policy, sitemaps.sitemap_stats(sitemap_files, "serial_no"), skipped)
    tables.overwrite_table(status, f"{database}.scrape_status")
    tables.guard_any_success(spark.table(f"{database}.scrape_status"))
    named = inventory.join(sites.select("serial_no", "company_name"), "serial_no")
    tables.overwrite_table(named.select(
        "serial_no", "company_name", "url", "relative_path", "page_type", "section", "category", "depth", "lastmod",
        "source", F.current_timestamp().alias("discovered_at")), f"{database}.site_urls")
    if read is not None:
        # pages that the replayed crawl did not come to go
        page_version = tables.write_version(lookup_join(pages, read, ["serial_no", "url_key"], "inner", spread=["url"]), f"{database}.site_pages")
    tables.switch_to(spark, page_version, PAGE_COLUMNS)


def build_contacts(spark: SparkSession, database: str, companies: DataFrame, gazetteer: DataFrame, as_of_year: int) -> None:
    """Write company_contacts; coordinates of the last run are kept where they are known."""
    name = f"{database}.company_contacts"
    previous = tables.read_previous_snapshot(spark, name, LOCATION_SCHEMA, "geocoded_city")
    contacts = silver.assemble_contacts(companies, spark.table(f"{database}.site_pages"), gazetteer, previous, as_of_year)
    tables.overwrite_table(contacts, name)


def build_gold(spark: SparkSession, database: str, companies: DataFrame, as_of_year: int,
               themes: dict = presets.TECH_THEMES, rules=tuple(presets.CATEGORY_RULES)) -> dict:
    """Write the dashboard tables; returns their row counts."""
    company = gold.company_normalize(companies)
    status, urls = spark.table(f"{database}.scrape_status"), spark.table(f"{database}.site_urls")
    # Three tables use the clean pages and two the products: narrow rows, written once.
    features = gold.page_features(spark.table(f"{database}.site_pages"), themes)
    tables.overwrite_table(gold.clean_pages(features, status), f"{database}.clean_pages")
    tables.overwrite_table(gold.product_urls(urls, rules), f"{database}.product_urls")
    pages, products = spark.table(f"{database}.clean_pages"), spark.table(f"{database}.product_urls")
    built = {
        "dim_company": gold.dim_company(company, spark.table(f"{database}.company_contacts"), status, pages, products),
        "company_categories": gold.company_categories(company, products, rules),
        "electric_products": gold.electric_products(company, pages, products, rules),
        "tech_mentions": gold.tech_mentions(company, pages, themes),
        "news_by_year": gold.news_by_year(company, urls, as_of_year),
        # product pages that no rule knows, by the first parts of their paths
        "unmapped_pages": aggregates.uncategorized_report(gold.with_category_names(products, rules)),
    }
    return {name: tables.overwrite_table(df, f"{database}.{name}") for name, df in built.items()}
