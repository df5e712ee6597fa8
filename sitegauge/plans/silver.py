"""Fetched pages to the page table, and the page table to one contact row per company."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.functions import contacts as C
from sitegauge.functions import html as H
from sitegauge.functions import text as X
from sitegauge.functions import urls as U
from sitegauge.operators import crawl, evidence
from sitegauge.operators.joins import lookup_join


def internal_link_count(links, base):
    """Links below the base address; repeated links count each time."""
    return F.size(F.filter(X.as_col(links), lambda l: U.relative_path(l, base).isNotNull()))


def page_links(html, page_url):
    return F.transform(H.html_hrefs(html), lambda h: U.resolve_url(page_url, h))


def extract_pages(fetched: DataFrame) -> DataFrame:
    """All fields of every fetched page, row by row; nothing is shuffled.

    fetched: site columns, url, final_url, http_status, content_type, html, error, base_url."""
    readable = F.col("http_status").isNotNull() & (F.col("http_status") < 400) & F.coalesce(
        F.lower("content_type"), F.lit("")).contains("html")
    no_strings = F.array().cast("array<string>")
    page_url = F.coalesce("final_url", "url")
    # Each step is used by several of the next, so every cleaning pass over the HTML runs once.
    fields = (
        fetched.withColumn("_page", H.without_comments(F.when(readable, F.col("html")))).drop("html")
        .withColumn("_markup", H.without_blocks("_page", H.CODE_TAGS))
        .withColumn("_parts", H.page_parts("_markup"))
        .withColumns({
            "title": H.title_of("_markup"),
            "_blocks": F.coalesce(H.json_ld_blocks("_page"), no_strings),
            "_links": F.coalesce(F.transform(H.hrefs_of("_markup"), lambda h: U.resolve_url(page_url, h)), no_strings),
            "_visible": H.part_text("_parts.visible"),
            "_text": H.part_text("_parts.main")})
        .withColumn("_words", X.word_count("_text"))
    )
    return fields.select(
        *[c for c in fetched.columns if c not in ("html", "content_type")],
        H.fetch_status("http_status", "content_type", F.coalesce(H.captcha_flag("title", "_text", "_words"), F.lit(False))).alias("fetch_status"),
        "title", H.meta_description_of("_markup").alias("meta_description"), H.h1_of("_markup").alias("h1"),
        F.coalesce(H.heading_texts("_parts.headings"), no_strings).alias("headings"),
        F.nullif("_text", F.lit("")).alias("body_text"),
        F.coalesce("_words", F.lit(0)).alias("word_count"),
        F.col("_blocks").alias("json_ld"),
        C.page_phones("_visible", "_links", "_blocks").alias("contact_phones"),
        C.page_addresses("_visible", "_blocks").alias("contact_addresses"),
        F.coalesce(internal_link_count("_links", F.col("base_url")), F.lit(0)).alias("internal_link_count"),
        F.col("_links").alias("links"),
    )


def with_page_type(pages: DataFrame) -> DataFrame:
    """Add url_key, page_type, section and category, from the address and the settings of its site, which go.

    The same as in the address inventory, but row by row: no page text is shuffled to fetch them.
    A page outside the site's scope is other; visit_order 0, where there is one, is the home page."""
    key = U.url_key("url")
    path = U.relative_path_of_key("url_key", "base_url")
    rows = pages.withColumn("url_key", key).withColumn("_path", path)
    rows = rows.withColumn("_path", F.when(U.exclude_paths("_path", F.col("exclude")), F.col("_path")))
    rows = crawl.classify(rows, "_path")
    home = F.col("url_key") == U.url_key("start_url")
    if "visit_order" in pages.columns:
        home = home | (F.col("visit_order") == 0)
    inside = F.col("_path").isNotNull()
    kind = F.when(home, F.lit("home")).when(inside, F.col("page_type")).otherwise(F.lit("other"))
    return rows.withColumns({
        "page_type": kind, "section": F.when(inside, F.col("section")), "category": F.when(inside, F.col("category"))}).drop(
        "_path", "depth", *crawl.SITE_SETTINGS)


def founded_year(pages: DataFrame, as_of_year: int, site: str = "serial_no") -> DataFrame:
    """Earliest founding year a site states about itself on its home and about pages."""
    home, told = F.col("page_type") == "home", F.col("page_type").isin("home", "about")
    none = F.array().cast("array<int>")
    headline = F.concat(C.founded_years("title", False), C.founded_years("meta_description", False))
    own = C.founded_years(F.concat_ws(" ", F.nullif(F.col("meta_description"), F.lit("")), "body_text"), True)
    years = F.concat(F.when(home, headline).otherwise(none), F.when(told, own).otherwise(none))
    return evidence.earliest_founding(pages.where(told), years, as_of_year, presets.MIN_FOUNDED_YEAR, site)


def best_address(pages: DataFrame, site: str = "serial_no") -> DataFrame:
    found = evidence.explode_contacts(pages, "contact_addresses", site)
    usable = found.where(F.col("value").rlike(presets.ADDRESS_VALUE_PATTERN))
    return evidence.pick_best_evidence(usable, C.score_address("context", "source", "url"), site)


def best_phone(pages: DataFrame, site: str = "serial_no") -> DataFrame:
    found = evidence.explode_contacts(pages, "contact_phones", site)
    return evidence.pick_best_evidence(found, C.score_phone("context", "source", "url"), site)


def assemble_contacts(companies: DataFrame, pages: DataFrame, gazetteer: DataFrame, previous: DataFrame,
                      as_of_year: int, site: str = "serial_no") -> DataFrame:
    """One contact row per company, also for companies on whose pages nothing was found."""
    address = best_address(pages, site).select(
        site, X.parse_address("value").alias("_a"), F.col("match").alias("address_match"),
        F.col("url").alias("address_source_url"), F.col("context").alias("address_context"),
        C.phone_next_to_address("context").alias("_next_phone"))
    address = address.select("*", F.col("_a.city").alias("_raw_city"), F.col("_a.state").alias("state"),
                             F.col("_a.zip").alias("zip")).drop("_a")
    located = evidence.geo_cache_reuse(address, previous, gazetteer, spread=[site])
    placed = located.withColumn("city", X.city_resolution("_raw_city", "geocoded_city"))
    phone = best_phone(pages, site).select(
        site, F.col("value").alias("_phone"), F.col("match").alias("_phone_match"),
        F.col("url").alias("_phone_url"), F.col("context").alias("_phone_context"))
    near = F.col("_next_phone").isNotNull()

    def either(a, b):
        return F.when(near, a if not isinstance(a, str) else F.col(a)).otherwise(F.col(b))

    not_found = F.lit(presets.NOT_FOUND_LABEL)
    joined = (companies.select(site, "company_name").join(placed, site, "left").join(phone, site, "left")
              .join(founded_year(pages, as_of_year, site), site, "left"))
    return joined.select(
        site, "company_name",
        F.concat("city", F.lit(", "), "state", F.lit(" "), "zip").alias("hq_address"), "city", "state", "zip",
        "latitude", "longitude", F.coalesce("address_match", not_found).alias("address_match"),
        "address_source_url", "address_context",
        either("_next_phone", "_phone").alias("phone"),
        F.coalesce(either(F.lit("next to address"), "_phone_match"), not_found).alias("phone_match"),
        either("address_source_url", "_phone_url").alias("phone_source_url"),
        either("address_context", "_phone_context").alias("phone_context"),
        "founded_year", "founded_source_url", "geocoded_place", "geocoded_city",
        F.current_timestamp().alias("updated_at"))
