"""Address inventory, link discovery, visit order and crawl outcome, over tables."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.functions import rules as R
from sitegauge.functions import urls as U
from sitegauge.operators import aggregates, streaks
from sitegauge.operators.joins import lookup_join
from sitegauge.operators.ranking import first_per_group, per_group_top_k

SITE_SETTINGS = ["base_url", "start_url", "exclude", "product_pattern", "category_segment"]


def classify(rows: DataFrame, path: str = "relative_path") -> DataFrame:
    """Add page_type, section, category and depth from the path and the site's settings."""
    return (rows.withColumn("_segments", U.path_segments(path))
            .withColumn("page_type", R.page_type(path, F.col("product_pattern")))
            .withColumn("section", U.path_section("_segments"))
            .withColumn("category", U.path_category("_segments", "page_type", F.col("category_segment")))
            .withColumn("depth", U.path_depth("_segments"))
            .drop("_segments"))


def in_scope(candidates: DataFrame, sites: DataFrame, site: str = "serial_no") -> DataFrame:
    """Candidates below the base address of their site that its exclude rule does not hit, with
    their clean address, key and path and the site's settings."""
    settings = sites.select(site, *SITE_SETTINGS)
    keyed = candidates.withColumn("url", U.clean_url("url")).withColumn("url_key", U.key_of_clean_url("url"))
    return (lookup_join(keyed, settings, site, "inner", spread=["url_key"])
            .withColumn("relative_path", U.relative_path_of_key("url_key", "base_url"))
            .where(F.col("relative_path").isNotNull())
            .where(U.exclude_paths("relative_path", F.col("exclude"))))


def url_inventory(candidates: DataFrame, sites: DataFrame, site: str = "serial_no") -> DataFrame:
    """One classified row per site and address; the first source wins.

    candidates: (site, url, lastmod, source, priority, position).  The address a crawl starts from
    is the home page, whatever its path."""
    return _typed(_first_of_keys(in_scope(candidates, sites, site), site), site)


def _first_of_keys(scoped: DataFrame, site: str) -> DataFrame:
    """One row per site and key; the whole text of the address closes the order: two spellings can share one key."""
    return first_per_group(scoped, [site, "url_key"], ["priority", "position", "url"])


def _typed(unique: DataFrame, site: str) -> DataFrame:
    typed = classify(unique)
    home = F.col("url_key") == U.url_key("start_url")
    return typed.withColumn("page_type", F.when(home, F.lit("home")).otherwise(F.col("page_type"))).select(
        site, "url", "url_key", "relative_path", "page_type", "section", "category", "depth", "lastmod", "source")


def frontier_expand(links: DataFrame, known: DataFrame, sites: DataFrame, site: str = "serial_no") -> DataFrame:
    """One round of link discovery: addresses that pages link to, in scope and not known yet.

    Known addresses go by their key before anything is classified."""
    found = links.select(site, "url").distinct().select(
        site, "url", F.lit(None).cast("string").alias("lastmod"), F.lit("links").alias("source"),
        F.lit(0).alias("priority"), F.lit(0).alias("position"))
    new = in_scope(found, sites, site).join(known.select(site, "url_key").distinct(), [site, "url_key"], "left_anti")
    return _typed(_first_of_keys(new, site), site)


def discover_links(starts: DataFrame, links: DataFrame, sites: DataFrame, max_rounds: int | None = None,
                   site: str = "serial_no") -> DataFrame:
    """Addresses reached from the start addresses by following links, with the round that found them.

    starts: (site, url).  links: (site, page, url), `page` being the address of the page that holds
    the link.  Round 0 are the starts in scope; each further round takes the links of the pages that
    the last one found, and what is not known yet becomes the next.  The known set only grows: one
    narrow table per round in the shared folder, so a lost executor costs one round.  It ends when
    nothing new appears, or after `max_rounds`; circles of links need no care."""
    from sitegauge.sources.staging import staged

    first = starts.select(site, "url", F.lit(None).cast("string").alias("lastmod"), F.lit("start").alias("source"),
                          F.lit(0).alias("priority"), F.lit(0).alias("position"))
    edges = staged(links.select(site, U.url_key("page").alias("_page"), "url").distinct(), "links")
    found = staged(url_inventory(first, sites, site).withColumn("round", F.lit(0)), "found-links")
    known, number = found, 0
    while (max_rounds is None or number < max_rounds) and not found.isEmpty():
        number += 1
        pages = found.select(site, F.col("url_key").alias("_page"))
        next_ = frontier_expand(edges.join(pages, [site, "_page"], "left_semi"), known, sites, site)
        found = staged(next_.withColumn("round", F.lit(number)), "found-links")
        known = known.unionByName(found)
    return known


def contact_pages_first(inventory: DataFrame, site: str = "serial_no", k: int | None = None) -> DataFrame:
    """The pages of a site that most likely carry its address and phone number, in visit order; with `k`, the first k."""
    path = F.col("relative_path")
    likely = (inventory.where(~F.col("page_type").isin("home", "document"))
              .where(path.rlike(presets.CONTACT_PAGE_PATTERN) & ~path.rlike(presets.NOT_CONTACT_PATTERN))
              .withColumn("contact_order", F.when(path.rlike(presets.CONTACT_FIRST_PATTERN), 0).otherwise(1)))
    order = ["contact_order", "depth", "url"]
    if k is None:
        return likely.withColumn("contact_rank", F.row_number().over(Window.partitionBy(site).orderBy(*order)))
    return per_group_top_k(likely, [site], order, k, rank="contact_rank", spread=["url"])


def _type_priority():
    chosen = None
    for name, place in presets.PAGE_PRIORITY.items():
        chosen = (F if chosen is None else chosen).when(F.col("page_type") == name, F.lit(place))
    return chosen


def starts_and_rows(inventory: DataFrame, site: str = "serial_no") -> tuple[DataFrame, DataFrame]:
    """The start page of every site, and the other rows of the sites whose start page is open."""
    rows = inventory if "allowed" in inventory.columns else inventory.withColumn("allowed", F.lit(True))
    is_start = F.col("page_type") == "home"
    if "start_key" in rows.columns:
        is_start = F.when(F.col("start_key").isNotNull(), F.col("url_key") == F.col("start_key")).otherwise(is_start)
    starts = first_per_group(rows.where(is_start), [site], ["depth", "url"])
    rows = rows.select(site, "url", "url_key", "relative_path", "page_type", "depth", "allowed")
    rows = rows.join(starts.where(~F.col("allowed")).select(site), site, "left_anti")
    return starts, rows.join(starts.where("allowed").select(site, "url"), [site, "url"], "left_anti")


def candidates(rows: DataFrame, site: str = "serial_no", max_contacts: int | None = None) -> DataFrame:
    """Pages in the order in which a crawl comes to them, closed ones too: stage, place, depth, url.

    Contact pages are stage 0; what is also queued by its type keeps its first place."""
    contacts = contact_pages_first(rows, site, max_contacts).select(
        site, "url", "url_key", "page_type", "allowed", F.lit(0).alias("stage"), F.col("contact_rank").alias("place"), "depth")
    typed = rows.withColumn("place", _type_priority()).where(F.col("place").isNotNull()).select(
        site, "url", "url_key", "page_type", "allowed", F.lit(1).alias("stage"), "place", "depth")
    return first_per_group(contacts.unionByName(typed), [site, "url_key"], ["stage", "place", "depth", "url"])


def crawl_plan(inventory: DataFrame, site: str = "serial_no", max_pages: int | None = None,
               max_products: int | None = None, max_contacts: int | None = None) -> DataFrame:
    """Pages to visit with their visit order; 0 is the start page.

    Contact pages come first, then the types by priority, each by depth and address.  Without
    limits the whole order is returned.  With a page budget only the first max_pages + max_contacts
    rows of a site and type can be chosen, so they are cut out before the shuffle.  An optional
    boolean column `allowed` keeps pages out that robots rules close; a site whose start page is
    closed is not visited.  The start page is the row whose url_key is the optional column
    start_key, else the home page with the least depth and address: one row per site."""
    starts, rows = starts_and_rows(inventory, site)
    start = starts.where("allowed").select(site, "url", "page_type", F.lit(0).alias("visit_order"))
    contacts = contact_pages_first(rows, site, max_contacts).where("allowed").select(
        site, "url", "page_type", F.lit(0).alias("_stage"), F.col("contact_rank").alias("_place"), "depth")
    typed = rows.where("allowed").withColumn("_place", _type_priority()).where(F.col("_place").isNotNull())
    if max_pages is not None and max_contacts is not None:
        typed = per_group_top_k(typed, [site, "_place"], ["depth", "url"], max_pages + max_contacts, rank="_n", spread=["url"])
    queued = typed.select(site, "url", "page_type", F.lit(1).alias("_stage"), "_place", "depth")
    order = ["_stage", "_place", "depth", "url"]
    chosen = first_per_group(contacts.unionByName(queued), [site, "url"], ["_stage"])
    if max_products is not None:
        running = Window.partitionBy(site).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        is_product = F.col("page_type") == "product"
        chosen = (chosen.withColumn("_products", F.sum(is_product.cast("int")).over(running))
                  .where(~is_product | (F.col("_products") <= max_products)))
    numbered = chosen.withColumn("visit_order", F.row_number().over(Window.partitionBy(site).orderBy(*order)))
    if max_pages is not None:
        numbered = numbered.where(F.col("visit_order") < max_pages)
    return start.unionByName(numbered.select(site, "url", "page_type", "visit_order"))


def robots_skipped(inventory: DataFrame, plan: DataFrame, site: str = "serial_no",
                   max_pages: int | None = None, max_products: int | None = None,
                   max_contacts: int | None = None) -> DataFrame:
    """Pages per site that robots rules closed before the crawl reached a cap.

    A closed contact page always counts: contact pages come before any cap.  A closed queued page
    counts when it comes before the last page taken, or when no cap was reached."""
    kept = inventory.select(site, "url", "page_type", "relative_path", "depth", "allowed")
    place = F.struct(_type_priority().alias("place"), F.col("depth"), F.col("url"))
    reached = (plan.where("visit_order > 0").join(kept.select(site, "url", "depth"), [site, "url"])
               .withColumn("_at", place).groupBy(site).agg(
        F.count("*").alias("_pages"), F.count_if(F.col("page_type") == "product").alias("_products"),
        F.max("_at").alias("_last"), F.max(F.when(F.col("page_type") == "product", F.col("_at"))).alias("_last_product")))
    contacts = contact_pages_first(kept, site, max_contacts).where(~F.col("allowed")).select(site, "url", F.lit(True).alias("_contact"))
    closed = kept.where(~F.col("allowed")).withColumn("_at", place).where(F.col("_at.place").isNotNull())
    seen = lookup_join(closed.join(contacts, [site, "url"], "left"), reached, site, "left", spread=["url"])
    open_end = open_product = F.lit(True)
    if max_pages is not None:
        open_end = F.coalesce(F.col("_pages") < max_pages - 1, F.lit(True)) | (F.col("_at") < F.col("_last"))
    if max_products is not None:
        open_product = ((F.col("page_type") != "product") | F.coalesce(F.col("_products") < max_products, F.lit(True))
                        | (F.col("_at") < F.col("_last_product")))
    return (seen.where(F.coalesce("_contact", F.lit(False)) | (open_end & open_product))
            .groupBy(site).agg(F.count("*").alias("robots_skipped")))


def site_status(facts: DataFrame) -> DataFrame:
    """Outcome of a crawl from its counts: adds status and message.

    facts columns: robots_denied, start_url, robots_http_status, start_status, start_http_status,
    start_error, stopped, pages_attempted, pages_ok, pages_failed, median_words, notes."""
    code = F.coalesce(F.col("start_http_status").cast("string"), F.lit("None"))
    robots_code = F.coalesce(F.col("robots_http_status").cast("string"), F.lit("None"))
    refused = F.col("start_status").isin("blocked", "captcha")
    stopped = F.coalesce("stopped", F.lit(False))
    none_read = F.coalesce("pages_ok", F.lit(0)) == 0
    thin = F.col("median_words") < presets.JS_RENDERED_MEDIAN_WORDS
    failing = F.col("pages_failed") > presets.MAX_FAILED_SHARE * F.col("pages_attempted")

    def noted(first):
        return F.array_join(F.concat(F.array(F.lit(first)), F.coalesce("notes", F.array().cast("array<string>"))), "; ")

    status = (F.when(F.col("robots_denied"), "blocked").when(refused, F.col("start_status"))
              .when(stopped, "partial").when(none_read, "error").when(thin, "js_rendered")
              .when(failing, "partial").otherwise("ok"))
    reason = F.coalesce("start_error", F.concat(F.coalesce("start_status", F.lit("error")), F.lit(" (HTTP "), code, F.lit(")")))
    message = (
        F.when(F.col("robots_denied"), F.concat(F.lit("robots.txt (HTTP "), robots_code, F.lit(") does not allow "), F.col("start_url")))
        .when(refused, F.concat(F.lit("start page returned "), F.col("start_status"), F.lit(" (HTTP "), code, F.lit(")")))
        .when(stopped, F.lit(f"stopped after {presets.MAX_CONSECUTIVE_FAILURES} failed pages in a row"))
        .when(none_read, F.concat(F.lit("no page could be scraped; start page: "), reason))
        .when(thin, noted("pages have little text; content is likely loaded by JavaScript"))
        .when(failing, noted("more than 20% of pages failed"))
        .otherwise(F.nullif(F.array_join(F.coalesce("notes", F.array().cast("array<string>")), "; "), F.lit(""))))
    return facts.withColumn("status", status).withColumn("message", message)


def scrape_status(sites: DataFrame, log: DataFrame, inventory: DataFrame | None = None,
                  policy: DataFrame | None = None, sitemaps: DataFrame | None = None,
                  skipped: DataFrame | None = None, chunk=None, site: str = "serial_no") -> DataFrame:
    """One row per site that says how its crawl went.

    sites: site, company_name, host, base_url, start_url.  log: site, url, page_type, visit_order,
    fetch_status, http_status, word_count, error, scraped_at; visit_order 0 is the start page."""
    from sitegauge.sources.robots import allowed

    piece = F.floor(F.col("visit_order") / 1000) if chunk is None else chunk
    counts = aggregates.page_counts(log, site)
    words = log.where(F.col("fetch_status") == "ok").groupBy(site, "word_count").agg(F.count("*").alias("_n"))
    median = words.groupBy(site).agg(F.percentile("word_count", 0.5, F.col("_n")).alias("median_words"))
    start = log.where("visit_order = 0").groupBy(site).agg(
        F.min(F.struct("url", "fetch_status", "http_status", "error")).alias("_start")).select(
        site, F.col("_start.fetch_status").alias("start_status"), F.col("_start.http_status").alias("start_http_status"),
        F.col("_start.error").alias("start_error"))
    followed = log.where("visit_order > 0")
    stops = streaks.failure_streak(followed, site, ["visit_order"], piece).select(site, "stopped")
    empty = streaks.empty_type_streak(followed, site, ["visit_order"], piece).where("skipped")
    note = F.format_string(f"skipped remaining %s pages after {presets.EMPTY_PAGES_BEFORE_SKIP} empty ones", "page_type")
    # in the order in which the types ran empty
    notes = empty.groupBy(site).agg(F.array_sort(F.collect_list(F.struct("reached_at", note.alias("note")))).alias("_notes"))
    notes = notes.select(site, F.transform("_notes", lambda n: n["note"]).alias("notes"))
    spans = aggregates.site_duration(log, site)
    facts = sites
    for part in (counts, median, start, stops, notes, spans):
        facts = facts.join(part, site, "left")
    if inventory is not None:
        facts = facts.join(inventory.groupBy(site).agg(F.count("*").alias("urls_found")), site, "left")
    if sitemaps is not None:
        facts = facts.join(sitemaps, site, "left")
    if skipped is not None:
        facts = facts.join(skipped, site, "left")
    if policy is not None:
        facts = facts.join(policy.select(F.lower("host").alias("_robots_host"), "robots_http_status", "verdict", "rules"),
                           F.lower(F.regexp_extract("base_url", r"//([^/]*)", 1)) == F.col("_robots_host"), "left")
        facts = facts.withColumn("robots_denied", ~allowed("start_url", "verdict", "rules"))
    for name in ("urls_found", "sitemap_files_read", "sitemap_errors", "robots_skipped"):
        if name not in facts.columns:
            facts = facts.withColumn(name, F.lit(0))
    if "robots_denied" not in facts.columns:
        facts = facts.withColumn("robots_denied", F.lit(False)).withColumn("robots_http_status", F.lit(None).cast("int"))
    numbers = ["sitemap_files_read", "sitemap_errors", "urls_found", "pages_attempted", "pages_ok", "pages_failed", "robots_skipped"]
    return site_status(facts).select(
        site, "company_name", "base_url", "status", "message", "robots_http_status",
        *[F.coalesce(n, F.lit(0)).cast("int").alias(n) for n in numbers],
        F.col("median_words").cast("int").alias("median_word_count"), "started_at", "finished_at", "duration_seconds")
