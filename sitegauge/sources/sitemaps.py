"""Sitemap texts to page addresses.

Input: (site, file_url, file_order, text, and a fetch error or null), one row per sitemap file.
`file_order` may be of any type that can be sorted.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.functions.html import unescape
from sitegauge.operators.joins import lookup_join
from sitegauge.functions.urls import ORIGIN
from sitegauge.operators.ranking import first_per_group, per_group_top_k
from sitegauge.sources.staging import staged


def fetched(files: DataFrame) -> DataFrame:
    """Files that were read: a file whose fetch failed has no addresses."""
    if "error" in files.columns:
        files = files.where(F.col("error").isNull())
    return files


def is_index(text="text"):
    return F.col(text).contains("<sitemapindex")


def is_url_list(text="text"):
    return ~is_index(text) & F.col(text).contains("<urlset")


def parse_sitemap_index(files: DataFrame, site: str = "site") -> DataFrame:
    """Child sitemaps that index files name."""
    locations = F.regexp_extract_all("text", F.lit(presets.SITEMAP_LOC_PATTERN), F.lit(1))
    return (fetched(files).where(is_index())
            .select(site, "file_order", F.posexplode(locations).alias("position", "raw"))
            .select(site, "file_order", "position", unescape("raw").alias("child_url")))


def read_sitemap_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of the sitemap files of a folder, one row per file; files that end in .gz are inflated by the reader."""
    return spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def root_sitemaps(sites: DataFrame, policy: DataFrame | None = None, site: str = "serial_no") -> DataFrame:
    """(site, file_url, position) of the sitemaps to begin with: those of the site's rule, else those
    its robots text names, else /sitemap.xml.

    sites: site, base_url, sitemaps (array or null).  policy: robots_policy()."""
    named = sites.select(site, "base_url", "sitemaps", F.lower(F.regexp_extract("base_url", r"//([^/]*)", 1)).alias("_host"))
    if policy is not None:
        lines = policy.select(F.lower("host").alias("_host"), F.col("sitemaps").alias("_lines"))
        named = named.join(lines, "_host", "left")
    else:
        named = named.withColumn("_lines", F.lit(None).cast("array<string>"))
    usual = F.array(F.concat(F.regexp_extract("base_url", ORIGIN, 0), F.lit("/sitemap.xml")))

    def filled(c):
        return F.when(F.size(c) > 0, F.col(c))

    chosen = F.coalesce(filled("sitemaps"), filled("_lines"), usual)
    return named.select(site, F.posexplode(chosen).alias("position", "raw")).select(site, unescape("raw").alias("file_url"), "position")


def expand_sitemaps(roots: DataFrame, files: DataFrame, site: str = "site", max_rounds: int | None = None) -> DataFrame:
    """The files a crawl comes to from the root files, index files followed to the end.

    roots: (site, file_url, position).  files: (file_url, text, error or null), what fetching an
    address gives.  Each round reads the files that the last one named for the first time; a
    repeated or circular mention is dropped by an anti-join with all files known so far, of which
    one narrow table per round is kept in the shared folder.  It ends when no new file appears, or
    after `max_rounds` rounds.  Returns (site, file_url, round, file_order, text, error): file_order sorts the
    files of a site as a queue would read them; a file that is not in `files` has an error."""
    path = F.array(F.col("position").cast("bigint"))
    named = roots.where(F.col("file_url").isNotNull()).select(site, "file_url", F.struct(F.lit(0).alias("round"), path.alias("path")).alias("file_order"))
    known, number = None, 0
    while True:
        if known is not None:
            named = named.join(known.select(site, "file_url"), [site, "file_url"], "left_anti")
        new = staged(first_per_group(named, [site, "file_url"], ["file_order"]), "sitemap-files")
        if new.isEmpty():
            break
        known = new if known is None else known.unionByName(new)
        number += 1
        if max_rounds is not None and number >= max_rounds:
            break
        read = _joined(new, files, site)
        children = parse_sitemap_index(read, site)
        order = F.struct(F.lit(number).alias("round"), F.concat("file_order.path", F.array(F.col("position").cast("bigint"))).alias("path"))
        named = children.select(site, F.col("child_url").alias("file_url"), order.alias("file_order"))
    if known is None:
        known = named.limit(0)
    return _joined(known, files, site).select(site, "file_url", F.col("file_order.round").alias("round"), "file_order", "text", "error")


def _joined(known: DataFrame, files: DataFrame, site: str) -> DataFrame:
    """Known addresses with what fetching them gives.  An address is many sites' only by chance, a site's files are many."""
    fetched_ = files.select("file_url", "text", F.col("error") if "error" in files.columns else F.lit(None).cast("string").alias("error"))
    return known.join(fetched_, "file_url", "left").withColumn(
        "error", F.when(F.col("text").isNull(), F.coalesce("error", F.lit("not fetched"))).otherwise(F.col("error")))


def _first_wins(entries: DataFrame, site: str) -> DataFrame:
    place = F.struct("file_order", "position", "lastmod")
    return (entries.groupBy(site, "url").agg(F.min(place).alias("_e"))
            .select(site, "url", F.col("_e.lastmod").alias("lastmod"),
                    F.col("_e.file_order").alias("file_order"), F.col("_e.position").alias("position")))


def parse_sitemap_entries(files: DataFrame, site: str = "site") -> DataFrame:
    """(url, lastmod) of XML sitemaps; the first mention of an address wins."""
    blocks = F.regexp_extract_all("text", F.lit(presets.SITEMAP_BLOCK_PATTERN), F.lit(1))
    rows = (fetched(files).where(is_url_list())
            .select(site, "file_order", F.posexplode(blocks).alias("position", "block"))
            .where(F.col("block").rlike(presets.SITEMAP_LOC_PATTERN)))
    lastmod = F.when(F.col("block").rlike(presets.SITEMAP_LASTMOD_PATTERN),
                     F.regexp_extract("block", presets.SITEMAP_LASTMOD_PATTERN, 1))
    return _first_wins(rows.select(
        site, "file_order", "position", lastmod.alias("lastmod"),
        unescape(F.regexp_extract("block", presets.SITEMAP_LOC_PATTERN, 1)).alias("url")), site)


def parse_sitemap_text(files: DataFrame, site: str = "site") -> DataFrame:
    """Addresses of plain-text sitemaps, one http line each."""
    lines = F.split("text", r"\r\n|[\n\r]")
    rows = (fetched(files).where(~is_index() & ~F.col("text").contains("<urlset"))
            .select(site, "file_order", F.posexplode(lines).alias("position", "line"))
            .select(site, "file_order", "position", F.btrim("line").alias("url"),
                    F.lit(None).cast("string").alias("lastmod"))
            .where(F.startswith("url", F.lit("http"))))
    return _first_wins(rows, site)


def sitemap_entries(files: DataFrame, site: str = "site") -> DataFrame:
    """Addresses of both kinds of sitemap; the first mention over all files wins."""
    found = parse_sitemap_entries(files, site).unionByName(parse_sitemap_text(files, site))
    return _first_wins(found, site)


def read_files(files: DataFrame, site: str = "site", limit: int | None = None) -> DataFrame:
    """The files a crawl takes: all readable ones of each site, or the first `limit`; a repeated address counts once."""
    once = files.where(F.col("error").isNull())
    if "file_url" in files.columns:
        once = first_per_group(once, [site, F.coalesce("file_url", F.col("file_order").cast("string"))], ["file_order"])
    return once if limit is None else per_group_top_k(once, [site], ["file_order"], limit, rank="read_rank", spread=["file_order"])


def sitemap_stats(files: DataFrame, site: str = "site", limit: int | None = None) -> DataFrame:
    """Files read and files that failed per site; with `limit`, those that failed before it was reached."""
    kept = [c for c in (site, "file_url", "file_order", "error") if c in files.columns]
    read = read_files(files.select(*kept), site, limit).groupBy(site).agg(
        F.count("*").alias("sitemap_files_read"), F.max("file_order").alias("_last"))
    failed = files.where(F.col("error").isNotNull()).groupBy(site, "file_order").agg(F.count("*").alias("_n"))
    if limit is not None:
        failed = lookup_join(failed, read, site, "left", spread=["file_order"]).where(
            F.coalesce(F.col("sitemap_files_read") < limit, F.lit(True)) | (F.col("file_order") < F.col("_last")))
    counted = failed.groupBy(site).agg(F.sum("_n").alias("sitemap_errors"))
    return (files.select(site).distinct().join(read, site, "left").join(counted, site, "left")
            .select(site, F.coalesce("sitemap_files_read", F.lit(0)).alias("sitemap_files_read"),
                    F.coalesce("sitemap_errors", F.lit(0)).alias("sitemap_errors")))
