"""The crawl replayed: which pages are visited when what was read decides what is read next.

A crawl goes through the pages of a site in a given order.  It leaves a page type once enough pages
of it in a row came empty, takes so many product pages at most, stops after enough hard failures in a
row or when its page budget is spent, and counts the pages that robots rules close on its way.

Each of these is a small state that grows along the order, and one layer only looks at the rows
that the layers before it left: a type runs empty among its own open pages, whatever the other types
do; failures are counted over what is visited then; the end of the site cuts everything behind it.  So the
states are computed layer by layer, each by chunks whose states are composed, and one busy site is
worked on by many tasks.  A loop over the pages gives the same.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.operators import crawl, streaks
from sitegauge.operators.joins import lookup_join
from sitegauge.sources.staging import staged

OUTCOME = ["fetch_status", "http_status", "word_count", "error"]


@dataclass
class Replay:
    """visits: one row per page read.  sites: one row per site, how it ended."""

    visits: DataFrame
    sites: DataFrame


def in_chunks(df: DataFrame, order) -> DataFrame:
    """The rows with `seq`, a number that grows along `order`, and `chunk`, the part of the sorted table they are in.

    A sort over all tasks deals even a single site to several parts; the table is written, so both columns stay as they are."""
    return staged(df.orderBy(*order).withColumn("seq", F.monotonically_increasing_id()).withColumn("chunk", F.spark_partition_id()), "in-order")


def replay(inventory: DataFrame, outcomes: DataFrame, site: str = "serial_no", max_pages: int | None = None,
           max_products: int | None = None, max_contacts: int | None = None,
           max_failures: int = presets.MAX_CONSECUTIVE_FAILURES, max_empty: int = presets.EMPTY_PAGES_BEFORE_SKIP,
           min_words: int = presets.EMPTY_PAGE_WORDS) -> Replay:
    """Visits and the end of every site of `inventory` (as for crawl_plan).

    outcomes: (site, url_key, fetch_status, http_status, word_count, error), one row per address: what
    reading it gives.  A page without one counts as a page without an answer.  visit_order 0 is the start
    page; a site whose start page is closed has no visits, one whose start page is refused has no other."""
    starts, rows = crawl.starts_and_rows(inventory, site)
    answers = outcomes.select(site, "url_key", *OUTCOME)
    answer = lambda df: df.join(answers, [site, "url_key"], "left").withColumn(
        "fetch_status", F.coalesce("fetch_status", F.lit("error")))
    first = answer(starts.where("allowed").select(site, "url", "url_key", "page_type"))
    first = staged(first.withColumn("visit_order", F.lit(0)), "start-pages")
    refused = first.where(F.col("fetch_status").isin("blocked", "captcha")).select(site)

    ordered = crawl.candidates(rows.join(refused, site, "left_anti"), site, max_contacts)
    ordered = in_chunks(answer(ordered), [site, "stage", "place", "depth", "url"])
    seq, chunk = ["seq"], F.col("chunk")

    # products: the budget is spent by open pages, closed ones behind it are not even looked at
    product = F.col("page_type") == "product"
    if max_products is not None:
        taken = streaks.running_total(ordered, [site], seq, product & F.col("allowed"), chunk, "_taken")
        ordered = taken.where(~product | F.when(F.col("allowed"), F.col("_taken") <= max_products).otherwise(F.col("_taken") < max_products)).drop("_taken")
    # types that run empty, each among its own open pages
    empty = streaks.empty_type_streak(ordered.where("allowed"), site, seq, chunk, min_words=min_words, limit=max_empty)
    left = staged(empty.where("skipped").select(site, "page_type", F.col("reached_at.seq").alias("_left_at")), "left-types")
    ordered = lookup_join(ordered, left, [site, "page_type"], "left", spread=["url_key"])
    ordered = staged(ordered.where(F.col("_left_at").isNull() | (F.col("seq") <= F.col("_left_at"))).drop("_left_at"), "not-left")
    # hard failures in a row among what is left, then the page budget
    opened = ordered.where("allowed")
    failed = streaks.running_streak(opened, [site], seq, streaks.hard_failure(), chunk, "_failures")
    ends = failed.where(F.col("_failures") >= max_failures).groupBy(site).agg(F.min("seq").alias("_stopped_at"))
    ends = ordered.select(site).distinct().join(ends, site, "left")
    if max_pages is not None:
        pages = streaks.running_total(opened, [site], seq, F.lit(1), chunk, "_pages")
        spent = pages.where(F.col("_pages") >= max_pages - 1).groupBy(site).agg(F.min("seq").alias("_spent_at"))
        if max_pages <= 1:
            spent = ordered.groupBy(site).agg((F.min("seq") - 1).alias("_spent_at"))
        ends = ends.join(spent, site, "left")
    else:
        ends = ends.withColumn("_spent_at", F.lit(None).cast("bigint"))
    end = F.least("_stopped_at", "_spent_at")
    ends = staged(ends.select(site, (F.col("_stopped_at") <= F.coalesce("_spent_at", "_stopped_at")).alias("stopped"), end.alias("_end")), "ends")

    reached = lookup_join(ordered, ends, site, "left", spread=["url_key"]).where(F.col("_end").isNull() | (F.col("seq") <= F.col("_end")))
    visited = reached.where("allowed")
    numbered = streaks.running_total(visited, [site], seq, F.lit(1), chunk, "visit_order")
    columns = [site, "url", "url_key", "page_type", "visit_order", *OUTCOME]
    visits = first.select(*columns).unionByName(numbered.withColumn("visit_order", F.col("visit_order").cast("int")).select(*columns))

    closed = reached.where(~F.col("allowed")).groupBy(site).agg(F.count("*").alias("robots_skipped"))
    note = F.format_string(f"skipped remaining %s pages after {max_empty} empty ones", "page_type")
    told = left.join(ends, site).where(F.col("_end").isNull() | (F.col("_left_at") <= F.col("_end")))
    told = told.groupBy(site).agg(F.array_sort(F.collect_list(F.struct("_left_at", "page_type", note.alias("note")))).alias("_told"))
    none = F.array().cast("array<string>")
    sites = (starts.select(site, F.col("allowed").alias("open")).join(ends.drop("_end"), site, "left").join(closed, site, "left").join(told, site, "left")
             .select(site, "open", F.coalesce("stopped", F.lit(False)).alias("stopped"),
                     F.coalesce("robots_skipped", F.lit(0)).cast("bigint").alias("robots_skipped"),
                     F.coalesce(F.transform("_told", lambda t: t["page_type"]), none).alias("skipped_types"),
                     F.coalesce(F.transform("_told", lambda t: t["note"]), none).alias("notes")))
    return Replay(visits, sites)
