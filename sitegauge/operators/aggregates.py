"""Counts, exact medians, shares and dense grids."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.functions.prefilter import matches
from sitegauge.operators.joins import lookup_join


def page_counts(log: DataFrame, site: str, ok: Column | None = None) -> DataFrame:
    """Attempted, read and failed pages per site."""
    good = (F.col("fetch_status") == "ok") if ok is None else ok
    return log.groupBy(site).agg(
        F.count("*").alias("pages_attempted"),
        F.count_if(good).alias("pages_ok"),
        F.count_if(~F.coalesce(good, F.lit(False))).alias("pages_failed"))


def median_words(log: DataFrame, site: str, words: str = "word_count", ok: Column | None = None) -> DataFrame:
    """Exact median of the word counts of the pages that were read, cut to an integer.

    Equal counts are added up first, so the median of a hot site is taken over its distinct word
    counts with their frequencies."""
    readable = log.where((F.col("fetch_status") == "ok") if ok is None else ok)
    frequencies = readable.groupBy(site, words).agg(F.count("*").alias("_n"))
    return frequencies.groupBy(site).agg(
        F.percentile(words, 0.5, F.col("_n")).cast("int").alias("median_word_count"))


def site_duration(log: DataFrame, site: str, ts: str = "scraped_at") -> DataFrame:
    """First and last time per site and the seconds between them, one decimal."""
    def micros(c):
        return F.unix_micros(c.cast("timestamp_ltz"))

    spans = log.groupBy(site).agg(F.min(ts).alias("started_at"), F.max(ts).alias("finished_at"))
    seconds = (micros(F.col("finished_at")) - micros(F.col("started_at"))) / F.lit(1e6)
    return spans.withColumn("duration_seconds", F.round(seconds, 1))


def product_page_counts(products: DataFrame, site: str = "serial_no", url: str = "url") -> DataFrame:
    return products.groupBy(site).agg(F.count_distinct(url).alias("product_pages"))


def share_of_partition(df: DataFrame, value: str, group: str, out: str, spread=(), how=None) -> DataFrame:
    """value / total of its group.

    The totals come from an aggregation, which combines before the shuffle, and go back over a
    salted join: no task has to hold a whole group, as it would with a window."""
    key = F.struct(group).alias("_group")  # structs of nulls are equal: rows without a group are one
    totals = df.groupBy(group).agg(F.sum(value).alias("_total")).select(key, "_total")
    return (lookup_join(df.select("*", key), totals, "_group", how or "inner", spread=spread)
            .withColumn(out, F.try_divide(F.col(value), F.col("_total"))).drop("_total", "_group"))


def dense_grid(df: DataFrame, cells: list) -> DataFrame:
    """Each row once per cell.  The cells are a fixed short list of structs, so they are a literal
    that is exploded; there is no join."""
    return df.withColumn("_cell", F.explode(F.array(*cells))).select("*", "_cell.*").drop("_cell")


def literal_cells(names: tuple, rows: list) -> list:
    return [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]


def theme_flags(text: str, themes: dict) -> list:
    """One 0/1 column per theme, t0, t1, ...

    A text is brought to lower case once and searched for the words that the themes need; only a
    theme whose words are there runs its pattern."""
    return [matches(text, rx).cast("int").alias(f"t{i}") for i, rx in enumerate(themes.values())]


def theme_counts(pages: DataFrame, themes: dict, site: str = "serial_no") -> DataFrame:
    """Pages with text per site and, for each theme, the pages that mention it, in one pass."""
    return pages.groupBy(site).agg(
        F.count("*").alias("text_pages"),
        *[F.sum(f"t{i}").alias(f"t{i}") for i in range(len(themes))])


def union_by_name(counts: DataFrame, themes: dict, site: str = "serial_no") -> DataFrame:
    """One row per site and theme out of the wide counts: an unpivot of one scan."""
    return counts.unpivot([site], [f"t{i}" for i in range(len(themes))], "_t", "pages_mentioning").select(
        site, F.substr("_t", F.lit(2)).cast("int").alias("theme_id"), "pages_mentioning")


def news_counts(urls: DataFrame, years: list, site: str = "serial_no", path: str = "relative_path",
                url: str = "url") -> DataFrame:
    """Distinct news addresses per site and year, for the years asked for."""
    from sitegauge.functions.text import year_from_path

    dated = urls.where(F.col("page_type") == "news").withColumn("year", year_from_path(path))
    return (dated.where(in_list_filter("year", years))
            .groupBy(site, "year").agg(F.count_distinct(url).alias("news_pages")))


def in_list_filter(c: str, values: list) -> Column:
    return F.col(c).isin(list(values))


def news_years(as_of_year: int, span: int = presets.NEWS_YEAR_SPAN) -> list:
    return list(range(as_of_year - span + 1, as_of_year + 1))


def uncategorized_report(products: DataFrame, site: str = "serial_no", path: str = "relative_path",
                         n: int | None = None) -> DataFrame:
    """First two path parts of the product pages without a category, most frequent first; with `n`, the first n."""
    head = F.regexp_extract(path, r"^([^/]+(/[^/]+)?)", 1).alias("path")
    report = (products.where(F.col("category").isNull()).groupBy(site, head)
              .agg(F.count("*").alias("pages")).orderBy(F.desc("pages"), site, "path"))
    return report if n is None else report.limit(n)


def uncategorized_totals(products: DataFrame) -> DataFrame:
    return products.agg(F.count_if(F.col("category").isNull()).alias("unmapped_pages"),
                        F.count("*").alias("product_pages"))
