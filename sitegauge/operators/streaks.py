"""Runs of consecutive flagged rows."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitegauge import presets


def running_streak(df: DataFrame, keys, order, flag: Column, chunk: Column, out: str = "streak") -> DataFrame:
    """Length of the run of flagged rows that ends at each row.

    A sequence is cut into chunks (any expression that does not decrease along `order`, such as an
    hour of the log), so a hot sequence is worked on by many tasks: runs are counted inside each
    chunk, one summary row per chunk carries the open run over the border, and the rows before the
    first break of a chunk add what was carried in."""
    keys = list(keys)
    columns = df.columns
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = (
        df.withColumn("_chunk", chunk)
        .withColumn("_flag", F.coalesce(flag, F.lit(False)))
        .withColumn("_pos", F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy(*order)))
        .withColumn("_break", F.max(F.when(~F.col("_flag"), F.col("_pos"))).over(inside))
        .withColumn("_local", F.col("_pos") - F.coalesce("_break", F.lit(0)))
    )
    tails = (
        rows.groupBy(*keys, "_chunk")
        .agg(F.max("_pos").alias("_rows"), F.max("_break").alias("_last"))
        .select(*keys, "_chunk", F.col("_last").isNotNull().alias("_broken"),
                (F.col("_rows") - F.coalesce("_last", F.lit(0))).alias("_tail"))
    )
    along = Window.partitionBy(*keys).orderBy("_chunk")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        tails.withColumn("_run", F.sum(F.col("_broken").cast("int")).over(
            along.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_open", F.sum("_tail").over(
            Window.partitionBy(*keys, "_run").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_carry", F.coalesce(F.last("_open").over(before), F.lit(0)))
        .select(F.struct(*keys, "_chunk").alias("_place"), "_carry")
    )
    # structs of nulls are equal: rows without a key or an order keep their run
    joined = rows.withColumn("_place", F.struct(*keys, "_chunk")).join(carried, "_place")
    total = F.col("_local") + F.when(F.col("_break").isNull(), F.col("_carry")).otherwise(F.lit(0))
    return (joined.withColumn(out, F.when(F.col("_flag"), total).otherwise(F.lit(0)).cast("bigint"))
            .select(*columns, out))


def running_total(df: DataFrame, keys, order, value: Column, chunk: Column, out: str = "total") -> DataFrame:
    """Sum of `value` over the rows of a sequence up to each row, its own included.

    Chunks as in running_streak: sums inside each chunk, plus those of the chunks before."""
    keys = list(keys)
    columns = df.columns
    rows = df.withColumn("_chunk", chunk).withColumn("_value", F.coalesce(value.cast("bigint"), F.lit(0)))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.groupBy(*keys, "_chunk").agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(F.struct(*keys, "_chunk").alias("_place"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carry"))
    joined = rows.withColumn("_local", F.sum("_value").over(inside)).withColumn("_place", F.struct(*keys, "_chunk")).join(carried, "_place")
    return joined.withColumn(out, F.col("_local") + F.col("_carry")).select(*columns, out)


def hard_failure(fetch_status: str = "fetch_status", http_status: str = "http_status") -> Column:
    """Signs of being blocked or of an overloaded site; a missing page is not one."""
    return F.col(fetch_status).isin("blocked", "captcha", "error") | (F.coalesce(http_status, F.lit(0)) >= 500)


def failure_streak(log: DataFrame, site: str, order, chunk: Column, failed: Column | None = None,
                   limit: int = presets.MAX_CONSECUTIVE_FAILURES) -> DataFrame:
    """Per site the longest run of hard failures and whether it reached the limit."""
    flag = hard_failure() if failed is None else failed
    runs = running_streak(log, [site], order, flag, chunk)
    return runs.groupBy(site).agg(F.max("streak").alias("longest_streak"),
                                  (F.max("streak") >= limit).alias("stopped"))


def empty_type_streak(log: DataFrame, site: str, order, chunk: Column, page_type: str = "page_type",
                      words: str = "word_count", ok: Column | None = None,
                      min_words: int = presets.EMPTY_PAGE_WORDS,
                      limit: int = presets.EMPTY_PAGES_BEFORE_SKIP) -> DataFrame:
    """Per site and page type the longest run of near-empty pages among the pages that were read, and
    where in `order` a run first reached the limit."""
    readable = log.where((F.col("fetch_status") == "ok") if ok is None else ok)
    runs = running_streak(readable, [site, page_type], order, F.col(words) < min_words, chunk)
    return runs.groupBy(site, page_type).agg(F.max("streak").alias("longest_streak"),
                                             (F.max("streak") >= limit).alias("skipped"),
                                             F.min(F.when(F.col("streak") >= limit, F.struct(*order))).alias("reached_at"))
