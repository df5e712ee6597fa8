"""First row and first k rows of groups, and other ordered choices."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitegauge.operators.joins import salts_of


def first_per_group(df: DataFrame, keys, order) -> DataFrame:
    """The first row of each group.

    Written as row_number() = 1 so that Spark keeps one row per group in every map task before the
    shuffle (WindowGroupLimit): a group of copies, however large, reaches the reducer as one row
    per map task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def per_group_top_k(df: DataFrame, keys, order, k: int, rank: str = "rank", spread=(), salts: int | None = None) -> DataFrame:
    """The first k rows of each group with their rank.

    With `spread` columns the groups are first cut to k inside `salts` buckets, so the k rows that
    every map task keeps of a hot group are merged by several tasks, not one."""
    salts = salts_of(df) if salts is None else salts
    if spread and salts > 1:
        bucket = F.pmod(F.xxhash64(*spread), F.lit(salts))
        w = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (df.withColumn("_salt", bucket).withColumn("_n", F.row_number().over(w))
              .where(F.col("_n") <= k).drop("_n", "_salt"))
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def dedup_text_per_site(pages: DataFrame, site: str = "serial_no", fingerprint: str = "text_hash",
                        url: str = "url") -> DataFrame:
    """One page per site and text: the one with the smallest address."""
    return first_per_group(pages, [site, fingerprint], [url])


def dedup_product_name(products: DataFrame, site: str = "serial_no", name: str = "product_name",
                       url: str = "url") -> DataFrame:
    """One row per site and product name, case ignored: the one with the smallest address."""
    keyed = products.withColumn("_name_key", F.lower(name))
    return first_per_group(keyed, [site, "_name_key"], [url]).drop("_name_key")


def url_set_union(sources: list) -> DataFrame:
    """Stack candidate tables; `priority` is the place in the list, earlier sources win later."""
    stacked = None
    for i, source in enumerate(sources):
        part = source.withColumn("priority", F.lit(i))
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    return stacked


def top_n(df: DataFrame, order, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
