"""Queries behind the dashboard tiles, each with optional brand and segment filters."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.operators.aggregates import share_of_partition
from sitegauge.plans.tiles import tile_rows


def filter_brand(df: DataFrame, brands=None) -> DataFrame:
    """Keep the selected brands; no selection keeps all."""
    return df.where(F.col("brand").isin(list(brands))) if brands else df


def filter_segment(df: DataFrame, segments=None) -> DataFrame:
    return df.where(F.col("segment").isin(list(segments))) if segments else df


def ds_company(dim: DataFrame, brands=None) -> DataFrame:
    """Directory, ordered by brand; equal brands go on by name and site so that the sort can split
    a brand that many rows share."""
    missing = F.lit(presets.NOT_PUBLISHED_LABEL)
    return filter_brand(dim, brands).select(
        "brand", "company_name", "website", F.coalesce("hq_address", missing).alias("hq_location"),
        F.coalesce("phone", missing).alias("phone"),
        F.coalesce(F.col("founded_year").cast("string"), F.lit(presets.NO_YEAR_LABEL)).alias("founded"),
        "data_note").orderBy("brand", "company_name", "website")


def ds_locations(dim: DataFrame, brands=None) -> DataFrame:
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return filter_brand(dim, brands).where(located).select(
        "brand", "company_name", "hq_address", "phone", "latitude", "longitude")


def ds_categories(categories: DataFrame, brands=None, segments=None,
                  excluded: str = presets.EXCLUDED_CATEGORY) -> DataFrame:
    """Categories with their share of the brand's pages; the excluded category is out of the total.
    Filters come after the shares: a selection must not change them."""
    counted = categories.where(F.col("category") != excluded).select("brand", "segment", "category", "product_pages")
    shares = share_of_partition(counted, "product_pages", "brand", "share_of_company", spread=["category", "segment"])
    return filter_segment(filter_brand(shares, brands), segments).select(
        "brand", "segment", "category", "product_pages", "share_of_company")


def ds_electric(products: DataFrame, brands=None, segments=None) -> DataFrame:
    return filter_segment(filter_brand(products, brands), segments).select(
        "brand", "product_name", "category", "segment", "url")


def ds_tech(mentions: DataFrame, brands=None) -> DataFrame:
    return filter_brand(mentions, brands).where("has_data").select(
        "brand", "theme", (F.col("pct_pages") / 100).alias("share_of_pages"))


def ds_news(news: DataFrame, as_of_year: int, brands=None) -> DataFrame:
    this_year = F.when(F.col("year") == as_of_year, F.col("news_pages")).otherwise(F.lit(0))
    return filter_brand(news, brands).select(
        "brand", F.make_date("year", F.lit(1), F.lit(1)).alias("year_start"), "news_pages",
        this_year.alias("news_this_year"))


def kpi_companies(company: DataFrame) -> DataFrame:
    return tile_rows(company, "kpi_companies")


def kpi_located(locations: DataFrame) -> DataFrame:
    return tile_rows(locations, "kpi_located")


def kpi_categories(categories: DataFrame) -> DataFrame:
    return tile_rows(categories, "kpi_categories")


def kpi_products(categories: DataFrame) -> DataFrame:
    return tile_rows(categories, "kpi_products")


def kpi_electric(products: DataFrame) -> DataFrame:
    return tile_rows(products, "kpi_electric")


def kpi_news(news: DataFrame) -> DataFrame:
    return tile_rows(news, "kpi_news")


def map_points(locations: DataFrame) -> DataFrame:
    return locations.select("latitude", "longitude", "brand")


def directory_table(company: DataFrame) -> DataFrame:
    return company.select("brand", "website", "hq_location", "phone", "founded", "data_note")


def heat_portfolio(categories: DataFrame) -> DataFrame:
    return tile_rows(categories, "heat_portfolio")


def bar_electric(products: DataFrame) -> DataFrame:
    return tile_rows(products, "bar_electric")


def heat_tech(tech: DataFrame) -> DataFrame:
    return tile_rows(tech, "heat_tech")


def line_news(news: DataFrame) -> DataFrame:
    return tile_rows(news, "line_news")
