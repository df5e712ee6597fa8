"""Dashboard datasets and tiles on the built tables."""

from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.catalog import checks as K
from sitegauge.catalog import gold_queries as Q
from sitegauge.catalog.registry import register
from sitegauge.plans import serving as V
from sitegauge.plans import tiles as T

COMPANY_SQL = f"""(SELECT brand, company_name, website, coalesce(hq_address, 'Not published on website') AS hq_location,
  coalesce(phone, 'Not published on website') AS phone, coalesce(CAST(founded_year AS VARCHAR), '-') AS founded, data_note FROM {K.DIM})"""
LOCATIONS_SQL = f"""(SELECT brand, company_name, hq_address, phone, latitude, longitude FROM {K.DIM}
  WHERE latitude IS NOT NULL AND longitude IS NOT NULL)"""
CATEGORIES_SQL = f"""(SELECT brand, segment, category, product_pages,
  product_pages / sum(product_pages) OVER (PARTITION BY brand) AS share_of_company FROM {K.CATEGORIES} WHERE category <> 'Attachments')"""
ELECTRIC_SQL = f"(SELECT brand, product_name, category, segment, url FROM {K.ELECTRIC})"
TECH_SQL = f"(SELECT brand, theme, pct_pages / 100 AS share_of_pages FROM {K.TECH} WHERE has_data)"
NEWS_SQL = f"""(SELECT brand, make_date(year, 1, 1) AS year_start, news_pages, CASE WHEN year = {Q.YEAR} THEN news_pages ELSE 0 END AS news_this_year
  FROM {Q.NEWS})"""
SOME_BRANDS = ["Supplier#000000001", "Supplier#000000002", "Supplier#000000007", "Supplier#000000012"]
BRAND_LIST = ", ".join(map(K.quote, SOME_BRANDS))
SOME_SEGMENTS = ["Agriculture", "Turf & Utility"]
SEGMENT_LIST = ", ".join(map(K.quote, SOME_SEGMENTS))


def company(spark, sf, brands=None):
    return V.ds_company(Q.dim_company(spark, sf), brands)


def locations(spark, sf):
    return V.ds_locations(Q.dim_company(spark, sf))


def categories(spark, sf, brands=None, segments=None):
    return V.ds_categories(Q.company_categories(spark, sf), brands, segments)


def electric(spark, sf):
    return V.ds_electric(Q.electric_products(spark, sf))


def tech(spark, sf):
    return V.ds_tech(Q.tech_mentions(spark, sf))


def news(spark, sf):
    return V.ds_news(Q.news_by_year(spark, sf), Q.YEAR)


def rounded(df, c):
    return df.withColumn(c, F.round(c, 9))


@register("ds_company", f"SELECT * FROM {COMPANY_SQL} ORDER BY brand, company_name, website")
def ds_company(spark, sf):
    return company(spark, sf)


@register("ds_locations", f"SELECT * FROM {LOCATIONS_SQL}")
def ds_locations(spark, sf):
    return locations(spark, sf)


@register("ds_categories", f"SELECT * REPLACE (round(share_of_company, 9) AS share_of_company) FROM {CATEGORIES_SQL}")
def ds_categories(spark, sf):
    return rounded(categories(spark, sf), "share_of_company")


@register("ds_electric", f"SELECT * FROM {ELECTRIC_SQL}")
def ds_electric(spark, sf):
    return electric(spark, sf)


@register("ds_tech", f"SELECT * REPLACE (round(share_of_pages, 9) AS share_of_pages) FROM {TECH_SQL}")
def ds_tech(spark, sf):
    return rounded(tech(spark, sf), "share_of_pages")


@register("ds_news", f"SELECT * FROM {NEWS_SQL}")
def ds_news(spark, sf):
    return news(spark, sf)


@register("kpi_companies", f"SELECT count(brand) AS companies FROM {COMPANY_SQL}")
def kpi_companies(spark, sf):
    return V.kpi_companies(company(spark, sf))


@register("kpi_located", f"SELECT count(brand) AS hq_found FROM {LOCATIONS_SQL}")
def kpi_located(spark, sf):
    return V.kpi_located(locations(spark, sf))


@register("kpi_categories", f"SELECT count(DISTINCT category) AS categories FROM {CATEGORIES_SQL}")
def kpi_categories(spark, sf):
    return V.kpi_categories(categories(spark, sf))


@register("kpi_products", f"SELECT CAST(sum(product_pages) AS BIGINT) AS product_pages FROM {CATEGORIES_SQL}")
def kpi_products(spark, sf):
    return V.kpi_products(categories(spark, sf))


@register("kpi_electric", f"SELECT count(product_name) AS electric_products FROM {ELECTRIC_SQL}")
def kpi_electric(spark, sf):
    return V.kpi_electric(electric(spark, sf))


@register("kpi_news", f"SELECT CAST(sum(news_this_year) AS BIGINT) AS news_this_year FROM {NEWS_SQL}")
def kpi_news(spark, sf):
    return V.kpi_news(news(spark, sf))


@register("widget_aggregates", f"""SELECT 'kpi_categories' AS tile, CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS brand, CAST(count(DISTINCT category) AS DOUBLE) AS value FROM {CATEGORIES_SQL}
  UNION ALL SELECT 'kpi_products', NULL, NULL, CAST(sum(product_pages) AS DOUBLE) FROM {CATEGORIES_SQL}
  UNION ALL SELECT 'heat_portfolio', category, brand, round(sum(share_of_company), 9) FROM {CATEGORIES_SQL} GROUP BY category, brand
  UNION ALL SELECT 'segments', NULL, brand, CAST(count(DISTINCT segment) AS DOUBLE) FROM {CATEGORIES_SQL} GROUP BY brand
  UNION ALL SELECT 'pages_by_category', category, NULL, CAST(sum(product_pages) AS DOUBLE) FROM {CATEGORIES_SQL} GROUP BY category""")
def widget_aggregates(spark, sf):
    """All tiles of the category dataset, and two more of a user's own, in one scan of it."""
    own = (T.Tile("segments", "ds_categories", ("brand",), "segment", "count_distinct", "segments"),
           T.Tile("pages_by_category", "ds_categories", ("category",), "product_pages", "sum", "product_pages"))
    rows = T.board({"ds_categories": categories(spark, sf)}, T.TILES + own)
    return rows.select("tile", F.col("dimensions")["category"].alias("category"), F.col("dimensions")["brand"].alias("brand"), F.round("value", 9).alias("value"))


@register("map_points", f"SELECT latitude, longitude, brand FROM {LOCATIONS_SQL}")
def map_points(spark, sf):
    return V.map_points(locations(spark, sf))


@register("directory_table", f"SELECT brand, website, hq_location, phone, founded, data_note FROM {COMPANY_SQL}")
def directory_table(spark, sf):
    return V.directory_table(company(spark, sf))


THEME_ORDER = " ".join(f"WHEN {K.quote(t)} THEN {i}" for i, t in enumerate(presets.TECH_THEMES, 1))


@register("heat_portfolio", f"""SELECT category, brand, round(sum(share_of_company), 9) AS share_of_company,
  CAST(CASE category {Q.ORDER_CASE} ELSE {len(presets.CATEGORY_ORDER) + 1} END AS INT) AS category_order FROM {CATEGORIES_SQL} GROUP BY category, brand""")
def heat_portfolio(spark, sf):
    return rounded(V.heat_portfolio(categories(spark, sf)), "share_of_company")


@register("bar_electric", f"SELECT brand, count(product_name) AS electric_products FROM {ELECTRIC_SQL} GROUP BY brand ORDER BY 2, 1")
def bar_electric(spark, sf):
    return V.bar_electric(electric(spark, sf))


@register("heat_tech", f"""SELECT theme, brand, round(sum(share_of_pages), 9) AS share_of_pages,
  CAST(CASE theme {THEME_ORDER} ELSE {len(presets.TECH_THEMES) + 1} END AS INT) AS theme_order FROM {TECH_SQL} GROUP BY theme, brand""")
def heat_tech(spark, sf):
    return rounded(V.heat_tech(tech(spark, sf)), "share_of_pages")


@register("line_news", f"SELECT year_start, brand, CAST(sum(news_pages) AS BIGINT) AS news_pages FROM {NEWS_SQL} GROUP BY year_start, brand")
def line_news(spark, sf):
    return V.line_news(news(spark, sf))


@register("filter_brand", f"SELECT * FROM {COMPANY_SQL} WHERE brand IN ({BRAND_LIST})")
def filter_brand(spark, sf):
    return company(spark, sf, SOME_BRANDS)


@register("filter_segment", f"""SELECT * REPLACE (round(share_of_company, 9) AS share_of_company) FROM {CATEGORIES_SQL}
  WHERE brand IN ({BRAND_LIST}) AND segment IN ({SEGMENT_LIST})""")
def filter_segment(spark, sf):
    return rounded(categories(spark, sf, SOME_BRANDS, SOME_SEGMENTS), "share_of_company")
