"""Joins, aggregations, rankings and the whole dashboard tables."""

from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.catalog import checks as K
from sitegauge.catalog import standins as S
from sitegauge.catalog.registry import register
from sitegauge.operators import aggregates as A
from sitegauge.operators import ranking as R
from sitegauge.operators.joins import lookup_join
from sitegauge.plans import gold as G

YEAR = 2001
YEARS = A.news_years(YEAR)
PAGE_KEYS = ["doc_id", "serial_no", "url"]

# Frequent words of the test documents.  The documents have accented letters, so both sides spell
# out Unicode word boundaries: a plain boundary differs between Java versions and regex engines.
WORD_LISTS = {
    "Articles": "the|die|los",
    "Joining": "and|und|pour",
    "Sharing": "with|avec|para",
    "Rare": "password|license",
}
WORDS = {name: rf"(?iU)\b({words})\b" for name, words in WORD_LISTS.items()}
NOT_A_LETTER = r"[^\p{L}\p{M}\p{N}_]"
SQL_WORDS = [f"(?i)(^|{NOT_A_LETTER})({words})($|{NOT_A_LETTER})" for words in WORD_LISTS.values()]


def company(spark, sf):
    return G.company_normalize(S.frame(spark, sf, S.COMPANIES))


def status(spark, sf):
    return S.frame(spark, sf, S.SCRAPE_STATUS)


def site_pages(spark, sf):
    return S.frame(spark, sf, S.SITE_PAGES)


def product_table(spark, sf):
    return G.product_urls(S.frame(spark, sf, S.SITE_URLS))


def product_paths(spark, sf):
    """Product addresses that get their category after they are made distinct."""
    return G.product_paths(S.frame(spark, sf, S.SITE_URLS))


def cleaned(spark, sf):
    return G.clean_pages(G.page_features(site_pages(spark, sf)), status(spark, sf))


def headings(spark, sf):
    return S.frame(spark, sf, S.PRODUCT_PAGES)


# --- joins ---------------------------------------------------------------------------------

@register("join_pages_base", f"""SELECT doc_id, url, regexp_replace(lower(base_url), '/$', '') AS base
  FROM {S.sql(S.SITE_PAGES)} p JOIN {S.sql(S.SCRAPE_STATUS)} s ON p.serial_no = s.serial_no""")
def join_pages_base(spark, sf):
    base = status(spark, sf).select("serial_no", F.regexp_replace(F.lower("base_url"), "/$", "").alias("base"))
    return lookup_join(site_pages(spark, sf).select("serial_no", "doc_id", "url"), base, "serial_no", "inner",
                       spread=["url"]).select("doc_id", "url", "base")


@register("join_dim_contacts", f"""SELECT c.serial_no, company_name, hq_address, phone FROM {K.COMPANY} c
  LEFT JOIN (SELECT CAST(serial_no AS INT) AS serial_no, hq_address, phone FROM {S.sql(S.COMPANY_CONTACTS)}) t ON t.serial_no = c.serial_no""")
def join_dim_contacts(spark, sf):
    contacts = S.frame(spark, sf, S.COMPANY_CONTACTS).select(F.col("serial_no").cast("int").alias("serial_no"), "hq_address", "phone")
    return company(spark, sf).join(contacts, "serial_no", "left").select("serial_no", "company_name", "hq_address", "phone")


@register("join_dim_status", f"""SELECT c.serial_no, company_name, status FROM {K.COMPANY} c
  LEFT JOIN (SELECT CAST(serial_no AS INT) AS serial_no, status FROM {S.sql(S.SCRAPE_STATUS)}) t ON t.serial_no = c.serial_no""")
def join_dim_status(spark, sf):
    state = status(spark, sf).select(F.col("serial_no").cast("int").alias("serial_no"), "status")
    return company(spark, sf).join(state, "serial_no", "left").select("serial_no", "company_name", "status")


@register("join_dim_home", f"""SELECT c.serial_no, company_name, tagline FROM {K.COMPANY} c LEFT JOIN
  (SELECT serial_no, {K.clean('coalesce(meta_description, h1, body_text)')} AS tagline FROM {K.CLEAN_PAGES} WHERE page_type = 'home') t
  ON t.serial_no = c.serial_no""")
def join_dim_home(spark, sf):
    home = cleaned(spark, sf).where(F.col("page_type") == "home").select("serial_no", "tagline")
    return company(spark, sf).join(home, "serial_no", "left").select("serial_no", "company_name", "tagline")


@register("join_dim_counts", f"""SELECT c.serial_no, company_name, product_pages FROM {K.COMPANY} c LEFT JOIN
  (SELECT serial_no, count(DISTINCT url) AS product_pages FROM {K.PRODUCTS} GROUP BY serial_no) t ON t.serial_no = c.serial_no""")
def join_dim_counts(spark, sf):
    counts = A.product_page_counts(product_table(spark, sf))
    return company(spark, sf).join(counts, "serial_no", "left").select("serial_no", "company_name", "product_pages")


@register("join_categories_company", f"""SELECT r.serial_no, brand, category, n FROM
  (SELECT serial_no, category, count(DISTINCT url) AS n FROM {K.PRODUCTS} WHERE category IS NOT NULL GROUP BY serial_no, category) r
  JOIN {K.COMPANY} c ON c.serial_no = r.serial_no""")
def join_categories_company(spark, sf):
    counts = G.category_rollup(product_paths(spark, sf))
    return counts.join(company(spark, sf), "serial_no").select("serial_no", "brand", "category", F.col("product_pages").alias("n"))


@register("join_products_heading", f"""SELECT p.serial_no, p.url, h1 FROM {K.PRODUCTS} p LEFT JOIN {S.sql(S.PRODUCT_PAGES)} h
  ON h.serial_no = p.serial_no AND h.url = p.url""")
def join_products_heading(spark, sf):
    return product_table(spark, sf).join(headings(spark, sf), ["serial_no", "url"], "left").select("serial_no", "url", "h1")


@register("join_electric_company", f"""SELECT e.serial_no, brand, product_name, url FROM {K.ELECTRIC_ROWS} e JOIN {K.COMPANY} c ON c.serial_no = e.serial_no""")
def join_electric_company(spark, sf):
    found = G.with_category_names(product_table(spark, sf).join(headings(spark, sf), ["serial_no", "url"], "left"))
    from sitegauge.functions import rules, text
    rows = found.where(rules.keyword_or_filter("relative_path", "h1")).where(
        ~text.last_segment("relative_path").rlike(presets.ELECTRIC_LANDING_PATTERN)).select(
        "serial_no", text.product_name("h1", "relative_path").alias("product_name"), "url")
    return lookup_join(rows, company(spark, sf).select("serial_no", "brand"), "serial_no", "inner", spread=["url"])


THEME_VALUES = ", ".join(f"({i}, {K.quote(n)})" for i, n in enumerate(WORDS))


def theme_cells():
    return A.literal_cells(("theme_id", "theme"), list(enumerate(WORDS)))


@register("cross_company_theme", f"""SELECT serial_no, brand, CAST(theme_id AS INT) AS theme_id, theme FROM {K.COMPANY}
  CROSS JOIN (VALUES {THEME_VALUES}) AS v(theme_id, theme)""")
def cross_company_theme(spark, sf):
    return A.dense_grid(company(spark, sf).select("serial_no", "brand"), theme_cells())


def text_pages(spark, sf):
    """Documents as pages of their source with the theme flags; no text goes further."""
    docs = S.table(spark, sf, "documents")
    flags = [F.col("text").rlike(rx).cast("int").alias(f"t{i}") for i, rx in enumerate(WORDS.values())]
    return docs.select(F.substring("source", 4, 9).cast("int").alias("serial_no"), *flags)


DOC_COUNTS = f"""(SELECT CAST(substring(source, 4, 9) AS INT) AS serial_no, count(*) AS text_pages,
  {", ".join(f"CAST(sum(CASE WHEN regexp_matches(text, {K.quote(rx)}) THEN 1 ELSE 0 END) AS BIGINT) AS t{i}" for i, rx in enumerate(SQL_WORDS))}
  FROM documents GROUP BY source)"""
UNPIVOTED = "(" + " UNION ALL ".join(
    f"SELECT serial_no, CAST({i} AS INT) AS theme_id, t{i} AS pages_mentioning FROM {DOC_COUNTS}" for i in range(len(WORDS))) + ")"


@register("theme_counts", f"SELECT * FROM {DOC_COUNTS}")
def theme_counts(spark, sf):
    return A.theme_counts(text_pages(spark, sf), WORDS)


@register("union_by_name", f"SELECT * FROM {UNPIVOTED}")
def union_by_name(spark, sf):
    return A.union_by_name(A.theme_counts(text_pages(spark, sf), WORDS), WORDS)


@register("join_theme_textpages", f"""SELECT c.serial_no, theme, text_pages FROM {K.COMPANY} c
  CROSS JOIN (VALUES {THEME_VALUES}) AS v(theme_id, theme) LEFT JOIN {DOC_COUNTS} k ON k.serial_no = c.serial_no""")
def join_theme_textpages(spark, sf):
    grid = A.dense_grid(company(spark, sf).select("serial_no"), theme_cells())
    counts = A.theme_counts(text_pages(spark, sf), WORDS).select("serial_no", "text_pages")
    return grid.join(counts, "serial_no", "left").select("serial_no", "theme", "text_pages")


@register("join_theme_mentions", f"""SELECT c.serial_no, theme, pages_mentioning FROM {K.COMPANY} c
  CROSS JOIN (VALUES {THEME_VALUES}) AS v(theme_id, theme) LEFT JOIN {UNPIVOTED} k ON k.serial_no = c.serial_no AND k.theme_id = v.theme_id""")
def join_theme_mentions(spark, sf):
    grid = A.dense_grid(company(spark, sf).select("serial_no"), theme_cells())
    mentions = A.union_by_name(A.theme_counts(text_pages(spark, sf), WORDS), WORDS)
    return grid.join(mentions, ["serial_no", "theme_id"], "left").select("serial_no", "theme", "pages_mentioning")


def news_urls(spark, sf):
    return S.frame(spark, sf, S.SITE_URLS).withColumn("serial_no", F.col("serial_no").try_cast("int"))


def year_cells():
    return A.literal_cells(("year",), [(y,) for y in YEARS])


YEAR_VALUES = ", ".join(f"({y})" for y in YEARS)
NEWS_COUNTS = K.news_counts_sql(YEARS)


@register("cross_company_year", f"""SELECT serial_no, CAST(y AS INT) AS year FROM (SELECT DISTINCT serial_no FROM {NEWS_COUNTS})
  CROSS JOIN (VALUES {YEAR_VALUES}) AS v(y)""")
def cross_company_year(spark, sf):
    known = A.news_counts(news_urls(spark, sf), YEARS).select("serial_no").distinct()
    return A.dense_grid(known, year_cells())


@register("join_year_news", f"""SELECT k.serial_no, CAST(y AS INT) AS year, news_pages FROM (SELECT DISTINCT serial_no FROM {NEWS_COUNTS}) k
  CROSS JOIN (VALUES {YEAR_VALUES}) AS v(y) LEFT JOIN {NEWS_COUNTS} n ON n.serial_no = k.serial_no AND n.year = y""")
def join_year_news(spark, sf):
    counts = A.news_counts(news_urls(spark, sf), YEARS)
    grid = A.dense_grid(counts.select("serial_no").distinct(), year_cells())
    return grid.join(counts, ["serial_no", "year"], "left")


@register("join_news_company", f"SELECT n.serial_no, brand, year, news_pages FROM {NEWS_COUNTS} n JOIN {K.COMPANY} c ON c.serial_no = n.serial_no")
def join_news_company(spark, sf):
    counts = A.news_counts(news_urls(spark, sf), YEARS)
    return counts.join(company(spark, sf).select("serial_no", "brand"), "serial_no")


# --- aggregations --------------------------------------------------------------------------

@register("product_page_counts", f"SELECT serial_no, count(DISTINCT url) AS product_pages FROM {K.PRODUCTS} GROUP BY serial_no")
def product_page_counts(spark, sf):
    return A.product_page_counts(product_table(spark, sf))


@register("category_rollup", f"""SELECT serial_no, segment, category, count(DISTINCT url) AS product_pages, min(url) AS example_url
  FROM {K.PRODUCTS} WHERE category IS NOT NULL GROUP BY serial_no, segment, category""")
def category_rollup(spark, sf):
    return G.category_rollup(product_paths(spark, sf))


REPORT = f"""(SELECT serial_no, regexp_extract(relative_path, '^([^/]+(/[^/]+)?)', 1) AS path, count(*) AS pages
  FROM {K.PRODUCTS} WHERE category IS NULL GROUP BY 1, 2)"""


@register("uncategorized_report", f"SELECT * FROM {REPORT}")
def uncategorized_report(spark, sf):
    return A.uncategorized_report(G.with_category_names(product_table(spark, sf)))


@register("uncategorized_totals", f"""SELECT count(*) FILTER (WHERE category IS NULL) AS unmapped_pages, count(*) AS product_pages FROM {K.PRODUCTS}""")
def uncategorized_totals(spark, sf):
    return A.uncategorized_totals(G.with_category_names(product_table(spark, sf)))


@register("news_counts", f"SELECT * FROM {NEWS_COUNTS}")
def news_counts(spark, sf):
    return A.news_counts(news_urls(spark, sf), YEARS)


@register("distinct_keys", f"SELECT DISTINCT serial_no FROM {NEWS_COUNTS}")
def distinct_keys(spark, sf):
    return A.news_counts(news_urls(spark, sf), YEARS).select("serial_no").distinct()


# --- rankings, sorts, sets ------------------------------------------------------------------

HASHED = f"(SELECT doc_id, serial_no, url, coalesce(body_text, url) AS t FROM {S.sql(S.SITE_PAGES)})"


@register("dedup_text_per_site", f"SELECT doc_id, serial_no, url FROM {K.first_rows(HASHED, 'serial_no, t', 'url')}")
def dedup_text_per_site(spark, sf):
    from sitegauge.functions.text import text_fingerprint
    hashed = site_pages(spark, sf).select(*PAGE_KEYS, text_fingerprint("body_text", "url").alias("text_hash"))
    return R.dedup_text_per_site(hashed).select(*PAGE_KEYS)


@register("dedup_product_name", f"""SELECT serial_no, product_name, url FROM {K.first_rows(
    "(SELECT l_suppkey AS serial_no, p_name AS product_name, 'p/' || CAST(l_orderkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) || '/' || CAST(l_partkey AS VARCHAR) AS url "
    "FROM lineitem JOIN part ON p_partkey = l_partkey)", 'serial_no, lower(product_name)', 'url')}""")
def dedup_product_name(spark, sf):
    facts = S.table(spark, sf, "lineitem").join(S.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = facts.select(F.col("l_suppkey").alias("serial_no"), F.col("p_name").alias("product_name"),
                        F.concat_ws("/", F.lit("p"), "l_orderkey", "l_linenumber", "l_partkey").alias("url"))
    return R.dedup_product_name(rows)


@register("per_group_top_k", """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity, rank FROM
  (SELECT *, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS INT) AS rank
   FROM lineitem) WHERE rank <= 80""")
def per_group_top_k(spark, sf):
    rows = S.table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    order = [F.desc("l_quantity"), "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return R.per_group_top_k(rows, ["l_suppkey"], order, 80, spread=["l_orderkey", "l_linenumber", "l_partkey"]).drop("l_extendedprice")


@register("order_by", f"SELECT serial_no, brand, website FROM {K.COMPANY} ORDER BY brand, serial_no")
def order_by(spark, sf):
    return company(spark, sf).select("serial_no", "brand", "website").orderBy("brand", "serial_no")


@register("top_n", """SELECT p_name, p_type, count(*) AS lines FROM lineitem JOIN part ON p_partkey = l_partkey
  GROUP BY p_name, p_type ORDER BY lines DESC, p_name, p_type LIMIT 15""")
def top_n(spark, sf):
    facts = S.table(spark, sf, "lineitem").join(S.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return R.top_n(facts.groupBy("p_name", "p_type").agg(F.count("*").alias("lines")),
                   [F.desc("lines"), "p_name", "p_type"], 15)


ORDER_CASE = " ".join(f"WHEN {K.quote(c)} THEN {i}" for i, c in enumerate(presets.CATEGORY_ORDER, 1))


@register("custom_sort_order", f"""SELECT serial_no, category, CAST(CASE category {ORDER_CASE} ELSE {len(presets.CATEGORY_ORDER) + 1} END AS INT) AS place
  FROM {K.CATEGORIES}""")
def custom_sort_order(spark, sf):
    from sitegauge.functions.rules import custom_sort_order as place
    return G.category_rollup(product_paths(spark, sf)).select("serial_no", "category", place("category").alias("place"))


@register("share_of_partition", """SELECT s_suppkey, s_nationkey, s_acctbal_cents, round(s_acctbal_cents / sum(s_acctbal_cents) OVER (PARTITION BY s_nationkey), 9) AS share
  FROM (SELECT s_suppkey, s_nationkey, CAST(round(s_acctbal * 100) AS BIGINT) + 200000 AS s_acctbal_cents FROM supplier)""")
def share_of_partition(spark, sf):
    rows = S.table(spark, sf, "supplier").select(
        "s_suppkey", "s_nationkey", (F.round(F.col("s_acctbal") * 100).cast("bigint") + 200000).alias("s_acctbal_cents"))
    shares = A.share_of_partition(rows, "s_acctbal_cents", "s_nationkey", "share", spread=["s_suppkey"])
    return shares.withColumn("share", F.round("share", 9))


# --- whole tables ----------------------------------------------------------------------------

@register("filter_ok_on_site", f"SELECT doc_id, serial_no, url FROM {K.ON_SITE}")
def filter_ok_on_site(spark, sf):
    pages = site_pages(spark, sf).select(*PAGE_KEYS, "final_url", "fetch_status")
    return G.filter_ok_on_site(pages, status(spark, sf)).select(*PAGE_KEYS)


@register("clean_pages", f"SELECT serial_no, url, page_type, h1, word_count, body_text FROM {K.CLEAN_PAGES}")
def clean_pages(spark, sf):
    return G.clean_pages(site_pages(spark, sf), status(spark, sf)).select("serial_no", "url", "page_type", "h1", "word_count", "body_text")


@register("product_urls", f"SELECT * FROM {K.PRODUCTS}")
def product_urls(spark, sf):
    return G.with_category_names(product_table(spark, sf))


@register("dim_company", f"SELECT * FROM {K.DIM}")
def dim_company(spark, sf):
    return G.dim_company(company(spark, sf), S.frame(spark, sf, S.COMPANY_CONTACTS), status(spark, sf),
                         cleaned(spark, sf), product_table(spark, sf))


@register("company_categories", f"SELECT * FROM {K.CATEGORIES}")
def company_categories(spark, sf):
    return G.company_categories(company(spark, sf), product_paths(spark, sf))


@register("electric_products", f"SELECT * FROM {K.ELECTRIC}")
def electric_products(spark, sf):
    return G.electric_products(company(spark, sf), headings(spark, sf), product_table(spark, sf))


@register("tech_mentions", f"SELECT * FROM {K.TECH}")
def tech_mentions(spark, sf):
    return G.tech_mentions(company(spark, sf), cleaned(spark, sf))


NEWS = K.news_sql(YEARS)


@register("news_by_year", f"SELECT * FROM {NEWS}")
def news_by_year(spark, sf):
    return G.news_by_year(company(spark, sf), S.frame(spark, sf, S.SITE_URLS), YEAR)
