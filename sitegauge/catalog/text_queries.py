"""Scalar functions on the whole tables."""

from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.catalog import checks as K
from sitegauge.catalog import standins as S
from sitegauge.catalog.registry import register
from sitegauge.functions import contacts as C
from sitegauge.functions import rules as R
from sitegauge.functions import text as X
from sitegauge.functions import urls as U
from sitegauge.plans import gold as G



@register("clean_text", f"SELECT doc_id, length({K.clean('text')}) AS n_clean, sha256({K.clean('text')}) AS digest FROM documents")
def clean_text(spark, sf):
    t = X.clean_text("text")
    return S.table(spark, sf, "documents").select("doc_id", F.length(t).cast("bigint").alias("n_clean"), F.sha2(t, 256).alias("digest"))


@register("clip_text", f"SELECT doc_id, nullif(substring({K.squeeze('text')}, 1, 300), '') AS clipped FROM documents")
def clip_text(spark, sf):
    return S.table(spark, sf, "documents").select("doc_id", X.clip_text("text", 300).alias("clipped"))


@register("word_count", f"""SELECT doc_id, CAST(CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END AS INT) AS words
  FROM (SELECT doc_id, {K.squeeze('text')} AS t FROM documents)""")
def word_count(spark, sf):
    return S.table(spark, sf, "documents").select("doc_id", X.word_count("text").alias("words"))


@register("text_fingerprint", f"SELECT doc_id, sha256(coalesce(body_text, url)) AS text_hash FROM {S.sql(S.SITE_PAGES)}")
def text_fingerprint(spark, sf):
    return S.frame(spark, sf, S.SITE_PAGES).select("doc_id", X.text_fingerprint("body_text", "url").alias("text_hash"))


@register("brand_name", f"SELECT serial_no, {K.brand('company_name')} AS brand FROM {S.sql(S.COMPANIES)}")
def brand_name(spark, sf):
    return S.frame(spark, sf, S.COMPANIES).select("serial_no", X.brand_name("company_name").alias("brand"))


@register("company_normalize", f"SELECT * FROM {K.COMPANY}")
def company_normalize(spark, sf):
    return G.company_normalize(S.frame(spark, sf, S.COMPANIES))


@register("case_normalize", f"""SELECT t.serial_no, {K.title_case(K.clean('city'))} AS city, upper(state) AS state, lower(company_site_url) AS website
  FROM {S.sql(S.COMPANY_CONTACTS)} t JOIN {S.sql(S.COMPANIES)} c ON c.serial_no = t.serial_no""")
def case_normalize(spark, sf):
    joined = S.frame(spark, sf, S.COMPANY_CONTACTS).drop("company_name").join(S.frame(spark, sf, S.COMPANIES), "serial_no")
    return joined.select("serial_no", X.city_case("city").alias("city"), F.upper("state").alias("state"),
                         F.lower("company_site_url").alias("website"))


@register("clean_url", f"SELECT page_id, {K.clean_url('url')} AS clean FROM pages")
def clean_url(spark, sf):
    return S.table(spark, sf, "pages").select("page_id", U.clean_url("url").alias("clean"))


@register("url_key", f"SELECT page_id, {K.url_key('url')} AS k FROM pages")
def url_key(spark, sf):
    return S.table(spark, sf, "pages").select("page_id", U.url_key("url").alias("k"))


@register("url_host", "SELECT page_id, regexp_replace(lower(split_part(url, '/', 3)), '^www\\.', '') AS host FROM pages")
def url_host(spark, sf):
    return S.table(spark, sf, "pages").select("page_id", U.url_host("url").alias("host"))


# The base of every third page is another language folder, so its page lies outside.
BASES = f"""(SELECT page_id, url, CASE page_id % 3 WHEN 0 THEN replace(base_url, '/en/', '/e/') ELSE upper(base_url) END AS base
  FROM {S.sql(S.PAGE_URLS)})"""


def _based(spark, sf):
    base = F.when(F.col("page_id") % 3 == 0, F.replace("base_url", F.lit("/en/"), F.lit("/e/"))).otherwise(F.upper("base_url"))
    return S.frame(spark, sf, S.PAGE_URLS).select("page_id", "url", base.alias("base"))


@register("relative_path", f"SELECT page_id, {K.relative(K.url_key('url'), 'base')} AS rel FROM {BASES}")
def relative_path(spark, sf):
    return _based(spark, sf).select("page_id", U.relative_path("url", "base").alias("rel"))


@register("within_base", f"SELECT page_id, url FROM {BASES} WHERE {K.relative(K.url_key('url'), 'base')} IS NOT NULL")
def within_base(spark, sf):
    return _based(spark, sf).where(U.within_base("url", "base")).select("page_id", "url")


@register("exclude_paths", f"""SELECT l_orderkey, l_linenumber, l_partkey, path FROM (SELECT *, CASE l_partkey % 3 WHEN 0 THEN '^parts(/|$)|^news'
    WHEN 1 THEN '^[a-z][a-z](-[a-z][a-z])?(/|$)' END AS rx FROM {S.sql(S.TYPED_PATHS)})
  WHERE rx IS NULL OR NOT regexp_matches(path, rx)""")
def exclude_paths(spark, sf):
    k = F.col("l_partkey") % 3
    rx = F.when(k == 0, "^parts(/|$)|^news").when(k == 1, "^[a-z]{2}(-[a-z]{2})?(/|$)")
    return S.frame(spark, sf, S.TYPED_PATHS).where(U.exclude_paths("path", rx)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "path")


PATHS = S.sql(S.TYPED_PATHS)
KEYS = "l_orderkey, l_linenumber, l_partkey"
KEY_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey"]


@register("path_segments", f"SELECT {KEYS}, array_to_string({K.segments('path')}, '|') AS segs FROM {PATHS}")
def path_segments(spark, sf):
    return S.frame(spark, sf, S.TYPED_PATHS).select(*KEY_COLUMNS, F.array_join(U.path_segments("path"), "|").alias("segs"))


@register("path_section", f"SELECT {KEYS}, coalesce({K.segments('path')}[1], '') AS section FROM {PATHS}")
def path_section(spark, sf):
    return S.frame(spark, sf, S.TYPED_PATHS).select(*KEY_COLUMNS, U.path_section(U.path_segments("path")).alias("section"))


@register("path_depth", f"SELECT {KEYS}, CAST(len({K.segments('path')}) AS INT) AS depth FROM {PATHS}")
def path_depth(spark, sf):
    return S.frame(spark, sf, S.TYPED_PATHS).select(*KEY_COLUMNS, U.path_depth(U.path_segments("path")).alias("depth"))


@register("path_category", f"""SELECT {KEYS}, CASE WHEN {K.page_type_case('path')} = 'product'
  THEN {K.segments('path')}[l_partkey % 3 + 1] END AS category FROM {PATHS}""")
def path_category(spark, sf):
    return S.frame(spark, sf, S.TYPED_PATHS).select(*KEY_COLUMNS, U.path_category(
        U.path_segments("path"), R.page_type("path"), (F.col("l_partkey") % 3).cast("int")).alias("category"))


@register("is_document", f"SELECT {KEYS}, regexp_matches(path, {K.quote(presets.DOCUMENT_PATTERN)}) AS document FROM {PATHS}")
def is_document(spark, sf):
    return S.frame(spark, sf, S.TYPED_PATHS).select(*KEY_COLUMNS, U.is_document("path").alias("document"))


SITE_PATTERN = "CASE WHEN l_orderkey % 3 = 0 THEN '^products(/|$)' END"


@register("page_type", f"SELECT {KEYS}, {K.page_type_case('path', SITE_PATTERN)} AS page_type FROM {PATHS}")
def page_type(spark, sf):
    site = F.when(F.col("l_orderkey") % 3 == 0, "^products(/|$)")
    return S.frame(spark, sf, S.TYPED_PATHS).select(*KEY_COLUMNS, R.page_type("path", site).alias("page_type"))


@register("rule_first_match", f"""SELECT url, {K.category_case('relative_path', 0)} AS category, {K.category_case('relative_path', 1)} AS segment
  FROM {S.sql(S.SITE_URLS)}""")
def rule_first_match(spark, sf):
    # Explicit extraction of both fields evaluates the rules once, through the code.
    coded = S.frame(spark, sf, S.SITE_URLS).select("url", R.category_code("relative_path").alias("category_code"))
    return G.with_category_names(coded)


@register("exclude_non_product", f"""SELECT url, relative_path FROM {S.sql(S.SITE_URLS)}
  WHERE NOT regexp_matches(relative_path, {K.quote(presets.NOT_PRODUCT_PATTERN)})""")
def exclude_non_product(spark, sf):
    return S.frame(spark, sf, S.SITE_URLS).where(R.exclude_non_product("relative_path")).select("url", "relative_path")


SITES = """SELECT CAST(s_suppkey AS STRING) AS serial_no, 'https://' || split_part(
  'www.deere.com,cat.com,www.JLG.com,terex.com,agcocorp.com,www.unknown.example.com,other.example.org,komatsu.com', ',',
  CAST(s_suppkey % 8 AS INT) + 1) || '/start' AS company_site_url FROM {supplier}"""
RULE_VALUES = ", ".join(
    "(" + ", ".join("NULL" if v is None else K.quote(v) if isinstance(v, str) else str(v) for v in (
        host, rule.get("base_url"), rule.get("start_url"), rule.get("exclude"), rule.get("product_pattern"),
        rule.get("category_segment"))) + ")" for host, rule in presets.SITE_RULES.items())


@register("site_rule_defaults", f"""SELECT s.serial_no, s.host, coalesce(b, company_site_url) AS base_url,
  coalesce(st, b, company_site_url) AS start_url, ex AS exclude, pp AS product_pattern, CAST(coalesce(cs, 0) AS INT) AS category_segment
  FROM (SELECT *, regexp_replace(lower(split_part(company_site_url, '/', 3)), '^www\\.', '') AS host FROM {S.sql(SITES)}) s
  LEFT JOIN (VALUES {RULE_VALUES}) AS v(host, b, st, ex, pp, cs) ON v.host = s.host""")
def site_rule_defaults(spark, sf):
    return R.site_rule_defaults(S.frame(spark, sf, SITES), R.rules_table(spark)).drop("company_site_url", "sitemaps")


@register("label_map", f"SELECT serial_no, {K.label('status', presets.DATA_NOTES)} AS note FROM {S.sql(S.SCRAPE_STATUS)}")
def label_map(spark, sf):
    return S.frame(spark, sf, S.SCRAPE_STATUS).select("serial_no", X.label_map("status", presets.DATA_NOTES).alias("note"))


@register("tagline", f"""SELECT doc_id, {K.clean('coalesce(meta_description, h1, body_text)')} AS tagline
  FROM {S.sql(S.SITE_PAGES)}""")
def tagline(spark, sf):
    return S.frame(spark, sf, S.SITE_PAGES).select("doc_id", X.tagline("meta_description", "h1", "body_text").alias("tagline"))


@register("null_to_zero", """SELECT c_custkey, coalesce(n, 0) AS orders FROM customer
  LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""")
def null_to_zero(spark, sf):
    counts = S.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return S.table(spark, sf, "customer").join(counts, "c_custkey", "left").select("c_custkey", X.null_to_zero("n").alias("orders"))


@register("presence_flag", f"SELECT serial_no, latitude IS NOT NULL AS has_location FROM {S.sql(S.COMPANY_CONTACTS)}")
def presence_flag(spark, sf):
    return S.frame(spark, sf, S.COMPANY_CONTACTS).select("serial_no", X.presence_flag("latitude").alias("has_location"))


@register("default_label", f"SELECT url, coalesce(category, 'Other') AS category, coalesce(segment, 'Other') AS segment FROM {K.PRODUCTS}")
def default_label(spark, sf):
    products = G.with_category_names(G.product_urls(S.frame(spark, sf, S.SITE_URLS)))
    return products.select("url", X.default_label("category").alias("category"), X.default_label("segment").alias("segment"))


NAMED = f"""(SELECT p.*, h.h1 FROM {S.sql(S.SITE_URLS)} p LEFT JOIN {S.sql(S.PRODUCT_PAGES)} h
  ON h.serial_no = CAST(p.serial_no AS INT) AND h.url = p.url)"""


def _named(spark, sf):
    headings = S.frame(spark, sf, S.PRODUCT_PAGES).select(F.col("serial_no").cast("string").alias("serial_no"), "url", "h1")
    return S.frame(spark, sf, S.SITE_URLS).join(headings, ["serial_no", "url"], "left")


@register("product_name", f"SELECT url, {K.product_name('h1', 'relative_path')} AS product_name FROM {NAMED}")
def product_name(spark, sf):
    return _named(spark, sf).select("url", X.product_name("h1", "relative_path").alias("product_name"))


@register("value_provenance", f"SELECT url, CASE WHEN h1 IS NULL THEN 'page address' ELSE 'page heading' END AS name_source FROM {NAMED}")
def value_provenance(spark, sf):
    return _named(spark, sf).select("url", X.value_provenance("h1").alias("name_source"))


@register("keyword_or_filter", f"""SELECT url, h1 FROM {NAMED} WHERE regexp_matches(relative_path, {K.quote(presets.ELECTRIC_PATH_PATTERN)})
  OR regexp_matches(coalesce(h1, ''), {K.quote(presets.ELECTRIC_HEADING_PATTERN)})""")
def keyword_or_filter(spark, sf):
    return _named(spark, sf).where(R.keyword_or_filter("relative_path", "h1")).select("url", "h1")


@register("year_from_path", f"""SELECT url, TRY_CAST(regexp_extract(relative_path, '(^|/)((19|20)[0-9][0-9])(/|-|$)', 2) AS INT) AS year
  FROM {S.sql(S.SITE_URLS)}""")
def year_from_path(spark, sf):
    return S.frame(spark, sf, S.SITE_URLS).select("url", X.year_from_path("relative_path").alias("year"))


@register("guarded_percent", """SELECT l_suppkey, CASE WHEN n >= 590 THEN round(100.0 * r / n, 1) END AS pct, n, CAST(r AS BIGINT) AS r FROM
  (SELECT l_suppkey, count(*) AS n, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS r FROM lineitem GROUP BY l_suppkey)""")
def guarded_percent(spark, sf):
    counts = S.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("r"))
    return counts.select("l_suppkey", X.guarded_percent("r", "n", 590).alias("pct"), "n", "r")


PHONE_INPUT = """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN phone_text WHEN 1 THEN '1' || replace(phone, '-', '.')
  WHEN 2 THEN 'x' || phone || '9' ELSE '1' || substring(phone, 2, 20) END AS raw FROM (""" + S.CONTACT_PAGES + ")"


@register("format_phone", f"""SELECT c_custkey, CASE WHEN length(d) = 10 AND d[1] NOT IN ('0', '1') AND d[4] NOT IN ('0', '1')
    THEN d[1:3] || '-' || d[4:6] || '-' || d[7:10] END AS phone
  FROM (SELECT c_custkey, CASE WHEN length(r) = 11 AND r[1] = '1' THEN r[2:11] ELSE r END AS d
        FROM (SELECT c_custkey, regexp_replace(raw, '[^0-9]', '', 'g') AS r FROM {S.sql(PHONE_INPUT)}))""")
def format_phone(spark, sf):
    return S.frame(spark, sf, PHONE_INPUT).select("c_custkey", X.format_phone("raw").alias("phone"))


@register("state_code", f"SELECT c_custkey, code AS state FROM {S.sql(S.CONTACT_PAGES)}")
def state_code(spark, sf):
    return S.frame(spark, sf, S.CONTACT_PAGES).select("c_custkey", X.state_code("state").alias("state"))




@register("clean_city", f"""SELECT c_custkey, CASE WHEN street LIKE '%South' THEN 'South ' || city ELSE city END AS city
  FROM {S.sql(S.CONTACT_PAGES)}""")
def clean_city(spark, sf):
    # "Lyndale Avenue South Racine" keeps "South Racine": South is not a compass letter.
    return S.frame(spark, sf, S.CONTACT_PAGES).select(
        "c_custkey", X.clean_city(F.concat_ws(" ", "street", "city")).alias("city"))


@register("parse_address", f"""SELECT c_custkey, street || ' ' || city AS city, code AS state, zip FROM {S.sql(S.CONTACT_PAGES)} WHERE length(state) = 2""")
def parse_address(spark, sf):
    text = F.concat(F.concat_ws(" ", "street", "city"), F.lit(", "), F.col("state"), F.lit(" "), F.col("zip"))
    return (S.frame(spark, sf, S.CONTACT_PAGES).select("c_custkey", X.parse_address(text).alias("a"))
            .where(F.col("a").isNotNull()).select("c_custkey", "a.city", "a.state", "a.zip"))


@register("city_resolution", f"""SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN 'Elsewhere' WHEN street LIKE '%South' THEN
    CASE WHEN c_custkey % 7 = 0 THEN 'South ' || city ELSE city END ELSE city END AS city FROM {S.sql(S.CONTACT_PAGES)}""")
def city_resolution(spark, sf):
    raw = F.when(F.col("c_custkey") % 6 == 0, F.lit("Main Street")).otherwise(F.concat_ws(" ", "street", "city"))
    geo = F.when(F.col("c_custkey") % 6 == 0, F.lit("Elsewhere")).when(F.col("c_custkey") % 7 != 0, F.col("city"))
    return S.frame(spark, sf, S.CONTACT_PAGES).select("c_custkey", X.city_resolution(raw, geo).alias("city"))


@register("substring_around", f"""SELECT c_custkey, right(intro || street || ' ' || city || ', ' || state || ' ' || zip || '. ' || mid, 30) AS before,
  phone_text AS match, ' for more.' AS after FROM {S.sql(S.CONTACT_PAGES)}""")
def substring_around(spark, sf):
    found = C.matches_in_context("text", presets.PHONE_PATTERN, 30)
    return (S.frame(spark, sf, S.CONTACT_PAGES).select("c_custkey", F.explode(found).alias("m"))
            .select("c_custkey", "m.before", "m.match", "m.after"))


@register("sentence_split", r"""SELECT doc_id, len(string_split(regexp_replace(text, '([.!?])[\s\x0b\x1c-\x1f\x{85}\p{Z}]+', '\1' || chr(1), 'g'), chr(1))) AS sentences
  FROM documents""")
def sentence_split(spark, sf):
    return S.table(spark, sf, "documents").select("doc_id", F.size(X.sentence_split("text")).cast("bigint").alias("sentences"))


@register("in_list_filter", "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year FROM orders WHERE year(o_orderdate) IN (1997, 1998, 1999, 2000, 2001)")
def in_list_filter(spark, sf):
    from sitegauge.operators.aggregates import in_list_filter as kept, news_years
    return S.table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year")).where(kept("year", news_years(2001)))
