"""SQL fragments for the checking engine."""

from sitegauge import presets
from sitegauge.catalog import standins as S

SPACES = r"[\s\x0b]+"
UNICODE_SPACES = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def clean(c: str) -> str:
    return f"trim(regexp_replace({c}, '{SPACES}', ' ', 'g'))"


def squeeze(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{UNICODE_SPACES}', ' ', 'g'))"


def title_case(c: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({c}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def brand(c: str) -> str:
    tail = r"\s+(" + "|".join(presets.BRAND_SUFFIXES) + ")$"
    return f"regexp_replace(regexp_replace({clean(c)}, '^The\\s+', ''), {quote(tail)}, '')"


def label(c: str, labels: dict) -> str:
    cases = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in labels.items())
    return f"CASE {c} {cases} ELSE {c} END"


# The two rules with a look-ahead, as conditions without one.
SPLIT_RULES = {
    "Engines & Powertrain": "(NOT {p} LIKE '%engine-powered%' AND regexp_matches({p}, 'engine|drivetrain|powertrain|agco-power|pump-drive'))",
    "Compaction": "(NOT regexp_matches({p}, 'tillage|seed|planter') AND regexp_matches({p}, 'compaction|compactor|roller|vibratory|rammer'))",
}


def category_case(path: str, part: int) -> str:
    """CASE over the category rules; part 0 gives the category, 1 the segment."""
    arms = []
    for rule in presets.CATEGORY_RULES:
        hit = SPLIT_RULES[rule[0]].format(p=path) if rule[0] in SPLIT_RULES else f"regexp_matches({path}, {quote(rule[2])})"
        arms.append(f"WHEN {hit} THEN {quote(rule[part])}")
    return "CASE " + " ".join(arms) + " END"


def page_type_case(path: str, product_pattern: str = "CAST(NULL AS VARCHAR)") -> str:
    arms = [f"WHEN regexp_matches({path}, {quote(presets.DOCUMENT_PATTERN)}) THEN 'document'",
            f"WHEN replace({path}, '/', '') = '' THEN 'home'",
            f"WHEN {product_pattern} IS NOT NULL AND regexp_matches({path}, {product_pattern}) THEN 'product'"]
    for name, words in presets.PAGE_TYPE_WORDS:
        rx = "(^|[/_.-])(" + "|".join(words) + ")($|[/_.-])"
        extra = f"{product_pattern} IS NULL AND " if name == "product" else ""
        arms.append(f"WHEN {extra}regexp_matches({path}, {quote(rx)}) THEN '{name}'")
    return "CASE " + " ".join(arms) + " ELSE 'other' END"


def clean_url(c: str) -> str:
    bare = f"regexp_replace(replace(trim({c}), '&amp;', '&'), '[?#].*$', '')"
    origin = f"regexp_extract({bare}, '^[A-Za-z]+://[^/]*', 0)"
    path = f"regexp_replace(substring({bare}, length({origin}) + 1), ';[^/]*$', '')"
    return f"(lower({origin}) || CASE WHEN {path} = '' THEN '/' ELSE {path} END)"


def url_key(c: str) -> str:
    return f"lower(rtrim({clean_url(c)}, '/'))"


def relative(key: str, base: str) -> str:
    b = f"lower(rtrim({base}, '/'))"
    return f"CASE WHEN {key} = {b} THEN '' WHEN starts_with({key}, {b} || '/') THEN substring({key}, length({b}) + 2) END"


def segments(path: str) -> str:
    return (f"list_transform(list_filter(string_split({path}, '/'), lambda s: s <> ''), "
            f"lambda s: regexp_replace(s, '\\.html?$', ''))")


def first_rows(source: str, keys: str, order: str) -> str:
    return (f"(SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn_ "
            f"FROM {source}) WHERE rn_ = 1)")


COMPANY = f"""(SELECT TRY_CAST(serial_no AS INT) AS serial_no, {clean('company_name')} AS company_name,
  {brand('company_name')} AS brand, lower({clean('company_site_url')}) AS website FROM {S.sql(S.COMPANIES)})"""

PRODUCTS = f"""(SELECT CAST(serial_no AS INT) AS serial_no, url, relative_path,
  {category_case('relative_path', 0)} AS category, {category_case('relative_path', 1)} AS segment
  FROM {S.sql(S.SITE_URLS)} WHERE page_type = 'product'
  AND NOT regexp_matches(relative_path, {quote(presets.NOT_PRODUCT_PATTERN)}))"""

ON_SITE = f"""(SELECT p.* FROM {S.sql(S.SITE_PAGES)} p JOIN {S.sql(S.SCRAPE_STATUS)} s ON p.serial_no = s.serial_no
  WHERE p.fetch_status = 'ok' AND starts_with(lower(final_url), regexp_replace(lower(base_url), '/$', '')))"""

CLEAN_PAGES = f"""(SELECT * REPLACE (CAST(serial_no AS INT) AS serial_no) FROM
  {first_rows(ON_SITE, "serial_no, coalesce(body_text, url)", "url")})"""

CATEGORIES = f"""(SELECT c.serial_no, company_name, brand, segment, category, product_pages, example_url FROM
  (SELECT serial_no, segment, category, count(DISTINCT url) AS product_pages, min(url) AS example_url
   FROM {PRODUCTS} WHERE category IS NOT NULL GROUP BY serial_no, segment, category) r JOIN {COMPANY} c ON c.serial_no = r.serial_no)"""


def theme_sql(words: dict) -> list:
    return [f"sum(CASE WHEN regexp_matches(body_text, {quote(rx)}) THEN 1 ELSE 0 END)" for rx in words.values()]


def mentions(pages: str, words: dict, min_words: int, min_pages: int) -> str:
    counts = ", ".join(f"{s} AS t{i}" for i, s in enumerate(theme_sql(words)))
    values = ", ".join(f"({i}, {quote(n)})" for i, n in enumerate(words))
    pick = "CASE theme_id " + " ".join(f"WHEN {i} THEN t{i}" for i in range(len(words))) + " END"
    return f"""(SELECT c.serial_no, company_name, brand, CAST(theme_id AS INT) AS theme_id, theme, coalesce(n, 0) AS text_pages,
      CASE WHEN n >= {min_pages} THEN CAST({pick} AS BIGINT) END AS pages_mentioning,
      CASE WHEN n >= {min_pages} THEN round(100.0 * {pick} / n, 1) END AS pct_pages, coalesce(n, 0) >= {min_pages} AS has_data
      FROM {COMPANY} c CROSS JOIN (VALUES {values}) AS v(theme_id, theme)
      LEFT JOIN (SELECT serial_no, count(*) AS n, {counts} FROM {pages} WHERE word_count >= {min_words} GROUP BY serial_no) k
      ON k.serial_no = c.serial_no)"""


TECH = mentions(CLEAN_PAGES, presets.TECH_THEMES, presets.MIN_WORDS, presets.MIN_TEXT_PAGES)


def news_counts_sql(years: list) -> str:
    listed = ", ".join(map(str, years))
    return f"""(SELECT CAST(serial_no AS INT) AS serial_no, CAST(y AS INT) AS year, count(DISTINCT url) AS news_pages FROM
      (SELECT *, regexp_extract(relative_path, '(^|/)((19|20)[0-9][0-9])(/|-|$)', 2) AS y FROM {S.sql(S.SITE_URLS)} WHERE page_type = 'news')
      WHERE y <> '' AND CAST(y AS INT) IN ({listed}) GROUP BY serial_no, y)"""


def news_sql(years: list) -> str:
    values = ", ".join(f"({y})" for y in years)
    return f"""(SELECT c.serial_no, company_name, brand, CAST(v.year AS INT) AS year, coalesce(n.news_pages, 0) AS news_pages
      FROM (SELECT DISTINCT serial_no FROM {news_counts_sql(years)}) k CROSS JOIN (VALUES {values}) AS v(year)
      JOIN {COMPANY} c ON c.serial_no = k.serial_no LEFT JOIN {news_counts_sql(years)} n ON n.serial_no = k.serial_no AND n.year = v.year)"""


DIM = f"""(SELECT c.serial_no, c.company_name, brand, website, tagline, hq_address,
  {title_case(clean('city'))} AS city, upper(state) AS state, zip, latitude, longitude, phone, founded_year, address_match,
  phone_match, address_source_url, phone_source_url, s.status AS data_status, {label('s.status', presets.DATA_NOTES)} AS data_note,
  coalesce(n.product_pages, 0) AS product_pages, latitude IS NOT NULL AS has_location
  FROM {COMPANY} c LEFT JOIN {S.sql(S.COMPANY_CONTACTS)} t ON CAST(t.serial_no AS INT) = c.serial_no
  LEFT JOIN {S.sql(S.SCRAPE_STATUS)} s ON CAST(s.serial_no AS INT) = c.serial_no
  LEFT JOIN (SELECT serial_no, {clean('coalesce(meta_description, h1, body_text)')} AS tagline
             FROM {CLEAN_PAGES} WHERE page_type = 'home') h ON h.serial_no = c.serial_no
  LEFT JOIN (SELECT serial_no, count(DISTINCT url) AS product_pages FROM {PRODUCTS} GROUP BY serial_no) n ON n.serial_no = c.serial_no)"""


def last_segment(path: str) -> str:
    return f"regexp_replace(list_extract(string_split({path}, '/'), -1), '\\.html?$', '')"


def product_name(h1: str, path: str) -> str:
    code = f"regexp_extract({last_segment(path)}, '-([a-z0-9]{{6,}})$', 1)"
    slug = (f"CASE WHEN regexp_matches({code}, '[0-9]') AND regexp_matches({code}, '[a-z]') "
            f"THEN {last_segment(path)}[:-2 - length({code})] ELSE {last_segment(path)} END")
    from_path = title_case(f"regexp_replace({slug}, '[-_]+', ' ', 'g')")
    return clean(f"coalesce(regexp_replace({h1}, '\\s*[|].*$', ''), {from_path})")


ELECTRIC_ROWS = f"""(SELECT p.serial_no, {product_name('h.h1', 'relative_path')} AS product_name, coalesce(category, 'Other') AS category,
  coalesce(segment, 'Other') AS segment, p.url, CASE WHEN h.h1 IS NULL THEN 'page address' ELSE 'page heading' END AS name_source
  FROM {PRODUCTS} p LEFT JOIN {S.sql(S.PRODUCT_PAGES)} h ON h.serial_no = p.serial_no AND h.url = p.url
  WHERE (regexp_matches(relative_path, {quote(presets.ELECTRIC_PATH_PATTERN)})
         OR regexp_matches(coalesce(h.h1, ''), {quote(presets.ELECTRIC_HEADING_PATTERN)}))
  AND NOT regexp_matches({last_segment('relative_path')}, {quote(presets.ELECTRIC_LANDING_PATTERN)}))"""

ELECTRIC = f"""(SELECT c.serial_no, company_name, brand, product_name, segment, category, url, name_source
  FROM {first_rows(ELECTRIC_ROWS, "serial_no, lower(product_name)", "url")} e JOIN {COMPANY} c ON c.serial_no = e.serial_no)"""
