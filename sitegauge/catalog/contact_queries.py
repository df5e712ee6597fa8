"""Phone numbers, addresses, founding years and the choice of the best evidence."""

from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.catalog import checks as K
from sitegauge.catalog import standins as S
from sitegauge.catalog.registry import register
from sitegauge.functions import contacts as C
from sitegauge.functions import text as X
from sitegauge.operators import evidence as E
from sitegauge.operators.joins import spread_rows
from sitegauge.plans import silver as P

YEAR = 2026
SQL_PAGES = S.sql(S.CONTACT_PAGES)
# What the derived texts say, spelled out.
BEFORE_PHONE = "intro || street || ' ' || city || ', ' || state || ' ' || zip || '. ' || mid"
PHONE_CONTEXT = f"right({BEFORE_PHONE}, 80) || '[[' || phone_text || ']]' || ' for more.'"
ADDRESS_TEXT = "street || ' ' || city || ', ' || state || ' ' || zip"
ADDRESS_VALUE = "street || ' ' || city || ', ' || code || ' ' || zip"
ADDRESS_CONTEXT = f"intro || '[[' || {ADDRESS_TEXT} || ']]' || substring('. ' || mid || phone_text || ' for more.', 1, 80)"


def texts(spark, sf):
    """The contact pages, dealt over all tasks before their texts are searched."""
    return spread_rows(S.frame(spark, sf, S.CONTACT_PAGES))


def mined(df, keys, found):
    """The contacts of each page, searched for once: an explode of the expression itself would also search for its filters."""
    return df.select(*keys, X.in_place(found).alias("found"))


def flat(df, keys):
    df = mined(df, keys, "found")
    return df.select(*keys, F.explode("found").alias("c")).select(*keys, "c.value", "c.context", "c.source")


@register("extract_text_phones", f"SELECT c_custkey, phone AS value, {PHONE_CONTEXT} AS context, 'text' AS source FROM {SQL_PAGES}")
def extract_text_phones(spark, sf):
    return flat(texts(spark, sf).select("c_custkey", C.extract_text_phones("text").alias("found")), ["c_custkey"])


DOC_PHONES = r"""(SELECT doc_id, CAST(substring(source, 4, 9) AS INT) AS site, 'https://a.example.com/' || CASE doc_id % 4 WHEN 0 THEN 'contact/' ELSE 'p/' END || CAST(doc_id AS VARCHAR) AS url,
  unnest(regexp_extract_all(' ' || t || ' ', '[^0-9-]((?:\+?1[ .-])?\(?[2-9][0-9][0-9]\)?[ .-]{1,2}[2-9][0-9][0-9][ .-][0-9]{4})(?:$|[^0-9-])', 1)) AS m
  FROM (SELECT doc_id, source, """ + K.squeeze("text") + r""" AS t FROM documents))"""


@register("document_phones", f"SELECT doc_id, right(regexp_replace(m, '[^0-9]', '', 'g'), 10) AS digits FROM {DOC_PHONES}")
def document_phones(spark, sf):
    """All phone numbers of all documents, whole texts."""
    found = S.table(spark, sf, "documents").select("doc_id", C.extract_text_phones(X.squeeze("text")).alias("found"))
    return flat(found, ["doc_id"]).select("doc_id", F.replace("value", F.lit("-"), F.lit("")).alias("digits"))


LINKS = f"""(SELECT c_custkey, unnest([CASE WHEN c_custkey % 3 = 0 THEN 'TEL:' ELSE 'tel:' END || phone_text, 'https://a.example.com/tel:1', 'tel:12', 'tel:1-' || phone]) AS link, phone FROM {SQL_PAGES})"""


def links():
    tel = F.when(F.col("c_custkey") % 3 == 0, F.lit("TEL:")).otherwise(F.lit("tel:"))
    return F.array(F.concat(tel, "phone_text"), F.lit("https://a.example.com/tel:1"), F.lit("tel:12"), F.concat(F.lit("tel:1-"), "phone"))


@register("extract_tel_links", f"SELECT c_custkey, phone AS value, link AS context, 'tel_link' AS source FROM {LINKS} WHERE lower(link) LIKE 'tel:%' AND length(link) > 8")
def extract_tel_links(spark, sf):
    return flat(texts(spark, sf).select("c_custkey", C.extract_tel_links(links()).alias("found")), ["c_custkey"])


@register("extract_text_addresses", f"""SELECT c_custkey, {ADDRESS_VALUE} AS value, {ADDRESS_CONTEXT} AS context, 'text' AS source FROM {SQL_PAGES}""")
def extract_text_addresses(spark, sf):
    return flat(texts(spark, sf).select("c_custkey", C.extract_text_addresses("text").alias("found")), ["c_custkey"])


# Two blocks per customer; the second has no locality, or lacks the region as well.
BLOCK_1 = """'{"@type":"Place","telephone" : "+1 ' || phone || '", "addressLocality":"' || city || '","addressRegion":"' || state || '","postalCode":"' || zip || '-0001"}'"""
BLOCK_2 = """'{"telephone":"n/a","postalCode":"' || zip || '"' || CASE WHEN c_custkey % 2 = 0 THEN ',"addressRegion":"TX"}' ELSE '}' END"""


def blocks():
    first = F.concat(F.lit('{"@type":"Place","telephone" : "+1 '), "phone", F.lit('", "addressLocality":"'), "city", F.lit('","addressRegion":"'),
                     "state", F.lit('","postalCode":"'), "zip", F.lit('-0001"}'))
    second = F.concat(F.lit('{"telephone":"n/a","postalCode":"'), "zip",
                      F.when(F.col("c_custkey") % 2 == 0, F.lit('","addressRegion":"TX"}')).otherwise(F.lit('"}')))
    return F.array(first, second)


@register("extract_jsonld_phones", f"SELECT c_custkey, phone AS value, {BLOCK_1} AS context, 'json_ld' AS source FROM {SQL_PAGES}")
def extract_jsonld_phones(spark, sf):
    return flat(texts(spark, sf).select("c_custkey", C.extract_jsonld_phones(blocks()).alias("found")), ["c_custkey"])


@register("extract_jsonld_addresses", f"""SELECT c_custkey, city || ', ' || code || ' ' || zip AS value, {BLOCK_1} AS context, 'json_ld' AS source FROM {SQL_PAGES}
  UNION ALL SELECT c_custkey, 'TX ' || zip, {BLOCK_2}, 'json_ld' FROM {SQL_PAGES} WHERE c_custkey % 2 = 0""")
def extract_jsonld_addresses(spark, sf):
    return flat(texts(spark, sf).select("c_custkey", C.extract_jsonld_addresses(blocks()).alias("found")), ["c_custkey"])


@register("contacts_first_wins", f"""SELECT c_custkey, CAST(0 AS INT) AS position, phone AS value, 'text' AS source FROM {SQL_PAGES}""")
def contacts_first_wins(spark, sf):
    """Text, link and JSON-LD all hold the same number; the text is first."""
    found = C.page_phones("text", links(), blocks())
    return (mined(texts(spark, sf), ["c_custkey"], found).select("c_custkey", F.posexplode("found").alias("position", "c"))
            .select("c_custkey", "position", "c.value", "c.source"))


HQ = "(kind = 0)"
ADDRESS_SCORE = f"CASE WHEN {HQ} THEN 3 WHEN url LIKE '%/contact/%' THEN 1 ELSE 0 END"
ADDRESS_MATCH = f"CASE WHEN {HQ} THEN 'stated headquarters' WHEN url LIKE '%/contact/%' THEN 'contact or about page' ELSE 'most frequent on site' END"


def address_rows(spark, sf):
    keys = ["c_custkey", "serial_no", "url"]
    return flat(texts(spark, sf).select(*keys, C.extract_text_addresses("text").alias("found")), keys)


def phone_rows(spark, sf):
    keys = ["c_custkey", "serial_no", "url"]
    return flat(texts(spark, sf).select(*keys, C.extract_text_phones("text").alias("found")), keys)


@register("score_address", f"SELECT c_custkey, {ADDRESS_SCORE} AS score, {ADDRESS_MATCH} AS match FROM {SQL_PAGES}")
def score_address(spark, sf):
    return address_rows(spark, sf).select("c_custkey", C.score_address("context", "source", "url").alias("s")).select("c_custkey", "s.*")


# The words in front of a number are the last 80 characters, so "headquarters" may be too far away.
PHONE_BEFORE = f"right({BEFORE_PHONE}, 80)"
PHONE_HQ = f"(kind = 2 OR {PHONE_BEFORE} LIKE '%headquarters%')"
PHONE_SCORE = f"CASE WHEN {PHONE_HQ} THEN 3 WHEN url LIKE '%/contact/%' THEN 1 ELSE 0 END"
PHONE_MATCH = f"CASE WHEN {PHONE_HQ} THEN 'stated headquarters' WHEN url LIKE '%/contact/%' THEN 'contact or about page' ELSE 'most frequent on site' END"


@register("score_phone", f"SELECT c_custkey, {PHONE_SCORE} AS score, {PHONE_MATCH} AS match FROM {SQL_PAGES} WHERE kind <> 1")
def score_phone(spark, sf):
    scored = phone_rows(spark, sf).select("c_custkey", C.score_phone("context", "source", "url").alias("s"))
    return scored.where(F.col("s").isNotNull()).select("c_custkey", "s.*")


def picked(rows: str) -> str:
    """Best value per site out of (serial_no, value, score, match, url, context)."""
    return f"""(SELECT serial_no, value, score, pages, match, url, context FROM (SELECT *, row_number() OVER (PARTITION BY serial_no ORDER BY score DESC, pages DESC, value) AS n
      FROM (SELECT serial_no, value, url, context, match, score, count(DISTINCT url) OVER (PARTITION BY serial_no, value) AS pages,
            row_number() OVER (PARTITION BY serial_no, value ORDER BY score DESC, url, context) AS k FROM {rows}) WHERE k = 1) WHERE n = 1)"""


ADDRESS_PICK = picked(f"(SELECT serial_no, {ADDRESS_VALUE} AS value, {ADDRESS_SCORE} AS score, {ADDRESS_MATCH} AS match, url, {ADDRESS_CONTEXT} AS context FROM {SQL_PAGES})")
PHONE_PICK = picked(f"(SELECT serial_no, phone AS value, {PHONE_SCORE} AS score, {PHONE_MATCH} AS match, url, {PHONE_CONTEXT} AS context FROM {SQL_PAGES} WHERE kind <> 1)")


@register("pick_best_evidence", f"SELECT * FROM {ADDRESS_PICK}")
def pick_best_evidence(spark, sf):
    return E.pick_best_evidence(address_rows(spark, sf), C.score_address("context", "source", "url"))


DOC_PICK = picked(r"""(SELECT CAST(site AS VARCHAR) AS serial_no, d[1:3] || '-' || d[4:6] || '-' || d[7:10] AS value, CASE WHEN url LIKE '%contact%' THEN 1 ELSE 0 END AS score,
  CASE WHEN url LIKE '%contact%' THEN 'contact or about page' ELSE 'most frequent on site' END AS match, url, '' AS context
  FROM (SELECT *, right(regexp_replace(m, '[^0-9]', '', 'g'), 10) AS d FROM """ + DOC_PHONES + "))")


@register("document_best_phone", f"SELECT serial_no, value, score, pages, match, url FROM {DOC_PICK}")
def document_best_phone(spark, sf):
    """The best supported phone number of every source, out of the whole document texts."""
    docs = S.table(spark, sf, "documents")
    url = F.concat(F.lit("https://a.example.com/"), F.when(F.col("doc_id") % 4 == 0, F.lit("contact/")).otherwise(F.lit("p/")),
                   F.col("doc_id").cast("string"))
    found = docs.select(F.substring("source", 4, 9).alias("serial_no"), url.alias("url"),
                        F.explode(C.extract_text_phones(X.squeeze("text"))).alias("c")).select("serial_no", "url", "c.*")
    return E.pick_best_evidence(found, C.score_phone("context", "source", "url")).drop("context")


@register("evidence_page_support", f"SELECT serial_no, {ADDRESS_VALUE} AS value, count(DISTINCT url) AS pages FROM {SQL_PAGES} GROUP BY 1, 2")
def evidence_page_support(spark, sf):
    return E.evidence_page_support(address_rows(spark, sf))


@register("phone_next_to_address", f"SELECT c_custkey, CASE WHEN kind <> 1 THEN phone END AS phone FROM {SQL_PAGES}")
def phone_next_to_address(spark, sf):
    return address_rows(spark, sf).select("c_custkey", C.phone_next_to_address("context").alias("phone"))


# Home and about pages that state founding years, one per customer.
FOUNDING = """SELECT c_custkey, CAST(c_custkey % 50 AS STRING) AS serial_no, 'https://f.example.com/' || CAST(c_custkey AS STRING) AS url,
  CASE c_custkey % 3 WHEN 0 THEN 'home' WHEN 1 THEN 'about' ELSE 'news' END AS page_type,
  CASE WHEN c_custkey % 9 = 0 THEN 'Tools since ' || CAST(1900 + c_custkey % 120 AS STRING) END AS title,
  'Established in ' || CAST(1850 + c_custkey % 170 AS STRING) AS meta_description,
  'Acme was founded in 1801. Here we work. ' || CASE c_custkey % 4 WHEN 0 THEN 'We were founded in ' WHEN 1 THEN 'Our plant was established in '
     WHEN 2 THEN 'Our firm, est. ' ELSE 'The US firm, founded ' END || CAST(1790 + c_custkey % 250 AS STRING) || ', serves all.' AS body_text,
  CAST(1900 + c_custkey % 120 AS INT) AS title_year, CAST(1850 + c_custkey % 170 AS INT) AS meta_year, CAST(1790 + c_custkey % 250 AS INT) AS body_year
FROM {customer}"""
STATED = f"""(SELECT serial_no, url, title_year AS y FROM {S.sql(FOUNDING)} WHERE page_type = 'home' AND c_custkey % 9 = 0
  UNION ALL SELECT serial_no, url, meta_year FROM {S.sql(FOUNDING)} WHERE page_type = 'home'
  UNION ALL SELECT serial_no, url, body_year FROM {S.sql(FOUNDING)} WHERE page_type IN ('home', 'about') AND (c_custkey % 4 = 0 OR (c_custkey % 4 = 2 AND FALSE)))"""
# In "Our firm, est. 1920" the period ends a sentence, so only the year before it could count.
FOUNDED_SQL = f"""(SELECT serial_no, y AS founded_year, url AS founded_source_url FROM (SELECT *, row_number() OVER (PARTITION BY serial_no ORDER BY y, url) AS n
  FROM {STATED} WHERE y BETWEEN 1800 AND {YEAR}) WHERE n = 1)"""


def founding_pages(spark, sf):
    return spread_rows(S.frame(spark, sf, FOUNDING))


@register("founded_year", f"SELECT * FROM {FOUNDED_SQL}")
def founded_year(spark, sf):
    return P.founded_year(founding_pages(spark, sf), YEAR)


PREVIOUS_SQL = "(SELECT state, zip, latitude, longitude, geocoded_city, geocoded_place FROM " + S.sql(S.PREVIOUS) + " WHERE latitude IS NOT NULL)"
GEO_COLUMNS = ["latitude", "longitude", "geocoded_city", "geocoded_place"]


def located(addresses: str, keys: str) -> str:
    gazetteer = ", ".join(f"CASE WHEN g.state = a.state THEN g.{c} END AS {c}" for c in GEO_COLUMNS)
    return f"(SELECT {keys}, {gazetteer} FROM {addresses} a LEFT JOIN {S.sql(S.GAZETTEER)} g ON g.zip = a.zip)"


@register("geo_lookup", f"SELECT * FROM {located(S.sql(S.ADDRESSES), 'a.serial_no, a.zip, a.state')}")
def geo_lookup(spark, sf):
    return E.geo_lookup(S.frame(spark, sf, S.ADDRESSES), S.frame(spark, sf, S.GAZETTEER))


def reused(addresses: str, keys: str, plain_keys: str) -> str:
    columns = ", ".join(f"CASE WHEN p.state IS NOT NULL THEN p.{c} ELSE l.{c} END AS {c}" for c in GEO_COLUMNS)
    return f"""(SELECT {plain_keys}, {columns} FROM {located(addresses, keys)} l LEFT JOIN {PREVIOUS_SQL} p ON p.state = l.state AND p.zip = l.zip)"""


@register("geo_cache_reuse", f"SELECT * FROM {reused(S.sql(S.ADDRESSES), 'a.serial_no, a.zip, a.state', 'l.serial_no, l.zip, l.state')}")
def geo_cache_reuse(spark, sf):
    return E.geo_cache_reuse(S.frame(spark, sf, S.ADDRESSES), S.frame(spark, sf, S.PREVIOUS), S.frame(spark, sf, S.GAZETTEER))


@register("missing_locations", f"""SELECT DISTINCT state, zip FROM {S.sql(S.ADDRESSES)} a
  WHERE NOT EXISTS (SELECT 1 FROM {PREVIOUS_SQL} p WHERE p.state = a.state AND p.zip = a.zip)""")
def missing_locations(spark, sf):
    return E.missing_locations(S.frame(spark, sf, S.ADDRESSES), S.frame(spark, sf, S.PREVIOUS))


SITE_NAMES = "SELECT CAST(c_custkey AS STRING) AS serial_no, c_name AS company_name FROM {customer}"
PICKED_ADDRESS = f"""(SELECT serial_no, value, match, url, context, regexp_extract(value, '^(.*?), ', 1) AS raw_city,
  regexp_extract(value, ', ([A-Z][A-Z]) ', 1) AS state, right(value, 5) AS zip FROM {ADDRESS_PICK})"""
ASSEMBLED = f"""(SELECT c.serial_no, c.company_name, a.match, a.url, a.context, l.state, l.zip, l.latitude, l.longitude, l.geocoded_city, l.geocoded_place,
    CASE WHEN raw_city LIKE '%South %' AND 'South ' || coalesce(l.geocoded_city, '') <> regexp_replace(raw_city, '^.*Avenue ', '')
         THEN regexp_replace(raw_city, '^.*Avenue ', '')
         WHEN raw_city LIKE '%South %' THEN l.geocoded_city ELSE regexp_replace(raw_city, '^.* ', '') END AS city,
    CASE WHEN n.kind <> 1 THEN n.phone END AS next_phone, p.value AS p_value, p.match AS p_match, p.url AS p_url, p.context AS p_context,
    f.founded_year, f.founded_source_url
  FROM {S.sql(SITE_NAMES)} c LEFT JOIN {PICKED_ADDRESS} a ON a.serial_no = c.serial_no
  LEFT JOIN {reused(PICKED_ADDRESS, 'a.serial_no, a.zip, a.state', 'l.serial_no, l.zip, l.state')} l ON l.serial_no = c.serial_no
  LEFT JOIN {SQL_PAGES} n ON n.url = a.url
  LEFT JOIN {PHONE_PICK} p ON p.serial_no = c.serial_no LEFT JOIN {FOUNDED_SQL} f ON f.serial_no = c.serial_no)"""


@register("assemble_contacts", f"""SELECT serial_no, company_name, city || ', ' || state || ' ' || zip AS hq_address, city, state, zip, latitude, longitude,
  coalesce(match, 'not found on website') AS address_match, url AS address_source_url, context AS address_context,
  coalesce(next_phone, p_value) AS phone, coalesce(CASE WHEN next_phone IS NOT NULL THEN 'next to address' ELSE p_match END, 'not found on website') AS phone_match,
  CASE WHEN next_phone IS NOT NULL THEN url ELSE p_url END AS phone_source_url, CASE WHEN next_phone IS NOT NULL THEN context ELSE p_context END AS phone_context,
  founded_year, founded_source_url, geocoded_place, geocoded_city FROM {ASSEMBLED}""")
def assemble_contacts(spark, sf):
    """Contacts of all companies: pages with texts and pages with founding years, both per customer."""
    told = texts(spark, sf).select(
        "serial_no", "url", F.lit("other").alias("page_type"), F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("meta_description"), F.lit(None).cast("string").alias("body_text"),
        X.in_place(C.contacts_first_wins(C.extract_text_phones("text"))).alias("contact_phones"),
        X.in_place(C.contacts_first_wins(C.extract_text_addresses("text"))).alias("contact_addresses"))
    none = F.array().cast(C.CONTACT_TYPE)
    founding = founding_pages(spark, sf).select("serial_no", "url", "page_type", "title", "meta_description", "body_text",
                                                   none.alias("contact_phones"), none.alias("contact_addresses"))
    return P.assemble_contacts(S.frame(spark, sf, SITE_NAMES), told.unionByName(founding), S.frame(spark, sf, S.GAZETTEER),
                               S.frame(spark, sf, S.PREVIOUS), YEAR).drop("updated_at")
