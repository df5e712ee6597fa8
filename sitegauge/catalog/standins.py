"""Company, page, log and contact tables derived from the given tables.

The given tables hold no company websites, so each input of an operator is derived from them by
plain SQL that Spark and the checking engine both run.  The derivation only shapes inputs; every
rule under test is written separately in Spark and in the checking SQL.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession

from sitegauge.sources.staging import new_folder
from sitegauge.sources.tables import read_parquet

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

SECTIONS = ("mini-excavators,excavators,skid-steers,backhoes,wheel-loaders,dozers,motor-graders,dump-trucks,"
            "telehandlers,compactors,tillage-rollers,scissor-lifts,engine-powered-lifts,engines,cranes,pavers,"
            "trenchers,generators,tractors,combines,balers,feed-mixers,planters,sprayers,precision-ag,"
            "electric-mowers,utility-vehicles,stump-cutters,mining-shovels,attachments,compare,parts,"
            "battery-loaders,gizmos,used,custom")

COMPANIES = """
SELECT CAST(s_suppkey AS STRING) AS serial_no,
       CASE s_suppkey % 4 WHEN 0 THEN 'The ' || s_name || '  Company'
                          WHEN 1 THEN ' ' || s_name || ' Tractor Corporation '
                          WHEN 2 THEN s_name || ' North America'
                          ELSE s_name END AS company_name,
       'HTTPS://www.Site' || CAST(s_suppkey AS STRING) || '.example.com/' AS company_site_url
FROM {supplier}
"""

# One product or news address per line item.
SITE_URLS = f"""
SELECT serial_no, 'https://www.site' || serial_no || '.example.com/' || relative_path AS url, relative_path,
       CASE WHEN is_news THEN 'news' ELSE 'product' END AS page_type, p_partkey, p_name
FROM (SELECT CAST(l_suppkey AS STRING) AS serial_no, p_partkey, p_name, l_linenumber % 5 = 0 AS is_news,
             CASE WHEN l_linenumber % 5 = 0
                  THEN 'news/' || CAST(year(l_shipdate) AS STRING) || '/' || replace(p_name, ' ', '-') || '-' || CAST(l_orderkey AS STRING)
                  ELSE 'products/' || split_part('{SECTIONS}', ',', CAST(l_partkey % 36 AS INT) + 1) || '/'
                       || replace(p_name, ' ', '-') || '-' || replace(lower(p_brand), '#', '') || 'x' END AS relative_path
      FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey)
"""

# Headings of some product pages.
PRODUCT_PAGES = f"""
SELECT DISTINCT CAST(serial_no AS INT) AS serial_no, url,
       CASE p_partkey % 5 WHEN 0 THEN p_name || ' Battery | Brand' WHEN 1 THEN p_name || ' Large' ELSE NULL END AS h1
FROM ({SITE_URLS}) WHERE page_type = 'product' AND p_partkey % 2 = 0
"""

# One page with text per document; a source is a site, its first document is the home page.
SITE_PAGES = """
SELECT serial_no, base || path AS url,
       CASE WHEN doc_id % 19 = 3 THEN 'https://elsewhere.example.net/' || path ELSE base || path END AS final_url,
       page_type, CASE WHEN doc_id % 17 = 5 THEN 'http_error' ELSE 'ok' END AS fetch_status,
       CASE WHEN doc_id % 2 = 0 THEN regexp_extract(text, '^[^.!?]*[.!?]?', 0) END AS meta_description,
       CASE WHEN doc_id % 3 = 0 THEN regexp_extract(text, '^[^.!?]*[.!?]?', 0) || ' | Site' END AS h1,
       CASE WHEN doc_id % 29 <> 7 THEN text || CASE doc_id % 9
            WHEN 0 THEN ' Our electric battery range.' WHEN 1 THEN ' Autonomous and driverless work.'
            WHEN 2 THEN ' Fleet Management by telematics' WHEN 3 THEN ' GPS grade control'
            WHEN 4 THEN ' hydrogen, HVO and biodiesel' WHEN 5 THEN ' Tier 4 engine emissions'
            WHEN 6 THEN ' sustainable net zero carbon' ELSE '' END END AS body_text,
       CAST(floor(n_chars / 6) AS INT) AS word_count, doc_id
FROM (SELECT d.*, substring(d.source, 4, 9) AS serial_no, 'https://www.site' || substring(d.source, 4, 9) || '.example.com/' AS base,
             CASE WHEN h.home_id IS NOT NULL THEN 'home' WHEN d.doc_id % 10 = 1 THEN 'about' ELSE 'other' END AS page_type,
             CASE WHEN h.home_id IS NOT NULL THEN '' ELSE 'page/' || CAST(d.doc_id AS STRING) END AS path
      FROM {documents} d LEFT JOIN (SELECT min(doc_id) AS home_id FROM {documents} GROUP BY source) h ON d.doc_id = h.home_id
      WHERE d.source IS NOT NULL)
"""

SCRAPE_STATUS = """
SELECT CAST(s_suppkey AS STRING) AS serial_no, 'https://www.Site' || CAST(s_suppkey AS STRING) || '.example.com/' AS base_url,
       split_part('ok,partial,js_rendered,captcha,blocked,error,paused', ',', CAST(s_suppkey % 7 AS INT) + 1) AS status
FROM {supplier} WHERE s_suppkey % 11 <> 10
"""

COMPANY_CONTACTS = """
SELECT CAST(s_suppkey AS STRING) AS serial_no, s_name AS company_name,
       lower(n_name) || ', tx ' || lpad(CAST(s_suppkey % 90000 AS STRING), 5, '0') AS hq_address,
       'port  ' || lower(r_name) AS city, 'tx' AS state, lpad(CAST(s_suppkey % 90000 AS STRING), 5, '0') AS zip,
       CASE WHEN s_suppkey % 5 <> 0 THEN s_acctbal / 200 END AS latitude,
       CASE WHEN s_suppkey % 5 <> 0 THEN -s_acctbal / 100 END AS longitude,
       CASE WHEN s_suppkey % 3 <> 0 THEN '212-555-' || lpad(CAST(s_suppkey % 10000 AS STRING), 4, '0') END AS phone,
       CASE WHEN s_suppkey % 4 = 1 THEN CAST(1900 + s_suppkey % 100 AS INT) END AS founded_year,
       'structured data' AS address_match, 'phone link' AS phone_match,
       'https://a.example.com/' AS address_source_url, 'https://p.example.com/' AS phone_source_url
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
WHERE s_suppkey % 13 <> 12
"""

# One contact page per customer; 50 sites, customer 0..49 mod 50.  The facts are separate columns
# so that the checking SQL knows what the text says.
CONTACT_PAGES = """
SELECT c_custkey, CAST(c_custkey % 50 AS STRING) AS serial_no,
       'https://www.site' || CAST(c_custkey % 50 AS STRING) || '.example.com/' ||
       CASE c_custkey % 3 WHEN 0 THEN 'contact/' WHEN 1 THEN 'models/' ELSE 'team/' END || CAST(c_custkey AS STRING) AS url,
       intro || street || ' ' || city || ', ' || state || ' ' || zip || '. ' || mid || phone_text || ' for more.' AS text,
       intro, street, city, state, code, zip, phone, phone_text, mid, kind
FROM (SELECT *, CASE kind WHEN 0 THEN 'Our headquarters is at 1 ' WHEN 1 THEN 'You find us at 22 ' ELSE 'Write to PO 7 ' END AS intro,
             CASE kind WHEN 1 THEN 'Fax: ' WHEN 2 THEN 'Corporate office phone ' ELSE 'Call ' END AS mid,
             split_part('Market Street,River Green Parkway,St. N.,Lyndale Avenue South', ',', CAST(c_custkey % 4 AS INT) + 1) AS street,
             split_part('Duluth,Wahpeton,Bloomington,Racine,Moline', ',', CAST(c_custkey % 5 AS INT) + 1) AS city,
             split_part('TX,Ohio,North Dakota,CA,West Virginia,GA', ',', CAST(c_custkey % 6 AS INT) + 1) AS state,
             split_part('TX,OH,ND,CA,WV,GA', ',', CAST(c_custkey % 6 AS INT) + 1) AS code,
             CAST(10000 + c_custkey % 80000 AS STRING) AS zip,
             CAST(200 + c_custkey % 700 AS STRING) || '-555-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') AS phone,
             '+1 (' || CAST(200 + c_custkey % 700 AS STRING) || ') 555-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') AS phone_text
      FROM (SELECT *, CAST(floor(c_custkey / 50) AS BIGINT) % 4 AS kind FROM {customer}))
"""

# ZIP codes for the contact pages: every third is in another state, every fifth is unknown.
GAZETTEER = """
SELECT CAST(10000 + c_custkey AS STRING) AS zip,
       CASE WHEN c_custkey % 3 = 1 THEN 'AK' ELSE split_part('TX,OH,ND,CA,WV,GA', ',', CAST(c_custkey % 6 AS INT) + 1) END AS state,
       c_acctbal / 100 AS latitude, -c_acctbal / 50 AS longitude,
       split_part('Duluth,Wahpeton,Bloomington,Racine,Moline', ',', CAST(c_custkey % 5 AS INT) + 1) AS geocoded_city,
       'Place ' || CAST(c_custkey AS STRING) AS geocoded_place
FROM {customer} WHERE c_custkey % 5 <> 4
"""

PREVIOUS = """
SELECT CAST(10000 + c_custkey AS STRING) AS zip, split_part('TX,OH,ND,CA,WV,GA', ',', CAST(c_custkey % 6 AS INT) + 1) AS state,
       CASE WHEN c_custkey % 7 <> 0 THEN 1.5 END AS latitude, 2.5 AS longitude, 'Earlier' AS geocoded_city, 'Earlier place' AS geocoded_place
FROM {customer} WHERE c_custkey % 2 = 0
"""

ADDRESSES = """
SELECT CAST(c_custkey AS STRING) AS serial_no, CAST(10000 + c_custkey AS STRING) AS zip,
       split_part('TX,OH,ND,CA,WV,GA', ',', CAST(c_custkey % 6 AS INT) + 1) AS state
FROM {customer}
"""

# Events as the log of a crawl: a user is a site, an error a hard failure, the value the words.
FETCH_LOG = """
SELECT CAST(user_id AS STRING) AS serial_no, event_id, ts AS scraped_at,
       CASE event_type WHEN 'signup' THEN 'about' WHEN 'click' THEN 'product' ELSE 'other' END AS page_type,
       CASE WHEN event_type IN ('error', 'purchase') THEN 'error' ELSE 'ok' END AS fetch_status,
       CASE WHEN event_type = 'error' THEN 503 ELSE 200 END AS http_status,
       CAST(floor(value / 2) AS INT) AS word_count
FROM {events}
"""

# Pages as crawl candidates of their host, the language folder being the base address.
PAGE_SITES = """
SELECT DISTINCT regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM {pages}
"""

PAGE_URLS = """
SELECT page_id, url, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
       regexp_extract(url, '^(https?://[^/]+/[a-z]+)/', 1) || '/' AS base_url, html
FROM {pages}
"""

# Paths that try every page type, one per line item.
TYPED_PATHS = """
SELECT l_orderkey, l_linenumber, l_partkey,
       split_part('news/2024,careers,dealer-locator,parts,about-us,products/loaders,machines,docs,blogs/products,legal,de-de,wheel-loaders', ',',
                  CAST(l_partkey % 12 AS INT) + 1) || '/' || replace(p_name, ' ', '-') ||
       CASE CAST(floor(l_partkey / 12) AS BIGINT) % 5 WHEN 0 THEN '.pdf' WHEN 1 THEN '.html' WHEN 2 THEN '/' ELSE '' END AS path
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""

SITEMAPS = """
SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS site, page_id AS file_order, url, page_id,
       CASE WHEN page_id % 4 = 3 THEN url || chr(10) || '  ' || url || '/print  ' || chr(13) || chr(10) || 'not an address'
            WHEN page_id % 4 = 2 THEN '<sitemapindex><sitemap><loc>' || url || '/map.xml</loc></sitemap></sitemapindex>'
            ELSE '<urlset><url><loc>' || replace(url, '&', '&amp;') || '</loc><lastmod>2024-01-' || lpad(CAST(page_id % 28 + 1 AS STRING), 2, '0')
                 || '</lastmod></url><sm:url><sm:loc><![CDATA[ ' || regexp_extract(url, '^https?://[^/]+', 0) || '/start ]]></sm:loc></sm:url></urlset>' END AS text,
       CASE WHEN page_id % 6 = 5 THEN 'timeout' END AS error
FROM {pages}
"""

# One robots.txt per host, written from what its pages look like.
ROBOTS = """
SELECT host, CASE WHEN n % 7 = 3 THEN 403 WHEN n % 7 = 4 THEN 404 ELSE 200 END AS http_status,
       '# rules' || chr(10) || 'User-agent: otherbot' || chr(10) || 'Disallow: /' || chr(10) || chr(10)
       || 'User-agent: *' || chr(10) || 'Allow: /fr/1' || chr(10) || CASE WHEN has_fr = 1 THEN 'Disallow: /fr/ # french' || chr(10) ELSE '' END
       || 'Disallow: /es/' || chr(10) || 'Crawl-delay: 10' || chr(10) || chr(10)
       || CASE WHEN has_de = 1 THEN 'User-agent: GaugeBot' || chr(10) || 'User-agent: second' || chr(10) || 'Disallow: /en/' || chr(10) ELSE '' END
       || 'Sitemap: https://' || host || '/map.xml' AS text, n, has_fr, has_de
FROM (SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, count(*) AS n,
             max(CASE WHEN url LIKE '%/fr/%' THEN 1 ELSE 0 END) AS has_fr, max(CASE WHEN url LIKE '%/de/%' THEN 1 ELSE 0 END) AS has_de
      FROM {pages} GROUP BY regexp_extract(url, '^https?://([^/]+)', 1))
"""

# The given pages with the head and body fields that they lack.
RICH_PAGES = """
SELECT page_id, url, CASE page_id % 12 WHEN 3 THEN NULL WHEN 4 THEN 403 WHEN 5 THEN 404 ELSE 200 END AS http_status,
       CASE WHEN page_id % 12 = 6 THEN 'application/pdf' ELSE 'Text/HTML; charset=utf-8' END AS content_type,
       regexp_extract(url, '^(https?://[^/]+)', 1) || '/' AS base_url,
       replace(replace(CASE WHEN page_id % 12 = 7 THEN '<html><head><title>Access Denied</title></head><body><article>short</article></body></html>' ELSE html END,
         '</head>', CASE WHEN page_id % 3 = 0 THEN '<meta content="About &quot;page&quot; ' || CAST(page_id AS STRING) || '" name="Description">'
                         WHEN page_id % 3 = 1 THEN '<meta property="og:description" content=" Shared  text ' || CAST(page_id AS STRING) || '">' ELSE '' END
              || '<script type="application/ld+json">{{"@type":"Organization","telephone":"+1-212-555-' || lpad(CAST(page_id % 10000 AS STRING), 4, '0')
              || '","address":{{"addressLocality":"Racine","addressRegion":"Wisconsin","postalCode":"' || CAST(10000 + page_id AS STRING) || '"}}}}</script></head>'),
         '<article>', '<main><article><h2>First ' || CAST(page_id AS STRING) || '</h2><a href="tel:+1 (414) 555-' || lpad(CAST(page_id % 10000 AS STRING), 4, '0')
              || '">call</a><h3> Second&nbsp;one </h3><h2></h2>') AS html
FROM {pages}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def frame(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    """Run a template on the tables of a folder."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in template}
    return spark.sql(template, **used)


def sql(template: str) -> str:
    """The template as text for the checking engine, in brackets."""
    return "(" + template.format(**{t: t for t in TABLES}).strip() + ")"


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors reach."""
    return new_folder(spark, "sitegauge")


def scratch_table(spark: SparkSession, name: str) -> str:
    """Name of a new table in a database whose folder all executors reach."""
    database = f"sitegauge_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{new_folder(spark, database)}'")
    return f"{database}.{name}"
