"""Address inventory, visit order, crawl outcome, sitemaps and robots rules."""

from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.catalog import checks as K
from sitegauge.catalog import standins as S
from sitegauge.catalog.registry import register
from sitegauge.operators import aggregates as A
from sitegauge.operators import crawl as W
from sitegauge.operators import ranking, streaks
from sitegauge.operators import replay as Y
from sitegauge.plans import silver as P
from sitegauge.sources import robots as B
from sitegauge.sources import sitemaps as M

AGENT = "GaugeBot/1.0"

# --- fetch log -------------------------------------------------------------------------------

LOG_SQL = S.sql(S.FETCH_LOG)


def log(spark, sf):
    return S.frame(spark, sf, S.FETCH_LOG)


def hour():
    """Chunk of the log: its hour, counted from a fixed time."""
    return F.date_trunc("hour", "scraped_at")


@register("page_counts", f"""SELECT serial_no, count(*) AS pages_attempted, count(*) FILTER (WHERE fetch_status = 'ok') AS pages_ok,
  count(*) FILTER (WHERE fetch_status <> 'ok') AS pages_failed FROM {LOG_SQL} GROUP BY serial_no""")
def page_counts(spark, sf):
    return A.page_counts(log(spark, sf), "serial_no")


@register("median_words", f"SELECT serial_no, CAST(trunc(median(word_count)) AS INT) AS median_word_count FROM {LOG_SQL} WHERE fetch_status = 'ok' GROUP BY serial_no")
def median_words(spark, sf):
    return A.median_words(log(spark, sf), "serial_no")


def streak_sql(rows: str, keys: str, bad: str) -> str:
    return f"""(SELECT *, CASE WHEN {bad} THEN row_number() OVER (PARTITION BY {keys}, run ORDER BY scraped_at, event_id) - CASE WHEN run = 0 THEN 0 ELSE 1 END ELSE 0 END AS streak
      FROM (SELECT *, sum(CASE WHEN {bad} THEN 0 ELSE 1 END) OVER (PARTITION BY {keys} ORDER BY scraped_at, event_id ROWS UNBOUNDED PRECEDING) AS run FROM {rows}))"""


FAILED = "(fetch_status = 'error' OR http_status >= 500)"
FAILURES = streak_sql(LOG_SQL, "serial_no", FAILED)
EMPTIES = streak_sql(f"(SELECT * FROM {LOG_SQL} WHERE fetch_status = 'ok')", "serial_no, page_type", "word_count < 20")


@register("running_streak", f"SELECT serial_no, event_id, streak FROM {FAILURES}")
def running_streak(spark, sf):
    runs = streaks.running_streak(log(spark, sf), ["serial_no"], ["scraped_at", "event_id"], streaks.hard_failure(), hour())
    return runs.select("serial_no", "event_id", "streak")


@register("failure_streak", f"SELECT serial_no, max(streak) AS longest_streak, max(streak) >= 5 AS stopped FROM {FAILURES} GROUP BY serial_no")
def failure_streak(spark, sf):
    return streaks.failure_streak(log(spark, sf), "serial_no", ["scraped_at", "event_id"], hour())


@register("empty_type_streak", f"SELECT serial_no, page_type, max(streak) AS longest_streak, max(streak) >= 10 AS skipped FROM {EMPTIES} GROUP BY serial_no, page_type")
def empty_type_streak(spark, sf):
    return streaks.empty_type_streak(log(spark, sf), "serial_no", ["scraped_at", "event_id"], hour()).drop("reached_at")


DURATION = "round((epoch_us(max(scraped_at)) - epoch_us(min(scraped_at))) / 1e6, 1)"


@register("site_duration", f"SELECT serial_no, {DURATION} AS duration_seconds FROM {LOG_SQL} GROUP BY serial_no")
def site_duration(spark, sf):
    return A.site_duration(log(spark, sf), "serial_no").select("serial_no", "duration_seconds")


# The log cut into sites of a day each, so that all outcomes occur; the first page is the start page.
DAY_LOG = """SELECT serial_no, 'u' || CAST(event_id AS STRING) AS url, page_type, CAST(row_number() OVER (PARTITION BY serial_no ORDER BY scraped_at, event_id) - 1 AS INT) AS visit_order,
  fetch_status, http_status, word_count, CAST(NULL AS STRING) AS error, scraped_at
FROM (SELECT CAST(user_id AS STRING) || '/' || CAST(month(ts) AS STRING) || '-' || CAST(day(ts) AS STRING) AS serial_no, event_id, ts AS scraped_at,
        CASE event_type WHEN 'signup' THEN 'about' WHEN 'click' THEN 'product' ELSE 'other' END AS page_type,
        CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'blocked' WHEN event_type = 'error' THEN 'error' WHEN event_id % 41 = 0 THEN 'captcha' ELSE 'ok' END AS fetch_status,
        CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 403 WHEN event_type = 'error' THEN 503 ELSE 200 END AS http_status,
        CAST(floor(value * (1 + user_id % 9)) AS INT) AS word_count FROM {events})"""
DAY_SITES = """SELECT DISTINCT CAST(user_id AS STRING) || '/' || CAST(month(ts) AS STRING) || '-' || CAST(day(ts) AS STRING) AS serial_no,
  'User ' || CAST(user_id AS STRING) AS company_name, 'https://s' || CAST(user_id AS STRING) || '.example.com/' AS base_url,
  'https://s' || CAST(user_id AS STRING) || '.example.com/en/' AS start_url FROM {events}"""
DAY_ROBOTS = """SELECT DISTINCT 's' || CAST(user_id AS STRING) || '.example.com' AS host, CASE user_id % 10 WHEN 7 THEN 403 WHEN 8 THEN 404 ELSE 200 END AS http_status,
  'User-agent: *' || chr(10) || 'Disallow: ' || CASE WHEN user_id % 10 = 6 THEN '/en' ELSE '/private' END AS text FROM {events}"""

DAY_SQL = S.sql(DAY_LOG)
DAY_FACTS = f"""(SELECT s.*, coalesce(attempted, 0) AS pages_attempted, coalesce(ok, 0) AS pages_ok, coalesce(attempted - ok, 0) AS pages_failed, mid, st.fetch_status AS start_status,
    st.http_status AS start_http, coalesce(longest, 0) AS longest, started_at, finished_at, seconds,
    CASE split_part(split_part(base_url, '//s', 2), '.', 1)::BIGINT % 10 WHEN 7 THEN 403 WHEN 8 THEN 404 ELSE 200 END AS robots,
    split_part(split_part(base_url, '//s', 2), '.', 1)::BIGINT % 10 IN (6, 7) AS denied
  FROM {S.sql(DAY_SITES)} s
  LEFT JOIN (SELECT serial_no, count(*) AS attempted, count(*) FILTER (WHERE fetch_status = 'ok') AS ok, median(word_count) FILTER (WHERE fetch_status = 'ok') AS mid,
        min(scraped_at) AS started_at, max(scraped_at) AS finished_at, {DURATION} AS seconds FROM {DAY_SQL} GROUP BY serial_no) c ON c.serial_no = s.serial_no
  LEFT JOIN (SELECT * FROM {DAY_SQL} WHERE visit_order = 0) st ON st.serial_no = s.serial_no
  LEFT JOIN (SELECT serial_no, max(streak) AS longest FROM (SELECT *, CASE WHEN bad THEN row_number() OVER (PARTITION BY serial_no, run ORDER BY visit_order) - CASE WHEN run = 0 THEN 0 ELSE 1 END ELSE 0 END AS streak
      FROM (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY serial_no ORDER BY visit_order ROWS UNBOUNDED PRECEDING) AS run
        FROM (SELECT *, fetch_status IN ('blocked', 'captcha', 'error') OR http_status >= 500 AS bad FROM {DAY_SQL} WHERE visit_order > 0))) GROUP BY serial_no) f ON f.serial_no = s.serial_no)"""


# What the other inputs of the status say: addresses, sitemap files and pages closed by robots rules of each site.
DAY_FOUND = "SELECT DISTINCT CAST(user_id AS STRING) || '/' || CAST(month(ts) AS STRING) || '-' || CAST(day(ts) AS STRING) AS serial_no, value FROM {events}"
DAY_MAPS = """SELECT serial_no, CAST(count(*) FILTER (WHERE value < 50) AS BIGINT) AS sitemap_files_read, CAST(count(*) FILTER (WHERE value >= 50) AS BIGINT) AS sitemap_errors
  FROM (""" + DAY_FOUND + """) WHERE value < 60 GROUP BY serial_no"""
DAY_SKIPPED = "SELECT serial_no, count(*) AS robots_skipped FROM (" + DAY_FOUND + ") WHERE value > 90 GROUP BY serial_no"


def day_status(spark, sf):
    return W.scrape_status(
        S.frame(spark, sf, DAY_SITES), S.frame(spark, sf, DAY_LOG), S.frame(spark, sf, DAY_FOUND), B.robots_policy(S.frame(spark, sf, DAY_ROBOTS), AGENT),
        S.frame(spark, sf, DAY_MAPS), S.frame(spark, sf, DAY_SKIPPED))


STATUS_CASE = """CASE WHEN denied THEN 'blocked' WHEN start_status IN ('blocked', 'captcha') THEN start_status WHEN longest >= 5 THEN 'partial'
  WHEN pages_ok = 0 THEN 'error' WHEN mid < 50 THEN 'js_rendered' WHEN pages_failed > 0.2 * pages_attempted THEN 'partial' ELSE 'ok' END"""


# Types that ran empty, in the order in which they did.
DAY_EMPTY = f"""(SELECT serial_no, string_agg('skipped remaining ' || page_type || ' pages after 10 empty ones', '; ' ORDER BY reached, page_type) AS notes FROM (
    SELECT serial_no, page_type, min(visit_order) AS reached FROM (SELECT *, CASE WHEN word_count < 20 THEN row_number() OVER (PARTITION BY serial_no, page_type, run ORDER BY visit_order) - CASE WHEN run = 0 THEN 0 ELSE 1 END ELSE 0 END AS streak
      FROM (SELECT *, sum(CASE WHEN word_count < 20 THEN 0 ELSE 1 END) OVER (PARTITION BY serial_no, page_type ORDER BY visit_order ROWS UNBOUNDED PRECEDING) AS run
        FROM {DAY_SQL} WHERE visit_order > 0 AND fetch_status = 'ok')) WHERE streak >= 10 GROUP BY serial_no, page_type) GROUP BY serial_no)"""
MESSAGE = """CASE WHEN denied THEN 'robots.txt (HTTP ' || CAST(robots AS VARCHAR) || ') does not allow ' || start_url
    WHEN start_status IN ('blocked', 'captcha') THEN 'start page returned ' || start_status || ' (HTTP ' || CAST(start_http AS VARCHAR) || ')'
    WHEN longest >= 5 THEN 'stopped after 5 failed pages in a row'
    WHEN pages_ok = 0 THEN 'no page could be scraped; start page: ' || start_status || ' (HTTP ' || CAST(start_http AS VARCHAR) || ')'
    WHEN mid < 50 THEN concat_ws('; ', 'pages have little text; content is likely loaded by JavaScript', notes)
    WHEN pages_failed > 0.2 * pages_attempted THEN concat_ws('; ', 'more than 20% of pages failed', notes) ELSE notes END"""
DAY_TOLD = f"(SELECT f.*, notes FROM {DAY_FACTS} f LEFT JOIN {DAY_EMPTY} n ON n.serial_no = f.serial_no)"


@register("site_status", f"SELECT serial_no, {STATUS_CASE} AS status, {MESSAGE} AS message FROM {DAY_TOLD}")
def site_status(spark, sf):
    return day_status(spark, sf).select("serial_no", "status", "message")


@register("scrape_status", f"""SELECT t.serial_no, company_name, base_url, {STATUS_CASE} AS status, {MESSAGE} AS message, CAST(robots AS INT) AS robots_http_status,
  CAST(coalesce(sitemap_files_read, 0) AS INT) AS sitemap_files_read, CAST(coalesce(sitemap_errors, 0) AS INT) AS sitemap_errors,
  CAST(coalesce(urls_found, 0) AS INT) AS urls_found, CAST(coalesce(robots_skipped, 0) AS INT) AS robots_skipped,
  CAST(pages_attempted AS INT) AS pages_attempted, CAST(pages_ok AS INT) AS pages_ok, CAST(pages_failed AS INT) AS pages_failed,
  CAST(trunc(mid) AS INT) AS median_word_count, started_at, finished_at, seconds AS duration_seconds
  FROM {DAY_TOLD} t LEFT JOIN {S.sql(DAY_MAPS)} m ON m.serial_no = t.serial_no LEFT JOIN {S.sql(DAY_SKIPPED)} k ON k.serial_no = t.serial_no
  LEFT JOIN (SELECT serial_no, count(*) AS urls_found FROM {S.sql(DAY_FOUND)} GROUP BY serial_no) u ON u.serial_no = t.serial_no""")
def scrape_status(spark, sf):
    return day_status(spark, sf)


# --- inventory -------------------------------------------------------------------------------

# Sites are the hosts of the pages; the base is the host itself, some paths are excluded.
INVENTORY_SITES = """SELECT DISTINCT regexp_extract(url, '^https?://([^/]+)', 1) AS serial_no, 'http://' || regexp_extract(url, '^https?://([^/]+)', 1) || '/' AS base_url,
  'http://' || regexp_extract(url, '^https?://([^/]+)', 1) || '/en/start' AS start_url, '^es(/|$)' AS exclude, CAST(NULL AS STRING) AS product_pattern, 1 AS category_segment FROM {pages}"""
# All pages under http, a printed copy of some in upper case, and the start pages.
CANDIDATES = """SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS serial_no, replace(url, 'https:', 'http:') AS url, '2024-01-01' AS lastmod, 'sitemap' AS source, 0 AS priority, page_id AS position FROM {pages}
UNION ALL SELECT regexp_extract(url, '^https?://([^/]+)', 1), replace(url, 'https:', 'http:') || '/', NULL, 'links', 2, page_id FROM {pages}
UNION ALL SELECT regexp_extract(url, '^https?://([^/]+)', 1), replace(url, 'https:', 'http:') || '/products/loader?x=' || CAST(page_id AS STRING), NULL, 'links', 2, page_id FROM {pages}
UNION ALL SELECT DISTINCT regexp_extract(url, '^https?://([^/]+)', 1), 'http://' || regexp_extract(url, '^https?://([^/]+)', 1) || '/en/start', CAST(NULL AS STRING), 'start', 1, 0 FROM {pages}"""

KEYED = f"""(SELECT c.*, {K.clean_url('url')} AS cu, {K.url_key('url')} AS k, {K.relative(K.url_key('url'), 'base_url')} AS rel, start_url
  FROM {S.sql(CANDIDATES)} c JOIN {S.sql(INVENTORY_SITES)} s ON s.serial_no = c.serial_no)"""
SCOPED = f"(SELECT * FROM {KEYED} WHERE rel IS NOT NULL AND NOT regexp_matches(rel, '^es(/|$)'))"
INVENTORY = f"""(SELECT serial_no, cu AS url, k AS url_key, rel AS relative_path, page_type, coalesce({K.segments('rel')}[1], '') AS section,
  CASE WHEN typed = 'product' THEN {K.segments('rel')}[2] END AS category, CAST(len({K.segments('rel')}) AS INT) AS depth, lastmod, source
  FROM (SELECT *, CASE WHEN k = {K.url_key('start_url')} THEN 'home' ELSE typed END AS page_type FROM (SELECT *, {K.page_type_case('rel')} AS typed
    FROM {K.first_rows(SCOPED, 'serial_no, k', 'priority, position, cu')})))"""


def inventory(spark, sf):
    return W.url_inventory(S.frame(spark, sf, CANDIDATES), S.frame(spark, sf, INVENTORY_SITES))


@register("url_inventory", f"SELECT * FROM {INVENTORY}")
def url_inventory(spark, sf):
    return inventory(spark, sf)


@register("url_set_union", f"""SELECT serial_no, k AS url_key, source FROM {K.first_rows(
    f"(SELECT serial_no, {K.url_key('url')} AS k, source, priority, position FROM {S.sql(CANDIDATES)})", 'serial_no, k', 'priority, position, source')}""")
def url_set_union(spark, sf):
    from sitegauge.functions.urls import url_key
    rows = S.frame(spark, sf, CANDIDATES).drop("priority")
    stacked = ranking.url_set_union([rows.where(F.col("source") == s) for s in ("sitemap", "start", "links")])
    keyed = stacked.withColumn("url_key", url_key("url"))
    return ranking.first_per_group(keyed, ["serial_no", "url_key"], ["priority", "position", "source"]).select("serial_no", "url_key", "source")


PAGE_LINKS = f"""(SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS serial_no, 'http://' || regexp_extract(url, '^https?://([^/]+)', 1) || unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS url FROM pages)"""


@register("frontier_expand", f"""SELECT DISTINCT serial_no, k AS url_key FROM (SELECT l.serial_no, {K.url_key('l.url')} AS k, {K.relative(K.url_key('l.url'), 'base_url')} AS rel
    FROM {PAGE_LINKS} l JOIN {S.sql(INVENTORY_SITES)} s ON s.serial_no = l.serial_no)
  WHERE rel IS NOT NULL AND NOT regexp_matches(rel, '^es(/|$)') AND k NOT IN (SELECT url_key FROM {INVENTORY})""")
def frontier_expand(spark, sf):
    pages = S.table(spark, sf, "pages")
    page = F.regexp_replace("url", "^https:", "http:")
    links = pages.select(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("serial_no"),
                         F.explode(P.page_links("html", page)).alias("url"))
    return W.frontier_expand(links, inventory(spark, sf), S.frame(spark, sf, INVENTORY_SITES)).select("serial_no", "url_key")


# An inventory of part addresses for the visit order: few sites, thousands of pages each.
PLANNED = """SELECT serial_no, url, lower(url) AS url_key, relative_path, page_type, depth, allowed FROM (
  SELECT CAST(p_size % 7 AS STRING) AS serial_no, 'https://s' || CAST(p_size % 7 AS STRING) || '.example.com/' || path || CAST(p_partkey AS STRING) AS url,
         path || CAST(p_partkey AS STRING) AS relative_path, kind AS page_type, CAST(1 + p_partkey % 4 AS INT) AS depth, p_partkey % 9 <> 4 AS allowed
  FROM (SELECT *, split_part('product,product,about,parts_service,other,news,dealer,careers,document,other', ',', CAST(p_partkey % 10 AS INT) + 1) AS kind,
               split_part('products/,models/,contact-us/,parts/,locations/,news/contact/,dealers/,jobs/,docs/,corporate/', ',', CAST(p_partkey % 10 AS INT) + 1) AS path FROM {part})
  UNION ALL SELECT DISTINCT CAST(p_size % 7 AS STRING), 'https://s' || CAST(p_size % 7 AS STRING) || '.example.com/', '', 'home', 0, TRUE FROM {part})"""
PLAN_ROWS = S.sql(PLANNED)
CONTACT_ROWS = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY serial_no ORDER BY contact_order, depth, url) AS contact_rank
  FROM (SELECT *, CASE WHEN regexp_matches(relative_path, '{presets.CONTACT_FIRST_PATTERN}') THEN 0 ELSE 1 END AS contact_order FROM {PLAN_ROWS}
        WHERE page_type NOT IN ('home', 'document') AND regexp_matches(relative_path, {K.quote(presets.CONTACT_PAGE_PATTERN)})
        AND NOT regexp_matches(relative_path, {K.quote(presets.NOT_CONTACT_PATTERN)}))))"""


@register("contact_pages_first", f"SELECT serial_no, url, CAST(contact_rank AS INT) AS contact_rank FROM {CONTACT_ROWS}")
def contact_pages_first(spark, sf):
    return W.contact_pages_first(S.frame(spark, sf, PLANNED)).select("serial_no", "url", "contact_rank")


PRIORITY = "CASE page_type " + " ".join(f"WHEN '{t}' THEN {i}" for t, i in presets.PAGE_PRIORITY.items()) + " END"
QUEUE = f"""(SELECT serial_no, url, page_type, depth, allowed, min(stage) AS stage, min(place) AS place FROM
  (SELECT serial_no, url, page_type, depth, allowed, 0 AS stage, contact_rank AS place FROM {CONTACT_ROWS}
   UNION ALL SELECT serial_no, url, page_type, depth, allowed, 1, {PRIORITY} FROM {PLAN_ROWS} WHERE {PRIORITY} IS NOT NULL)
  GROUP BY serial_no, url, page_type, depth, allowed)"""
# min(place) mixes ranks and priorities, so a contact page takes its rank again.
ORDERED = f"""(SELECT q.serial_no, q.url, q.page_type, q.depth, q.allowed, q.stage, CASE WHEN q.stage = 0 THEN c.contact_rank ELSE q.place END AS place
  FROM {QUEUE} q LEFT JOIN {CONTACT_ROWS} c ON c.serial_no = q.serial_no AND c.url = q.url)"""
CHOSEN = f"""(SELECT *, row_number() OVER (PARTITION BY serial_no ORDER BY stage, place, depth, url) AS visit_order FROM {ORDERED} WHERE allowed)"""


@register("crawl_plan", f"""SELECT serial_no, url, page_type, CAST(visit_order AS INT) AS visit_order FROM {CHOSEN}
  UNION ALL SELECT serial_no, url, page_type, 0 FROM {PLAN_ROWS} WHERE page_type = 'home'""")
def crawl_plan(spark, sf):
    return W.crawl_plan(S.frame(spark, sf, PLANNED))


@register("robots_skipped", f"SELECT serial_no, count(*) AS robots_skipped FROM {ORDERED} WHERE NOT allowed GROUP BY serial_no")
def robots_skipped(spark, sf):
    rows = S.frame(spark, sf, PLANNED)
    return W.robots_skipped(rows, W.crawl_plan(rows))


# --- the crawl replayed ------------------------------------------------------------------------

# Sites of some forty pages per scale step; how often a page fails or comes empty differs by site.
REPLAYED = """SELECT serial_no, base || path AS url, lower(base || path) AS url_key, path AS relative_path, page_type, depth, p_partkey % 9 <> 4 AS allowed,
  fetch_status, http_status, word_count, CAST(NULL AS STRING) AS error
FROM (SELECT p_partkey, CAST(p_size AS STRING) AS serial_no, 'https://s' || CAST(p_size AS STRING) || '.example.com/' AS base,
        split_part('products/,about-us/,parts/,contact-us/,news/,models/', ',', CAST(p_partkey % 6 AS INT) + 1) || CAST(p_partkey AS STRING) AS path,
        split_part('product,about,parts_service,other,news,product', ',', CAST(p_partkey % 6 AS INT) + 1) AS page_type, CAST(1 + p_partkey % 4 AS INT) AS depth,
        CASE WHEN (p_partkey * 7919 + p_size) % 100 < p_size % 8 * 9 THEN 'error' ELSE 'ok' END AS fetch_status,
        CASE WHEN (p_partkey * 7919 + p_size) % 100 < p_size % 8 * 9 THEN CAST(NULL AS INT) ELSE 200 END AS http_status,
        CAST(CASE WHEN (p_partkey * 104729) % 100 < 98 - p_size % 5 * 20 THEN 7 ELSE 80 END AS INT) AS word_count FROM {part})
UNION ALL SELECT DISTINCT CAST(p_size AS STRING), 'https://s' || CAST(p_size AS STRING) || '.example.com/', 'https://s' || CAST(p_size AS STRING) || '.example.com', '', 'home', 0,
  p_size % 17 <> 5, CASE WHEN p_size % 19 = 7 THEN 'captcha' ELSE 'ok' END, CAST(200 AS INT), CAST(99 AS INT), CAST(NULL AS STRING) FROM {part}"""
REPLAY_ROWS = S.sql(REPLAYED)
# Pages of the sites whose start page is open and was read, in the order of the crawl.
REPLAY_ORDER = f"""(SELECT *, row_number() OVER (PARTITION BY serial_no ORDER BY stage, place, depth, url) AS seq FROM (
    SELECT *, CASE WHEN contact THEN 0 ELSE 1 END AS stage, CASE WHEN contact THEN row_number() OVER (PARTITION BY serial_no, contact ORDER BY CASE WHEN regexp_matches(relative_path, '{presets.CONTACT_FIRST_PATTERN}') THEN 0 ELSE 1 END, depth, url)
      ELSE {PRIORITY} END AS place FROM (SELECT *, page_type NOT IN ('home', 'document') AND regexp_matches(relative_path, {K.quote(presets.CONTACT_PAGE_PATTERN)})
        AND NOT regexp_matches(relative_path, {K.quote(presets.NOT_CONTACT_PATTERN)}) AS contact FROM {REPLAY_ROWS}) WHERE page_type <> 'home')
  WHERE serial_no IN (SELECT serial_no FROM {REPLAY_ROWS} WHERE page_type = 'home' AND allowed AND fetch_status = 'ok'))"""


def run_sql(rows: str, keys: str, bad: str) -> str:
    """Length of the run of bad rows that ends at each row."""
    return f"""(SELECT *, CASE WHEN {bad} THEN row_number() OVER (PARTITION BY {keys}, run ORDER BY seq) - CASE WHEN run = 0 THEN 0 ELSE 1 END ELSE 0 END AS streak
      FROM (SELECT *, sum(CASE WHEN {bad} THEN 0 ELSE 1 END) OVER (PARTITION BY {keys} ORDER BY seq ROWS UNBOUNDED PRECEDING) AS run FROM {rows}))"""


REPLAY_LEFT = f"""(SELECT serial_no, page_type, min(seq) AS left_at FROM {run_sql(f"(SELECT * FROM {REPLAY_ORDER} WHERE allowed AND fetch_status = 'ok')", 'serial_no, page_type', 'word_count < 20')}
  WHERE streak >= 10 GROUP BY serial_no, page_type)"""
REPLAY_KEPT = f"""(SELECT o.* FROM {REPLAY_ORDER} o LEFT JOIN {REPLAY_LEFT} l ON l.serial_no = o.serial_no AND l.page_type = o.page_type WHERE left_at IS NULL OR seq <= left_at)"""
REPLAY_END = f"""(SELECT serial_no, min(seq) AS stop_at FROM {run_sql(f"(SELECT * FROM {REPLAY_KEPT} WHERE allowed)", 'serial_no', "fetch_status = 'error'")} WHERE streak >= 5 GROUP BY serial_no)"""
REPLAY_READ = f"(SELECT k.*, stop_at FROM {REPLAY_KEPT} k LEFT JOIN {REPLAY_END} e ON e.serial_no = k.serial_no WHERE stop_at IS NULL OR seq <= stop_at)"
LEFT_TYPES = f"""(SELECT l.serial_no, string_agg(page_type, ',' ORDER BY left_at) AS skipped_types FROM {REPLAY_LEFT} l LEFT JOIN {REPLAY_END} e ON e.serial_no = l.serial_no
  WHERE stop_at IS NULL OR left_at <= stop_at GROUP BY l.serial_no)"""


def replayed(spark, sf):
    rows = S.frame(spark, sf, REPLAYED)
    return Y.replay(rows.drop(*Y.OUTCOME), rows.select("serial_no", "url_key", *Y.OUTCOME))


@register("crawl_replay", f"""SELECT serial_no, url, page_type, fetch_status, CAST(row_number() OVER (PARTITION BY serial_no ORDER BY seq) AS INT) AS visit_order FROM {REPLAY_READ} WHERE allowed
  UNION ALL SELECT serial_no, url, 'home', fetch_status, 0 FROM {REPLAY_ROWS} WHERE page_type = 'home' AND allowed""")
def crawl_replay(spark, sf):
    """The pages a crawl visits when empty types and failures steer it."""
    return replayed(spark, sf).visits.select("serial_no", "url", "page_type", "fetch_status", "visit_order")


@register("crawl_replay_sites", f"""SELECT h.serial_no, e.stop_at IS NOT NULL AS stopped, coalesce(skipped, 0) AS robots_skipped, coalesce(skipped_types, '') AS skipped_types
  FROM {REPLAY_ROWS} h LEFT JOIN {REPLAY_END} e ON e.serial_no = h.serial_no LEFT JOIN {LEFT_TYPES} t ON t.serial_no = h.serial_no
  LEFT JOIN (SELECT serial_no, count(*) AS skipped FROM {REPLAY_READ} WHERE NOT allowed GROUP BY serial_no) r ON r.serial_no = h.serial_no WHERE h.page_type = 'home'""")
def crawl_replay_sites(spark, sf):
    """How the replayed crawl of each site ended."""
    return replayed(spark, sf).sites.select("serial_no", "stopped", "robots_skipped", F.array_join("skipped_types", ",").alias("skipped_types"))


# --- links in rounds -----------------------------------------------------------------------------

# The pages of a host, numbered, as a tree: page n links to 2n and 2n + 1, the last of a level back to the first page.
TREE = """SELECT host, 'https://' || host || '/n/' || CAST(n AS STRING) AS url, n FROM (
  SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, row_number() OVER (PARTITION BY regexp_extract(url, '^https?://([^/]+)', 1) ORDER BY page_id) AS n FROM {pages})"""
TREE_SITES = """SELECT DISTINCT regexp_extract(url, '^https?://([^/]+)', 1) AS serial_no, 'https://' || regexp_extract(url, '^https?://([^/]+)', 1) || '/' AS base_url,
  'https://' || regexp_extract(url, '^https?://([^/]+)', 1) || '/n/1' AS start_url, CAST(NULL AS STRING) AS exclude, CAST(NULL AS STRING) AS product_pattern, 1 AS category_segment FROM {pages}"""


@register("discover_links", f"""SELECT host AS serial_no, url AS url_key, CAST(floor(log2(n)) AS INT) AS round FROM {S.sql(TREE)} WHERE n < 16
  UNION ALL SELECT host, 'https://' || host || '/n/' || CAST(m AS VARCHAR), CAST(floor(log2(m)) AS INT)
  FROM (SELECT host, max(n) AS top FROM {S.sql(TREE)} GROUP BY host), range(1, 16) AS r(m) WHERE m > top AND m // 2 <= top""")
def discover_links(spark, sf):
    """Three rounds of links from the first page of every host."""
    tree = S.frame(spark, sf, TREE)
    start = F.concat(F.lit("https://"), "host", F.lit("/n/"))
    to = F.array(F.concat(start, (F.col("n") * 2).cast("string")), F.concat(start, (F.col("n") * 2 + 1).cast("string"), F.lit("/?from=x")), F.concat(start, F.lit("1")))
    links = tree.select(F.col("host").alias("serial_no"), F.col("url").alias("page"), F.explode(to).alias("url"))
    sites = S.frame(spark, sf, TREE_SITES)
    return W.discover_links(sites.select("serial_no", F.col("start_url").alias("url")), links, sites, 3).select("serial_no", "url_key", "round")


# --- sitemaps --------------------------------------------------------------------------------

def sitemaps(spark, sf):
    return S.frame(spark, sf, S.SITEMAPS)


FILES = S.sql(S.SITEMAPS)
XML_ROWS = f"""(SELECT site, file_order, 0 AS position, url, '2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') AS lastmod FROM {FILES} WHERE error IS NULL AND page_id % 4 < 2
  UNION ALL SELECT site, file_order, 1, regexp_extract(url, '^https?://[^/]+', 0) || '/start', NULL FROM {FILES} WHERE error IS NULL AND page_id % 4 < 2)"""
TEXT_ROWS = f"""(SELECT site, file_order, 0 AS position, url, CAST(NULL AS VARCHAR) AS lastmod FROM {FILES} WHERE error IS NULL AND page_id % 4 = 3
  UNION ALL SELECT site, file_order, 1, url || '/print', NULL FROM {FILES} WHERE error IS NULL AND page_id % 4 = 3)"""


@register("parse_sitemap_entries", f"SELECT site, url, lastmod FROM {K.first_rows(XML_ROWS, 'site, url', 'file_order, position')}")
def parse_sitemap_entries(spark, sf):
    return M.parse_sitemap_entries(sitemaps(spark, sf)).select("site", "url", "lastmod")


@register("parse_sitemap_text", f"SELECT site, url, lastmod FROM {K.first_rows(TEXT_ROWS, 'site, url', 'file_order, position')}")
def parse_sitemap_text(spark, sf):
    return M.parse_sitemap_text(sitemaps(spark, sf)).select("site", "url", "lastmod")


@register("parse_sitemap_index", f"SELECT site, file_order, url || '/map.xml' AS child_url FROM {FILES} WHERE error IS NULL AND page_id % 4 = 2")
def parse_sitemap_index(spark, sf):
    return M.parse_sitemap_index(sitemaps(spark, sf)).select("site", "file_order", "child_url")


@register("sitemap_stats", f"""SELECT site, count(*) FILTER (WHERE error IS NULL) AS sitemap_files_read,
  count(*) FILTER (WHERE error IS NOT NULL) AS sitemap_errors FROM {FILES} GROUP BY site""")
def sitemap_stats(spark, sf):
    return M.sitemap_stats(sitemaps(spark, sf))


# Per host a first file that names two index files; these name five files of page addresses, one of them both, and the first file again.
LEAVES = """SELECT host, leaf, url, modified FROM (SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, CAST(page_id % 5 AS INT) AS leaf, url,
  '2024-02-' || lpad(CAST(page_id % 28 + 1 AS STRING), 2, '0') AS modified FROM {pages})"""
INDEX_PARTS = {"i0": [0, 1, 2], "i1": [2, 3, 4]}


def index_files(spark, sf):
    """(host, name, text) of the files as text, written packed and plain and read back by the reader of sitemap files."""
    rows = S.frame(spark, sf, LEAVES)
    here = F.concat(F.lit("https://"), "host", F.lit("/"))

    def index(names):
        parts = [F.concat(F.lit("<sitemap><loc>"), here, F.lit(f"{n}.xml</loc></sitemap>")) for n in names]
        return F.concat(F.lit("<sitemapindex>"), *parts, F.lit("</sitemapindex>"))

    entry = F.concat(F.lit("<url><loc>"), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("</loc><lastmod>"), "modified", F.lit("</lastmod></url>"))
    leaves = rows.groupBy("host", F.concat(F.lit("leaf"), F.col("leaf").cast("string")).alias("name")).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    leaves = leaves.select("host", "name", F.concat(F.lit("<urlset>"), F.array_join("entries", ""), F.lit("</urlset>")).alias("text"))
    hosts = rows.select("host").distinct()
    out = leaves.unionByName(hosts.select("host", F.lit("root").alias("name"), index(list(INDEX_PARTS)).alias("text")))
    for name, parts in INDEX_PARTS.items():
        out = out.unionByName(hosts.select("host", F.lit(name).alias("name"), index([f"leaf{p}" for p in parts] + ["root"]).alias("text")))
    return out


def expanded(spark, sf):
    files = index_files(spark, sf).select(F.concat(F.lit("https://"), "host", F.lit("/"), "name", F.lit(".xml")).alias("file_url"), "text")
    roots = files.where(F.col("file_url").endswith("/root.xml")).select(
        F.regexp_extract("file_url", "//([^/]+)", 1).alias("site"), "file_url", F.lit(0).alias("position"))
    return M.expand_sitemaps(roots, files)


@register("expand_sitemaps", f"""SELECT host AS site, name, CAST(round AS INT) AS round, CASE WHEN name LIKE 'leaf%' AND (host, name) NOT IN (SELECT (host, 'leaf' || CAST(leaf AS VARCHAR)) FROM {S.sql(LEAVES)})
    THEN 'not fetched' END AS error FROM (SELECT DISTINCT host FROM {S.sql(LEAVES)}) CROSS JOIN (VALUES ('root', 0), ('i0', 1), ('i1', 1), ('leaf0', 2), ('leaf1', 2), ('leaf2', 2), ('leaf3', 2), ('leaf4', 2)) AS v(name, round)""")
def expand_sitemaps(spark, sf):
    """Files that a crawl comes to from the first file of every host, over two levels of index files with a circle."""
    return expanded(spark, sf).select("site", F.regexp_extract("file_url", "/([^/.]+)[.]xml$", 1).alias("name"), "round", "error")


@register("expanded_sitemap_entries", f"SELECT host AS site, url, modified AS lastmod FROM {S.sql(LEAVES)}")
def expanded_sitemap_entries(spark, sf):
    return M.sitemap_entries(expanded(spark, sf)).select("site", "url", "lastmod")


@register("packed_sitemaps", f"SELECT host AS site, url, modified AS lastmod FROM {S.sql(LEAVES)}")
def packed_sitemaps(spark, sf):
    """Entries of sitemap files that lie in a folder, some of them packed: one file per host and leaf."""
    folder = S.shared_folder(spark)
    leaves = index_files(spark, sf).where(F.col("name").startswith("leaf"))
    for packed, codec in ((True, "gzip"), (False, "none")):
        part = leaves.where((F.col("name") == "leaf1") == packed)
        part.repartition("host", "name").write.partitionBy("host", "name").option("compression", codec).text(f"{folder}/{codec}")
    read = M.read_sitemap_files(spark, folder).select(
        F.regexp_extract("path", "host=([^/]+)", 1).alias("site"), F.regexp_extract("path", "name=([^/]+)", 1).alias("file_order"), "path", "text")
    return M.sitemap_entries(read).select("site", "url", "lastmod")


# --- robots ----------------------------------------------------------------------------------

ROBOT_FILES = S.sql(S.ROBOTS)
RULE_ROWS = f"""(SELECT host, 'otherbot' AS agent, FALSE AS allow, '/' AS prefix FROM {ROBOT_FILES}
  UNION ALL SELECT host, '*', TRUE, '/fr/1' FROM {ROBOT_FILES} UNION ALL SELECT host, '*', FALSE, '/fr/' FROM {ROBOT_FILES} WHERE has_fr = 1
  UNION ALL SELECT host, '*', FALSE, '/es/' FROM {ROBOT_FILES} UNION ALL SELECT host, unnest(['gaugebot', 'second']), FALSE, '/en/' FROM {ROBOT_FILES} WHERE has_de = 1)"""


@register("robots_rules", f"SELECT * FROM {RULE_ROWS}")
def robots_rules(spark, sf):
    return B.robots_rules(S.frame(spark, sf, S.ROBOTS)).select("host", "agent", "allow", "prefix")


@register("robots_policy", f"""SELECT host, CAST(http_status AS INT) AS robots_http_status, CASE http_status WHEN 403 THEN 'deny_all' WHEN 404 THEN 'allow_all' ELSE 'rules' END AS verdict,
  CASE WHEN http_status = 200 AND has_de = 0 THEN CAST(10 AS INT) END AS crawl_delay, CASE WHEN http_status = 200 THEN 'https://' || host || '/map.xml' END AS sitemaps,
  CASE WHEN http_status <> 200 THEN NULL WHEN has_de = 1 THEN '- /en/' ELSE '+ /fr/1' || CASE WHEN has_fr = 1 THEN ',- /fr/' ELSE '' END || ',- /es/' END AS rules FROM {ROBOT_FILES}""")
def robots_policy(spark, sf):
    return B.robots_policy(S.frame(spark, sf, S.ROBOTS), AGENT).select(
        "host", F.col("robots_http_status").cast("int"), "verdict", "crawl_delay", F.array_join("sitemaps", ",").alias("sitemaps"),
        F.array_join(F.transform("rules", lambda r: F.concat(F.when(r["allow"], F.lit("+ ")).otherwise(F.lit("- ")), r["prefix"])), ",").alias("rules"))


@register("robots_allow", f"""SELECT page_id, CASE WHEN http_status = 403 THEN FALSE WHEN http_status = 404 THEN TRUE WHEN has_de = 1 THEN url NOT LIKE '%//%/en/%'
    WHEN url LIKE '%//%/fr/1%' THEN TRUE WHEN has_fr = 1 AND url LIKE '%//%/fr/%' THEN FALSE ELSE url NOT LIKE '%//%/es/%' END AS allowed
  FROM pages JOIN {ROBOT_FILES} r ON r.host = regexp_extract(url, '^https?://([^/]+)', 1)""")
def robots_allow(spark, sf):
    pages = S.frame(spark, sf, S.PAGE_URLS).select("page_id", "url", "host")
    return B.robots_allow(pages, B.robots_policy(S.frame(spark, sf, S.ROBOTS), AGENT)).select("page_id", "allowed")
