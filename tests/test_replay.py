"""The crawl replayed, sitemaps expanded and links followed, each against a loop."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.operators import crawl, replay
from sitegauge.sources import sitemaps as M

LIMITS = [{}, {"max_products": 6}, {"max_pages": 12}, {"max_pages": 25, "max_products": 9, "max_contacts": 3}, {"max_pages": 1}]
PATHS = {"product": "products/", "about": "about-us/", "other": "x/", "news": "news/contact/", "dealer": "contact-us/", "careers": "jobs/", "document": "d/"}


def _site(rng, n):
    """(url, key, path, type, depth, allowed, status, code, words) of a site's pages; the first is the start page."""
    base = f"https://s{n}.example.com/"
    rows = [(base, base[:-1], "", "home", 0, rng.random() < 0.9, rng.choice(["ok", "ok", "ok", "error", "blocked", "captcha"]), 200, 100)]
    bad, thin = rng.random() * 0.5, rng.random()
    for k in range(rng.randint(0, 70) if n else 300):
        kind = rng.choice(list(PATHS))
        path = f"{PATHS[kind]}{k:03d}"
        status = "ok" if rng.random() > bad else rng.choice(["error", "blocked", "http_error"])
        code = None if status == "error" else 403 if status == "blocked" else rng.choice([404, 503]) if status == "http_error" else 200
        rows.append((base + path, (base + path).lower(), path, kind, rng.randint(1, 3), rng.random() < 0.85, status, code,
                     rng.randint(0, 19) if rng.random() < thin else rng.randint(20, 300)))
    return rows


def _loop(rows, max_pages=None, max_products=None, max_contacts=None, max_failures=5, max_empty=4):
    """One page after the other, with the state in variables."""
    start = rows[0]
    if not start[5]:
        return [], False, 0, []
    visits = [(start[0], 0)]
    if start[6] in ("blocked", "captcha"):
        return visits, False, 0, []
    import re
    contact = [r for r in rows[1:] if r[3] not in ("home", "document") and re.search(presets.CONTACT_PAGE_PATTERN, r[2]) and not re.search(presets.NOT_CONTACT_PATTERN, r[2])]
    contact.sort(key=lambda r: (0 if re.search(presets.CONTACT_FIRST_PATTERN, r[2]) else 1, r[4], r[0]))
    queued = sorted((r for r in rows[1:] if r[3] in presets.PAGE_PRIORITY), key=lambda r: (presets.PAGE_PRIORITY[r[3]], r[4], r[0]))
    seen, products, failures, streak, left, skipped = set(), 0, 0, {}, [], 0
    for url, key, _, kind, _, allowed, status, code, words in contact[:max_contacts] + queued:
        if max_pages is not None and len(visits) >= max_pages:
            break
        if key in seen or kind in left or (kind == "product" and max_products is not None and products >= max_products):
            continue
        seen.add(key)
        if not allowed:
            skipped += 1
            continue
        visits.append((url, len(visits)))
        products += kind == "product"
        failures = failures + 1 if status in ("blocked", "captcha", "error") or (code or 0) >= 500 else 0
        if failures >= max_failures:
            return visits, True, skipped, left
        if status == "ok":
            streak[kind] = streak.get(kind, 0) + 1 if words < 20 else 0
            if streak[kind] >= max_empty:
                left.append(kind)
    return visits, False, skipped, left


@pytest.fixture(scope="module")
def crawled(spark):
    rng = random.Random(8)
    sites = {str(n): _site(rng, n) for n in range(40)}
    rows = [(n, *r) for n, rs in sites.items() for r in rs]
    df = spark.createDataFrame(rows, "serial_no string, url string, url_key string, relative_path string, page_type string, depth int, allowed boolean, "
                                     "fetch_status string, http_status int, word_count int").repartition(6)
    outcomes = df.select("serial_no", "url_key", "fetch_status", "http_status", "word_count", F.lit(None).cast("string").alias("error"))
    # pages without an answer have no row
    return sites, df.drop("fetch_status", "http_status", "word_count"), outcomes.where("fetch_status <> 'error' OR url_key LIKE '%.com'")


@pytest.mark.parametrize("limits", LIMITS, ids=str)
def test_replay_is_the_loop(crawled, limits):
    sites, inventory, outcomes = crawled
    got = replay.replay(inventory, outcomes, max_empty=4, **limits)
    visits, ends = {}, {r.serial_no: r for r in got.sites.collect()}
    for r in got.visits.collect():
        visits.setdefault(r.serial_no, []).append((r.url, r.visit_order))
    assert set(ends) == set(sites)
    seen = set()
    for n, rows in sites.items():
        want, stopped, skipped, left = _loop(rows, **limits)
        assert sorted(visits.get(n, []), key=lambda v: v[1]) == want, n
        r = ends[n]
        assert (r.stopped, r.robots_skipped, r.skipped_types) == (stopped, skipped, left), n
        assert r.notes == [f"skipped remaining {t} pages after 4 empty ones" for t in left]
        seen.add((stopped, len(left) > 1, skipped > 0))
    assert len(seen) > 2 or "max_pages" in limits


def test_one_site_is_worked_on_by_several_tasks(spark):
    df = spark.range(20_000).select(F.lit("s").alias("site"), F.format_string("u%06d", "id").alias("url")).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so little data would be one part
    parts = replay.in_chunks(df, ["site", "url"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    counts = [r["count"] for r in parts.groupBy("chunk").count().collect()]
    assert len(counts) > 3 and max(counts) < 10_000
    assert [r.url for r in parts.orderBy("seq").limit(3).collect()] == ["u000000", "u000001", "u000002"]


# --- sitemaps

def _index(*children):
    return "<sitemapindex>" + "".join(f"<sitemap><loc>{c}</loc></sitemap>" for c in children) + "</sitemapindex>"


def _urls(*pages):
    return "<urlset>" + "".join(f"<url><loc>{p}</loc><lastmod>{m}</lastmod></url>" for p, m in pages) + "</urlset>"


def test_index_files_are_followed_to_the_end(spark):
    files = {
        "r": _index("a", "b&amp;1", "r"), "a": _index("c", "b&1"), "b&1": _urls(("p1", "b"), ("p2", "b")), "c": _index("r", "d", "lost"),
        "d": _urls(("p2", "d"), ("p3", "d")), "e": None, "t": "http://t/1\n http://t/2", "lone": _urls(("p9", "x"))}
    table = spark.createDataFrame([(u, x, "timeout" if x is None else None) for u, x in files.items()], "file_url string, text string, error string")
    roots = spark.createDataFrame([("s1", "r", 0), ("s1", "t", 1), ("s1", "r", 2), ("s2", "e", 0), ("s2", "d", 1), ("s3", None, 0)], "site string, file_url string, position int")
    found = M.expand_sitemaps(roots, table)
    order = [r.file_url for r in found.where("site = 's1'").orderBy("file_order").collect()]
    # a queue: roots, what they name, what those name
    assert order == ["r", "t", "a", "b&1", "c", "d", "lost"]
    assert {r.file_url: r["round"] for r in found.where("site = 's1'").collect()} == {"r": 0, "t": 0, "a": 1, "b&1": 1, "c": 2, "d": 3, "lost": 3}
    assert {r.file_url: r.error for r in found.collect() if r.error} == {"lost": "not fetched", "e": "timeout"}
    entries = {(r.site, r.url): r.lastmod for r in M.sitemap_entries(found).collect()}
    assert entries == {("s1", "p1"): "b", ("s1", "p2"): "b", ("s1", "p3"): "d", ("s1", "http://t/1"): None, ("s1", "http://t/2"): None, ("s2", "p2"): "d", ("s2", "p3"): "d"}
    assert {(r.site, r.sitemap_files_read, r.sitemap_errors) for r in M.sitemap_stats(found).collect()} == {("s1", 6, 1), ("s2", 1, 1)}
    assert M.sitemap_stats(found, limit=3).where("site = 's1'").first().sitemap_files_read == 3
    assert {r.file_url for r in M.expand_sitemaps(roots, table, max_rounds=2).where("site = 's1'").collect()} == {"r", "t", "a", "b&1"}
    assert M.expand_sitemaps(roots.limit(0), table).count() == 0


def test_sitemap_files_of_a_folder(spark, tmp_path):
    text = _urls(("https://a/é", "2024"), ("https://a/2", "2025"))
    (tmp_path / "plain.xml").write_text(text, encoding="utf-8")
    (tmp_path / "packed.xml.gz").write_bytes(gzip.compress(text.encode()))
    read = {r.path.rsplit("/", 1)[1]: r.text for r in M.read_sitemap_files(spark, str(tmp_path)).collect()}
    assert read == {"plain.xml": text, "packed.xml.gz": text}


def test_which_sitemaps_to_begin_with(spark):
    sites = spark.createDataFrame([("1", "https://A.com/en/", ["x", "y&amp;z"]), ("2", "https://b.com/", []), ("3", "https://c.com/us", None)],
                                  "serial_no string, base_url string, sitemaps array<string>")
    policy = spark.createDataFrame([("a.com", ["no"]), ("b.com", ["https://b.com/s1", "https://b.com/s2"])], "host string, sitemaps array<string>")
    got = [(r.serial_no, r.position, r.file_url) for r in M.root_sitemaps(sites, policy).orderBy("serial_no", "position").collect()]
    assert got == [("1", 0, "x"), ("1", 1, "y&z"), ("2", 0, "https://b.com/s1"), ("2", 1, "https://b.com/s2"), ("3", 0, "https://c.com/sitemap.xml")]


# --- links

@pytest.mark.parametrize("rounds", [0, 1, 3, None])
def test_links_are_followed_breadth_first(spark, rounds):
    rng = random.Random(2)
    sites = [("1", "https://a.com/", "https://a.com/", "^private", None, 1), ("2", "https://b.com/en/", "https://b.com/en/home", None, None, 1), ("3", "https://c.com/", "https://c.com/", None, None, 1)]
    links = []
    for n, base in (("1", "https://a.com/"), ("2", "https://b.com/en/")):
        pages = [base, base + "home"] + [f"{base}p{k}" for k in range(60)]
        for k, page in enumerate(pages):
            for _ in range(rng.randint(1, 2)):
                to = rng.choice(pages[max(0, k - 4):k + 9])
                links.append((n, page, rng.choice([to, to + "/", to.upper().replace("HTTPS", "https") if rng.random() < 0.2 else to, to + "?q=1"])))
        links += [(n, base, f"{base}private/1"), (n, base, "https://else.com/"), (n, pages[5], base)]
    site_df = spark.createDataFrame(sites, "serial_no string, base_url string, start_url string, exclude string, product_pattern string, category_segment int")
    link_df = spark.createDataFrame(links, "serial_no string, page string, url string").repartition(3)
    got = crawl.discover_links(site_df.select("serial_no", F.col("start_url").alias("url")), link_df, site_df, rounds)
    found = {(r.serial_no, r.url_key): r["round"] for r in got.collect()}
    assert len(found) == got.count()

    def key(url):
        return url.split("?")[0].rstrip("/").lower()

    want = {}
    for n, base, start, exclude, *_ in sites:
        level, number = {key(start)}, 0
        while level and (rounds is None or number <= rounds):
            want |= {(n, k): number for k in level}
            number += 1
            level = {key(u) for m, page, u in links if m == n and key(page) in level}
            level = {k for k in level if (k + "/").startswith(base) and not (exclude and k.startswith(base + "private")) and (n, k) not in want}
    assert found == want
    assert rounds is not None or max(found.values()) > 3
