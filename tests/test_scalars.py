"""Golden rows of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.functions import contacts as C
from sitegauge.functions import html as H
from sitegauge.functions import rules as R
from sitegauge.functions import text as X
from sitegauge.functions import urls as U


def one(spark, column, **values):
    """Value of a column over one row of string inputs."""
    names = ", ".join(f"{k} string" for k in values) or "x string"
    row = tuple(values.values()) or (None,)
    return spark.createDataFrame([row], names).select(column).first()[0]


def many(spark, function, pairs):
    rows = [(i, given) for i, (given, _) in enumerate(pairs)]
    got = {r.i: r.v for r in spark.createDataFrame(rows, "i int, a string").select("i", function("a").alias("v")).collect()}
    assert [got[i] for i in range(len(pairs))] == [want for _, want in pairs]


def test_brand_name(spark):
    many(spark, X.brand_name, [("The Acme Company", "Acme"), ("Acme Tractor Corporation", "Acme"), ("Acme", "Acme"),
                               ("Acme  North   America", "Acme"), ("Acme Inc.", "Acme")])


def test_clip_and_clean(spark):
    many(spark, lambda c: X.clip_text(c, 5), [(" a  b ", "a b"), ("  ", None), (None, None), ("abcdefgh", "abcde")])
    many(spark, X.clean_text, [(" a \t b\n", "a b"), (None, None)])
    many(spark, X.word_count, [("a b  c", 3), ("", 0), (None, 0), (" one ", 1)])


def test_clean_url(spark):
    many(spark, U.clean_url, [("HTTPS://Ex.COM/A/?q=1#x", "https://ex.com/A/"), ("https://ex.com", "https://ex.com/"),
                              (" https://ex.com/a;v=1?x ", "https://ex.com/a"), ("https://ex.com/a&amp;b", "https://ex.com/a&b")])
    many(spark, U.url_key, [("https://Ex.com/A//", "https://ex.com/a")])
    many(spark, U.url_host, [("https://www.Ex.com/a", "ex.com"), ("http://ex.com", "ex.com")])


def test_relative_path(spark):
    many(spark, lambda c: U.relative_path(c, F.lit("https://ex.com/en")), [
        ("https://ex.com/en-us/a", None), ("https://EX.com/en/", ""), ("https://ex.com/en/A/b", "a/b")])


def test_resolve_url(spark):
    base = F.lit("https://ex.com/a/b.html?q#f")
    many(spark, lambda c: U.resolve_url(base, c), [
        ("/x", "https://ex.com/x"), ("x", "https://ex.com/a/x"), ("../x", "https://ex.com/x"), ("//o.com/x", "https://o.com/x"),
        ("http://o.com/x", "http://o.com/x"), ("tel:1", "tel:1"), ("#t", "https://ex.com/a/b.html?q#t"), ("./x/../y?z", "https://ex.com/a/y?z")])


def test_page_type(spark):
    many(spark, R.page_type, [("news/products/x", "news"), ("docs/a.pdf", "document"), ("", "home"), ("products/news", "news"),
                              ("wheel-loaders/x", "product"), ("about-us", "about"), ("legal", "other"), ("careers", "careers")])
    many(spark, lambda c: R.page_type(c, "^products"), [("products/news", "product"), ("news/products/x", "news"), ("wheel-loaders/x", "other")])


def test_path_category(spark):
    many(spark, lambda c: U.path_category(U.path_segments(c), F.lit("product"), 1), [("products", None), ("products/a.html", "a")])


def test_rule_order(spark):
    def category(c):
        return R.rule_first_match(c)["category"]
    many(spark, category, [("engine/x", "Engines & Powertrain"), ("engine-powered-lift/x", None), ("mini-excavator/x", "Mini Excavators"),
                           ("excavators/x", "Excavators"), ("feed-mixers/x", "Hay & Forage"), ("balers/x", "Hay & Forage"), ("mixers/x", "Concrete & Paving"),
                           ("tillage-roller", "Seeding & Tillage"), ("roller", "Compaction"), ("attachments/excavator", "Attachments"), ("nothing", None)])


def test_product_name(spark):
    assert one(spark, X.product_name("h", "p"), h="Mower | Acme", p="x") == "Mower"
    assert one(spark, X.product_name("h", "p"), h=None, p="a/greens-mower-ab1c2d3") == "Greens Mower"
    assert one(spark, X.product_name("h", "p"), h=None, p="a/greens-mower.html") == "Greens Mower"


def test_year_from_path(spark):
    many(spark, X.year_from_path, [("news/2024/x", 2024), ("n/20245/x", None), ("a-2024-b", None), ("2023-news", 2023)])


def test_phones(spark):
    many(spark, X.format_phone, [("+1 (212) 555-1234", "212-555-1234"), ("1125551234", None), ("123", None), ("212.155.1234", None)])

    def found(c):
        return F.transform(C.extract_text_phones(c), lambda p: F.concat_ws("/", p["value"], p["context"]))
    many(spark, found, [
        ("a 212-555-1234 and 313-555-9999.", ["212-555-1234/a [[212-555-1234]] and 313-555-9999.", "313-555-9999/a 212-555-1234 and [[313-555-9999]]."]),
        ("part 12-212-555-1234-9", []), ("", []), (None, [])])


def test_context_is_whole_and_exact(spark):
    text = "x" * 200 + " 212-555-1234 " + "y" * 200
    before, match, after = one(spark, F.get(C.matches_in_context("a", presets.PHONE_PATTERN, 80), F.lit(0)), a=text)
    assert (before, match, after) == ("x" * 79 + " ", "212-555-1234", " " + "y" * 79)


def test_addresses(spark):
    def values(c):
        return F.transform(C.extract_text_addresses(c), lambda p: p["value"])
    many(spark, values, [("Visit us in Racine, Wisconsin 53403-1234 today", ["Racine, WI 53403"]), ("in St. Paul MN, 55101", ["St. Paul, MN 55101"]), ("no 12345", [])])

    def jsonld(c):
        return F.transform(C.extract_jsonld_addresses(F.array(c)), lambda p: p["value"])
    many(spark, jsonld, [('{"postalCode":"53403","addressRegion":"Wisconsin"}', ["WI 53403"]), ('{"postalCode":"53403"}', [])])


def test_first_wins_and_cap(spark):
    contacts = F.array(*[F.struct(F.lit(v).alias("value"), F.lit(str(i)).alias("context"), F.lit(s).alias("source"))
                         for i, (v, s) in enumerate([("a", "text"), ("b", "text"), ("a", "tel_link"), ("c", "json_ld")])])
    kept = one(spark, F.transform(C.contacts_first_wins(contacts, 2), lambda c: F.concat(c["value"], c["context"])))
    assert kept == ["a0", "b1"]


def test_scores(spark):
    def score(context, source, url="https://x.com/p"):
        return one(spark, C.score_address("c", "s", "u"), c=context, s=source, u=url).score
    assert score("Our headquarters [[x]]", "text") == 3
    assert score("[[x]] headquarters", "text") == 0
    assert score("no brackets, headquarters", "json_ld") == 3
    assert score("", "json_ld") == 2
    assert score(None, "text", "https://x.com/Contact") == 1
    assert one(spark, C.score_phone("c", "s", "u"), c="Fax: [[1]]", s="text", u="x") is None
    assert one(spark, C.score_phone("c", "s", "u"), c="tel:1", s="tel_link", u="x").match == "phone link"


def test_phone_next_to_address(spark):
    many(spark, C.phone_next_to_address, [("a [[b]] Fax: 212-555-1111 Tel 313-555-2222", "313-555-2222"), ("a [[b]] none", None), ("212-555-1111", None)])


def test_cities(spark):
    many(spark, X.clean_city, [("River Green Parkway Duluth", "Duluth"), ("St. N. Wahpeton", "Wahpeton"), ("Racine", "Racine"), ("Main Street", "")])
    assert one(spark, X.city_resolution("a", "b"), a="Lyndale Avenue South Bloomington", b="Bloomington") == "Bloomington"
    assert one(spark, X.city_resolution("a", "b"), a="Main Street", b=None) == "Main Street"


def test_founded(spark):
    def years(c):
        return C.founded_years(c, True)
    many(spark, years, [("We were founded in 1947.", [1947]), ("Our plant was established in 1922.", []), ("Acme was founded in 1947.", []), ("US since 1947", [])])


def test_html(spark):
    page = ("<html><head><!-- <title>no</title> --><title> A &amp;amp; B </title><script>var t='<h1>x</h1></p>'</script>"
            "<META content='d &quot;q&quot;' name=Description></head><body><nav><a href='/m'>m</a></nav><main><h1>T<br>1</h1><h2></h2>"
            "<h2>S &#x26; &#233; &bogus;</h2><p>one<b>two<a href=x.html>l</a></main><footer>foot</footer></body>")
    assert one(spark, H.html_title("a"), a=page) == "A &amp; B"
    assert one(spark, H.html_h1("a"), a=page) == "T 1"
    assert one(spark, H.html_meta_description("a"), a=page) == 'd "q"'
    assert one(spark, H.html_headings("a"), a=page) == ["S & é &bogus;"]
    assert one(spark, H.html_hrefs("a"), a=page) == ["/m", "x.html"]
    assert one(spark, H.html_main_text("a"), a=page) == "T 1 S & é &bogus; one two l"
    assert one(spark, H.html_visible_text("a"), a=page).endswith("one two l foot")
    assert one(spark, H.html_title("a"), a="<p>none") is None


def test_captcha(spark):
    many(spark, lambda c: H.captcha_flag(c, F.lit(""), F.lit(500)), [("Captcha", True), ("protected by reCAPTCHA", False), (None, False)])
    many(spark, lambda c: H.captcha_flag(F.lit(""), c, F.lit(299)), [("Are you a robot", True)])
    many(spark, lambda c: H.captcha_flag(F.lit(""), c, F.lit(300)), [("Are you a robot", False)])


@pytest.mark.parametrize("code,kind,want", [(None, "text/html", "error"), (403, "text/html", "blocked"), (429, "x", "blocked"), (500, "x", "http_error"),
                                            (200, "application/pdf", "not_html"), (200, None, "not_html"), (200, "Text/HTML", "ok")])
def test_fetch_status(spark, code, kind, want):
    assert one(spark, H.fetch_status(F.lit(code).cast("int"), "k", F.lit(False)), k=kind) == want
