"""The walk over the tags of a page against a loop with a stack, and character references against the standard library."""

import html
import random
import re

import pytest

from sitegauge.functions import contacts as C
from sitegauge.functions import html as H

HIDDEN, FRAMES = set(H.HIDDEN_TAGS), set(H.HIDDEN_TAGS) | set(H.FRAME_TAGS)


def _squeezed(text):
    return " ".join(text.split())


def _loop(markup):
    """(visible, main, headings) with a list of open elements."""
    stack, shown, content, spans = [], [], [], {"main": None, "body": None}
    open_spans, headings = {}, []
    pieces = re.split(r"(<[^>]*>)", markup)
    for k, piece in enumerate(pieces):
        if k % 2 == 0:
            names = {n for n, _ in stack}
            if not names & HIDDEN:
                shown.append(piece)
            if not names & FRAMES:
                for region, at in open_spans.items():
                    at.append(piece)
                content.append(piece)
            continue
        name = re.match(r"</?([a-z0-9]+)", piece)[1]
        if piece.startswith("</"):
            if name in [n for n, _ in stack]:
                while True:
                    closed, mark = stack.pop()
                    open_spans.pop(mark, None)
                    if closed == name:
                        break
        elif not piece.endswith("/>") and name not in H.VOID_TAGS:
            if name in H.NOT_IN_THEMSELVES and stack and stack[-1][0] == name:
                continue
            hidden = {n for n, _ in stack} & FRAMES
            mark = None
            if not hidden:
                if name in spans and spans[name] is None:
                    mark, spans[name] = name, []
                    open_spans[name] = spans[name]
                elif name in ("h2", "h3") and not any(str(m).startswith("heading") for m in open_spans):
                    mark = f"heading{len(headings)}"
                    headings.append((mark, []))
                    open_spans[mark] = headings[-1][1]
                    headings[-1] = (k, headings[-1][1])
            stack.append((name, mark))
    region = spans["main"] if spans["main"] is not None else spans["body"] if spans["body"] is not None else content
    return _squeezed(" ".join(shown)), _squeezed(" ".join(region)), headings, spans


def _soup(rng):
    tags = ["div", "p", "span", "nav", "form", "footer", "svg", "noscript", "li", "ul", "template", "section", "header", "br"]
    out = ["<html>", rng.choice(["<body>", "<body class='x'>", ""])]
    for _ in range(rng.randint(0, 40)):
        roll = rng.random()
        tag = rng.choice(tags)
        if roll < 0.4:
            out.append(f"<{tag}>" if rng.random() < 0.9 else f"<{tag}/>")
        elif roll < 0.75:
            out.append(f"</{tag}>")
        elif roll < 0.8:
            out.append(rng.choice(["<main>", "</main>", "</body>"]))
        out.append(rng.choice(["", " ", f"w{rng.randint(0, 99)} "]))
    return "".join(out)


def test_walk_is_the_loop(spark):
    rng = random.Random(6)
    pages = [_soup(rng) for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate(pages)), "id int, page string").repartition(4)
    for r in rows.select("id", H.html_visible_text("page").alias("v"), H.html_main_text("page").alias("m")).collect():
        visible, main, _, _ = _loop(pages[r.id])
        assert (r.v or "", r.m) == (visible, main), pages[r.id]


@pytest.mark.parametrize("page, visible, main, headings", [
    ("<div><form>search</div><main>kept text</main>", "search kept text", "kept text", []),
    ("<body><nav>a<nav>b</nav>c</nav>text</body>", "a b c text", "text", []),
    ("<main>x<svg>hid</main>after", "x after", "x", []),
    ("<body><h2>A<svg>z</svg>b</h2>t<h3>un<p>closed</body>", "A b t un closed", "A b t un closed", ["A b", "un closed"]),
    ("<body><nav><h2>menu</h2></nav><h2></h2><h3> one &amp two </h3>", "menu one & two", "one & two", ["one & two"]),
    ("<BODY>a<br/>b<p>c<p>d<img src='x>y'>e</BODY> tail", "a b c d e tail", "a b c d e", []),
    ("<script>if (a<b) {}</script><style>p{}</style>x<!-- <nav> --> y", "x y", "x y", []),
    ("<main>first</main><main>second</main>", "first second", "first", []),
    ("no tags & none < needed", "no tags & none < needed", "no tags & none < needed", []),
    ("", "", "", [])])
def test_parts_of_a_page(spark, page, visible, main, headings):
    r = spark.createDataFrame([(page,)], "page string").select(
        H.html_visible_text("page").alias("v"), H.html_main_text("page").alias("m"), H.html_headings("page").alias("h")).first()
    assert (r.v or "", r.m, r.h) == (visible, main, headings)


def test_nothing_and_a_mark_in_the_page(spark):
    r = spark.createDataFrame([(None, "a￿b<p>c")], "none string, marked string").select(
        H.html_visible_text("none").alias("v"), H.html_visible_text("marked").alias("m"), H.unescape("none").alias("u")).first()
    assert (r.v, r.m, r.u) == (None, "a�b c", None)


def test_character_references(spark):
    rng = random.Random(1)
    names = list(html.entities.html5)
    texts = ["&copy 2024 &plus; &notit; &amp;lt; &#38;&#x26 &bogus; &NotEqualTilde; a&b &copyx && & &; &#; &#x; &1; &#0065; &#x000041g", "&amp", "&"]
    texts += [f"x&{n}y" for n in names] + [f"x&{n.removesuffix(';')} y" for n in names[::3]] + [f"&{n.removesuffix(';')}Z9;" for n in names[::5]]
    texts += [f"&#{c};|&#x{c:x}z" for c in [*range(0, 300), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1FFFE, 0x10FFFF, 0x110000, 10**9, 10**30]]
    texts += ["".join(rng.choice(["&", "#", "x", "amp", "lt", "copy", ";", "1", " ", "é"]) for _ in range(12)) for _ in range(500)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", H.unescape("t").alias("u")).collect()
    wrong = [(r.t, r.u, html.unescape(r.t)) for r in got if r.u != html.unescape(r.t)]
    assert not wrong, wrong[:5]


def test_surroundings_of_matches(spark):
    rng = random.Random(9)
    texts = ["", "x", "12-34-56-78", " 12-34-56-78"] + ["".join(rng.choice(["12-34-56-78", "a", "bc ", "é", "\n", "x" * 30]) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate([*texts, None])), "id int, t string")
    got = {r.id: [tuple(m) for m in r.m] for r in rows.select("id", C.matches_in_context("t", r"\d\d-\d\d-\d\d-\d\d", 25).alias("m")).collect()}
    for k, text in enumerate(texts):
        assert got[k] == [(text[max(0, m.start() - 25):m.start()], m[0], text[m.end():m.end() + 25]) for m in re.finditer(r"\d\d-\d\d-\d\d-\d\d", text)]
    assert got[len(texts)] == []
