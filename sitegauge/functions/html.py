"""Column functions that read fields out of HTML text.

All of them are built-in functions, so extraction stays inside the JVM.  Pages are not well formed,
so the parts of a page that a reader sees are found by one walk over its tags that keeps the open
elements: an end tag closes the elements that were left open inside its own.
"""

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.functions.prefilter import matches
from sitegauge.functions.text import as_col, by_sql, clip_text, let, squeeze

COMMENTS = r"(?s)<!--.*?-->"
CODE_TAGS = ["script", "style"]
HIDDEN_TAGS = ["noscript", "svg", "template"]
FRAME_TAGS = ["iframe", "nav", "header", "footer", "form"]
VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
#: A start tag of these ends the open element of the same name.
NOT_IN_THEMSELVES = ["p", "li", "dt", "dd", "tr", "td", "th", "option", "thead", "tbody"]
#: Put around tags; a character that no page may hold, replaced where one does.
MARK = "\uffff"
TAG = r"(?s)<(?:/?[A-Za-z]|!|\?)(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>|<(?:/?[A-Za-z]|!|\?)[^>]*>"
ENTITY = r"&(?=#[0-9]|#[xX][0-9a-fA-F]|[A-Za-z])"
# Entities met most, tried before the full table.
COMMON = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "nbsp": "\u00a0"}
#: Names that older pages write without a semicolon, long ones first.
BARE = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))


def _raw(text: str) -> str:
    """SQL literal of a text without single quotes, backslashes as they are."""
    return f"r'{text}'"


def _table(values: dict) -> str:
    """SQL map out of one JSON literal: the optimizer folds it into a constant."""
    return "from_json(" + _raw(json.dumps(values).replace("'", "\\u0027")) + ", 'map<string,string>')"


def _character(code: str) -> str:
    """Character of a numeric reference as browsers read it: 128 to 159 are those of the Windows code
    page, other control and non-characters are dropped, what is no character at all is U+FFFD."""
    windows = ", ".join(_raw(bytes([c]).decode("cp1252", "ignore") or chr(c)) for c in range(0x80, 0xA0))
    return f"""CASE WHEN {code} BETWEEN 128 AND 159 THEN element_at(array({windows}), CAST({code} - 127 AS INT))
      WHEN {code} <= 0 OR {code} > 1114111 OR {code} BETWEEN 55296 AND 57343 THEN '\ufffd'
      WHEN {code} BETWEEN 1 AND 8 OR {code} = 11 OR {code} BETWEEN 14 AND 31 OR {code} = 127 OR {code} BETWEEN 64976 AND 65007
        OR {code} % 65536 >= 65534 THEN ''
      ELSE decode(unhex(lpad(hex({code}), 8, '0')), 'UTF-32') END"""


def _reference(p: str) -> str:
    """The text of a character reference at the start of a piece (its ampersand is cut off), and all behind it."""
    digits = "regexp_replace(found, '^#[xX]?0*|;$', '')"
    code = f"""CASE WHEN length({digits}) > 8 THEN 1114112L ELSE coalesce(try_cast(
      CASE WHEN found RLIKE '^#[xX]' THEN conv({digits}, 16, 10) ELSE {digits} END AS BIGINT), 0L) END"""
    number = let("found", f"regexp_extract({p}, '^#(?:[xX][0-9a-fA-F]+|[0-9]+);?', 0)",
                 let("code", code, f"concat({_character('code')}, substr({p}, length(found) + 1))"))
    common = " ".join(f"WHEN '{n}' THEN {_raw(v)}" for n, v in COMMON.items())
    table = _table({n[:-1]: v for n, v in sorted(html5.items()) if n.endswith(";") and n[:-1] not in COMMON})
    # without a semicolon: the longest beginning that is one of the older names
    beginning = let("bare", f"regexp_extract(name, '^(?:{'|'.join(BARE)})', 0)",
                    f"CASE WHEN bare = '' THEN concat('&', {p}) ELSE concat(element_at({_table({n: html5[n] for n in BARE})}, bare), substr({p}, length(bare) + 1)) END")
    exact = f"CASE WHEN substr({p}, length(name) + 1, 1) = ';' THEN CASE name {common} ELSE element_at({table}, name) END END"
    named = let("name", f"regexp_extract({p}, '^[A-Za-z0-9]+', 0)",
                let("exact", exact, f"CASE WHEN exact IS NOT NULL THEN concat(exact, substr({p}, length(name) + 2)) ELSE {beginning} END"))
    return f"CASE WHEN startswith({p}, '#') THEN {number} ELSE {named} END"


_UNESCAPED = f"""CASE WHEN contains(raw, '&') THEN
  array_join(transform(split(raw, {_raw(ENTITY)}), (piece, i) -> CASE WHEN i = 0 THEN piece ELSE {_reference('piece')} END), '') ELSE raw END"""


def unescape(c) -> Column:
    """Replace character references once, from left to right, with or without a semicolon; unknown names stay."""
    return by_sql(c, "raw", _UNESCAPED)


def _block(tags) -> str:
    """An element with its content, up to its end tag or, if that is missing, the end of the text."""
    names = "|".join(tags)
    return rf"(?is)<({names})(?=[\s>/])[^>]*?(?:/>|>.*?(?:</\1\s*>|\z))"


def _start_tag(name: str) -> str:
    return rf"(?is)<{name}(?=[\s>/])[^>]*>"


def without_comments(html) -> Column:
    return F.regexp_replace(as_col(html), COMMENTS, "")


def without_blocks(html, tags) -> Column:
    return F.regexp_replace(as_col(html), _block(tags), " ")


def tag_text(markup) -> Column:
    """Text of a piece of markup: tags are gaps, character references are resolved."""
    return unescape(F.regexp_replace(as_col(markup), TAG, " "))


def _element(html, tag: str) -> Column:
    """Content of the first such element, null when there is none."""
    pattern = rf"(?is)<{tag}(?=[\s>/])[^>]*>(.*?)(?:</{tag}\s*>|\z)"
    text = as_col(html)
    return F.when(text.rlike(_start_tag(tag)), F.regexp_extract(text, pattern, 1))


def markup_of(html) -> Column:
    """HTML without comments, scripts and styles."""
    return without_blocks(without_comments(html), CODE_TAGS)


def title_of(markup, limit: int | None = None) -> Column:
    return clip_text(unescape(_element(markup, "title")), limit)


def h1_of(markup, limit: int | None = None) -> Column:
    return clip_text(tag_text(_element(markup, "h1")), limit)


def html_title(html, limit: int | None = None) -> Column:
    return title_of(markup_of(html), limit)


def html_h1(html, limit: int | None = None) -> Column:
    return h1_of(markup_of(html), limit)


def attribute(tag, name: str) -> Column:
    """Value of an attribute in a start tag, unescaped; null when the tag does not have it."""
    pattern = rf"(?is)\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    text = as_col(tag)
    value = F.concat(*[F.regexp_extract(text, pattern, i) for i in (1, 2, 3)])
    return F.when(text.rlike(pattern), unescape(value))


def meta_description_of(markup, limit: int | None = None) -> Column:
    metas = F.regexp_extract_all(as_col(markup), F.lit(r"(?is)<meta(?=[\s>/])[^>]*>"), F.lit(0))
    named = F.filter(metas, lambda m: m.rlike(r"(?i)\sname\s*=\s*[\"']?description(?=[\"'\s/>])"))
    graph = F.filter(metas, lambda m: m.rlike(r"(?i)\sproperty\s*=\s*[\"']?og:description(?=[\"'\s/>])"))
    chosen = F.coalesce(F.get(named, F.lit(0)), F.get(graph, F.lit(0)))
    return clip_text(attribute(chosen, "content"), limit)


def html_meta_description(html, limit: int | None = None) -> Column:
    """Content of meta description, else of og:description."""
    return meta_description_of(markup_of(html), limit)


def json_ld_blocks(html, chars: int | None = None) -> Column:
    """All JSON-LD script bodies, empty ones dropped.  Needs the scripts of the page."""
    pattern = r"(?is)<script(?=[^>]*\stype\s*=\s*[\"']?application/ld\+json)[^>]*>(.*?)(?:</script\s*>|\z)"
    bodies = F.regexp_extract_all(without_comments(html), F.lit(pattern), F.lit(1))
    return F.filter(F.transform(bodies, lambda b: clip_text(b, chars)), lambda b: b.isNotNull())


def html_json_ld(html, keep: int | None = None) -> Column:
    blocks = json_ld_blocks(html)
    return blocks if keep is None else F.slice(blocks, 1, keep)


def hrefs_of(markup) -> Column:
    anchors = F.regexp_extract_all(as_col(markup), F.lit(r"(?is)<a(?=\s)[^>]*>"), F.lit(0))
    return F.filter(F.transform(anchors, lambda a: attribute(a, "href")), lambda h: h.isNotNull())


def html_hrefs(html) -> Column:
    """Raw link targets of all anchors, in page order."""
    return hrefs_of(markup_of(html))


def _listed(names) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


#: 'div' for a start tag, '/div' for an end tag, '' for what opens and closes nothing.
_TOKEN = let("name", f"lower(regexp_extract(tag, {_raw('^<(/?[A-Za-z][^\\s/>]*)')}, 1))",
             f"CASE WHEN endswith(tag, '/>') OR name IN {_listed(VOID_TAGS)} THEN '' ELSE name END")


def _walk(tokens: str) -> str:
    """Spans of the texts between the tags: shown ones, those without menus, the main part, headings.

    Text k stands before tag k.  The open elements are one string such as /html/body/div/, so an
    end tag cuts it at the last element of its name, and an element is closed once the string is no
    longer than it was in front of it.  A state holds nothing but that string, numbers and the spans found."""
    no_spans = "CAST(array() AS array<struct<a:int,b:int>>)"
    start = f"""named_struct('i', 0, 'open', '/', 'hidden_in', -1, 'shown_from', 0, 'shown', {no_spans}, 'frame_in', -1, 'content_from', 0, 'content', {no_spans},
      'main_in', -1, 'main_from', -1, 'main_to', -1, 'body_in', -1, 'body_from', -1, 'body_to', -1, 'heading_in', -1, 'heading_from', 0, 'headings', {no_spans})"""
    path = "concat('/', substr(t, 2), '/')"
    after = f"""CASE WHEN t = '' THEN s.open
      WHEN startswith(t, '/') THEN CASE WHEN contains(s.open, {path})
        THEN left(s.open, length(s.open) - length(substring_index(s.open, {path}, -1)) - length(t)) ELSE s.open END
      WHEN t IN {_listed(NOT_IN_THEMSELVES)} AND endswith(s.open, concat('/', t, '/')) THEN s.open
      ELSE concat(s.open, t, '/') END"""
    opened, was = "(length(o) > length(s.open))", "length(s.open)"

    def closes(depth):
        return f"(s.{depth} >= 0 AND length(o) <= s.{depth})"

    def hide(tags, depth, begin, spans):
        opens = f"({opened} AND s.{depth} < 0 AND t IN {_listed(tags)})"
        return f"""'{depth}', CASE WHEN {closes(depth)} THEN -1 WHEN {opens} THEN {was} ELSE s.{depth} END,
          '{begin}', CASE WHEN {closes(depth)} THEN s.i + 1 ELSE s.{begin} END,
          '{spans}', CASE WHEN {opens} THEN concat(s.{spans}, array(named_struct('a', s.{begin}, 'b', s.i))) ELSE s.{spans} END"""

    def first(tag):
        opens = f"({opened} AND t = '{tag}' AND s.{tag}_from < 0 AND s.frame_in < 0)"
        return f"""'{tag}_in', CASE WHEN {closes(f'{tag}_in')} THEN -1 WHEN {opens} THEN {was} ELSE s.{tag}_in END,
          '{tag}_from', CASE WHEN {opens} THEN s.i + 1 ELSE s.{tag}_from END, '{tag}_to', CASE WHEN {closes(f'{tag}_in')} THEN s.i ELSE s.{tag}_to END"""

    heads = f"({opened} AND t IN ('h2', 'h3') AND s.heading_in < 0 AND s.frame_in < 0)"
    step = let("o", after, f"""named_struct('i', s.i + 1, 'open', o, {hide(HIDDEN_TAGS, 'hidden_in', 'shown_from', 'shown')},
      {hide(HIDDEN_TAGS + FRAME_TAGS, 'frame_in', 'content_from', 'content')}, {first('main')}, {first('body')},
      'heading_in', CASE WHEN {closes('heading_in')} THEN -1 WHEN {heads} THEN {was} ELSE s.heading_in END,
      'heading_from', CASE WHEN {heads} THEN s.i + 1 ELSE s.heading_from END,
      'headings', CASE WHEN {closes('heading_in')} THEN concat(s.headings, array(named_struct('a', s.heading_from, 'b', s.i))) ELSE s.headings END)""")

    def rest(spans, condition, begin):
        return f"CASE WHEN {condition} THEN concat(s.{spans}, array(named_struct('a', s.{begin}, 'b', s.i))) ELSE s.{spans} END"

    end = f"""named_struct('shown', {rest('shown', 's.hidden_in < 0', 'shown_from')}, 'content', {rest('content', 's.frame_in < 0', 'content_from')},
      'low', CASE WHEN s.main_from >= 0 THEN s.main_from WHEN s.body_from >= 0 THEN s.body_from ELSE 0 END,
      'high', CASE WHEN s.main_from >= 0 THEN if(s.main_to >= 0, s.main_to, s.i) WHEN s.body_from >= 0 THEN if(s.body_to >= 0, s.body_to, s.i) ELSE s.i END,
      'headings', {rest('headings', 's.heading_in >= 0', 'heading_from')})"""
    return f"aggregate({tokens}, {start}, (s, t) -> {step}, s -> {end})"


def _inside(spans: str, low: str, high: str) -> str:
    return (f"transform(filter({spans}, x -> x.a <= {high} AND x.b >= {low}), "
            f"x -> named_struct('a', greatest(x.a, {low}), 'b', least(x.b, {high})))")


def _texts(spans: str) -> str:
    return f"array_join(flatten(transform({spans}, x -> slice(page.texts, x.a + 1, x.b - x.a + 1))), ' ')"


_PARTS = let("page", f"""named_struct('texts', filter(pieces, (p, i) -> i % 2 = 0),
    'found', {_walk(f"transform(filter(pieces, (p, i) -> i % 2 = 1), tag -> {_TOKEN})")})""",
    let("main", _inside("page.found.content", "page.found.low", "page.found.high"), f"""named_struct('visible', {_texts('page.found.shown')}, 'main', {_texts('main')},
      'headings', transform({_inside('page.found.headings', 'page.found.low', 'page.found.high')}, h -> {_texts(_inside('main', 'h.a', 'h.b'))}))"""))


def page_parts(markup) -> Column:
    """struct(visible, main, headings): markup-free texts, character references not yet resolved.

    visible: all text a reader sees, header and footer included.  main: without menus, headers,
    footers and forms, of the first main element, else of body, else of the page.  headings: h2 and h3 of that part.
    Tags are marked in one pass; texts and tags are every second piece then."""
    marked = F.regexp_replace(F.replace(as_col(markup), F.lit(MARK), F.lit("\ufffd")), TAG, f"{MARK}$0{MARK}")
    return F.when(as_col(markup).isNotNull(), by_sql(F.split(marked, MARK), "pieces", _PARTS))


def parts_of(html) -> Column:
    return page_parts(markup_of(html))


def part_text(c) -> Column:
    """Text of a part: character references resolved, white space squeezed."""
    return squeeze(unescape(c))


def html_visible_text(html) -> Column:
    """All text a reader sees; null for a page without text."""
    return F.nullif(part_text(parts_of(html)["visible"]), F.lit(""))


def html_main_text(html) -> Column:
    return part_text(parts_of(html)["main"])


def heading_texts(headings, keep: int | None = None, chars: int | None = None) -> Column:
    texts = F.filter(F.transform(as_col(headings), lambda h: clip_text(unescape(h), chars)), lambda t: t.isNotNull())
    return texts if keep is None else F.slice(texts, 1, keep)


def html_headings(html, keep: int | None = None, chars: int | None = None) -> Column:
    return heading_texts(parts_of(html)["headings"], keep, chars)


def captcha_flag(title, text, words, pattern=presets.CAPTCHA_PATTERN,
                 max_words: int = presets.CAPTCHA_MAX_WORDS) -> Column:
    """A challenge page: the title says so, or a short text does."""
    in_title = matches(F.coalesce(as_col(title), F.lit("")), pattern)
    return in_title | ((as_col(words) < max_words) & matches(F.coalesce(as_col(text), F.lit("")), pattern))


def fetch_status(http_status, content_type, captcha) -> Column:
    """Outcome of a fetch; a missing HTTP status means there was no answer."""
    code = as_col(http_status)
    return (F.when(code.isNull(), F.lit("error"))
            .when(code.isin(401, 403, 429), F.lit("blocked"))
            .when(code >= 400, F.lit("http_error"))
            .when(~F.coalesce(F.lower(as_col(content_type)), F.lit("")).contains("html"), F.lit("not_html"))
            .when(as_col(captcha), F.lit("captcha"))
            .otherwise(F.lit("ok")))
