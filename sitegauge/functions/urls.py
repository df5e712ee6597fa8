"""Column functions for page addresses."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.functions.html import unescape
from sitegauge.functions.text import as_col

ORIGIN = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*"


def _scheme_and_host(url: Column) -> Column:
    return F.regexp_extract(url, ORIGIN, 0)


def clean_url(c) -> Column:
    """Address without path parameters, query and fragment; scheme and host in lower case."""
    raw = F.btrim(as_col(c))
    raw = F.when(raw.contains("&"), unescape(raw)).otherwise(raw)
    bare = F.substring_index(F.substring_index(raw, "#", 1), "?", 1)
    origin = _scheme_and_host(bare)
    path = F.regexp_replace(F.substr(bare, F.length(origin) + 1), r";[^/]*$", "")
    return F.regexp_replace(F.concat(F.lower(origin), path), r"^([^/]*//[^/]*)$", "$1/")


def key_of_clean_url(c) -> Column:
    """Deduplication key of an address that clean_url has already been applied to."""
    return F.lower(F.regexp_replace(as_col(c), "/+$", ""))


def url_key(c) -> Column:
    return key_of_clean_url(clean_url(c))


def url_host(c) -> Column:
    """Host in lower case without a leading www."""
    host = F.regexp_extract(as_col(c), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.regexp_replace(F.lower(host), r"^www\.", "")


def base_key(c) -> Column:
    return F.lower(F.regexp_replace(as_col(c), "/+$", ""))


def relative_path_of_key(key, base) -> Column:
    """Path of a url_key below a base address: '' for the base itself, null outside it."""
    k, b = as_col(key), base_key(base)
    return F.when(k == b, F.lit("")).when(
        F.startswith(k, F.concat(b, F.lit("/"))), F.substr(k, F.length(b) + 2))


def relative_path(url, base) -> Column:
    return relative_path_of_key(url_key(url), base)


def within_base(url, base) -> Column:
    return relative_path(url, base).isNotNull()


def exclude_paths(path, pattern) -> Column:
    """True for a path to keep; a null pattern (a column or a string) excludes nothing."""
    rx = pattern if isinstance(pattern, Column) else F.lit(pattern)
    return ~F.coalesce(F.rlike(as_col(path), rx), F.lit(False))


def path_segments(path) -> Column:
    parts = F.filter(F.split(as_col(path), "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.regexp_replace(s, r"\.html?$", ""))


def path_section(segments) -> Column:
    return F.coalesce(F.get(as_col(segments), F.lit(0)), F.lit(""))


def path_depth(segments) -> Column:
    return F.size(as_col(segments))


def path_category(segments, page_type, index) -> Column:
    """The index-th segment of a product page, null when the path is too short."""
    i = index if isinstance(index, Column) else F.lit(index)
    return F.when(as_col(page_type) == "product", F.get(as_col(segments), i))


def is_document(path, pattern=presets.DOCUMENT_PATTERN) -> Column:
    return as_col(path).rlike(pattern)


def resolve_url(base, href) -> Column:
    """Link target as a browser resolves it against the page address."""
    b, h = as_col(base), F.btrim(as_col(href))
    origin = _scheme_and_host(b)
    scheme = F.regexp_extract(b, r"^[A-Za-z][A-Za-z0-9+.-]*:", 0)
    no_fragment = F.substring_index(b, "#", 1)
    no_query = F.substring_index(no_fragment, "?", 1)
    path = F.substr(no_query, F.length(origin) + 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, "[^/]*$", ""))
    target = (
        F.when(h == "", no_fragment)
        .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, h))
        .when(h.startswith("#"), F.concat(no_fragment, h))
        .when(h.startswith("?"), F.concat(no_query, h))
        .when(h.startswith("/"), F.concat(origin, h))
        .otherwise(F.concat(origin, folder, h))
    )
    dotted = ~h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") & h.rlike(r"(^|/)\.\.?(/|$|[?#])")
    return F.when(dotted, _without_dot_segments(target)).otherwise(target)


def _without_dot_segments(url: Column) -> Column:
    origin = _scheme_and_host(url)
    path = F.regexp_extract(F.substr(url, F.length(origin) + 1), r"^[^?#]*", 0)
    tail = F.substr(url, F.length(origin) + F.length(path) + 1)
    ends_open = path.rlike(r"/\.\.?$")

    def step(kept, part):
        return (F.when(part == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1))))
                .when(part == ".", kept)
                .otherwise(F.concat(kept, F.array(part))))

    parts = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step)
    return F.concat(origin, F.array_join(parts, "/"), F.when(ends_open, F.lit("/")).otherwise(F.lit("")), tail)
