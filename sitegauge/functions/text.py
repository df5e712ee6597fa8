"""Column functions for names, texts, labels and numbers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegauge import presets

# Whitespace as Python sees it: Unicode spaces plus the four separator controls.
UNICODE_SPACES = r"(?U)[\s\x1c-\x1f]+"


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(name: str, value: str, body: str) -> str:
    """SQL text: `body` with `name` standing for `value`, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def by_sql(c, name: str, body: str) -> Column:
    """The SQL expression `body` of the column `c`, which goes by `name` in it.

    Long expressions are made from text: the parser takes them in one call, while a Python call for
    each of their parts would cost more than many a query."""
    return F.get(F.call_function("transform", F.array(as_col(c)), F.expr(f"{name} -> {body}")), F.lit(0))


def in_place(c) -> Column:
    """The same value, computed once and where it stands.

    Spark copies a deterministic expression into the filters that it moves below projections and shuffles, also into
    those that it makes up itself for an explode; an expression with the number of the task it leaves where it is."""
    return F.when(F.spark_partition_id() >= 0, as_col(c))


def clean_text(c) -> Column:
    """Runs of ASCII whitespace become one space; no space at either end."""
    return F.trim(F.regexp_replace(as_col(c), r"\s+", " "))


def squeeze(c) -> Column:
    """Like clean_text for Unicode whitespace; null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(as_col(c), F.lit("")), UNICODE_SPACES, " "))


def clip_text(c, limit: int | None = None) -> Column:
    """Squeezed text, whole or cut to `limit` characters; null when nothing is left."""
    text = squeeze(c)
    return F.nullif(text if limit is None else F.substring(text, 1, limit), F.lit(""))


def word_count(c) -> Column:
    """Words of a text, counted from its separators so no array is built."""
    text = squeeze(c)
    gaps = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return F.when(text == "", F.lit(0)).otherwise(gaps + 1).cast("int")


def brand_name(c, prefix=presets.BRAND_PREFIX, suffixes=tuple(presets.BRAND_SUFFIXES)) -> Column:
    """Short brand: no leading article, no single trailing legal or regional suffix."""
    tail = r"\s+(" + "|".join(suffixes) + ")$"
    return F.regexp_replace(F.regexp_replace(clean_text(c), prefix, ""), tail, "")


def text_fingerprint(text, fallback) -> Column:
    """SHA-256 of the text; a missing text takes the fallback so that nulls stay apart."""
    return F.sha2(F.coalesce(as_col(text), as_col(fallback)), 256)


def label_map(c, labels: dict) -> Column:
    """Label of a code; an unknown code is its own label."""
    pairs = [F.lit(x) for item in labels.items() for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), as_col(c)), as_col(c))


def tagline(description, heading, text, chars: int | None = None) -> Column:
    """Description, else heading, else the text, whole or its first `chars` characters."""
    lead = as_col(text) if chars is None else F.substring(as_col(text), 1, chars)
    return clean_text(F.coalesce(as_col(description), as_col(heading), lead))


def null_to_zero(c) -> Column:
    return F.coalesce(as_col(c), F.lit(0))


def presence_flag(c) -> Column:
    return as_col(c).isNotNull()


def default_label(c, label: str = "Other") -> Column:
    return F.coalesce(as_col(c), F.lit(label))


def city_case(c) -> Column:
    return F.initcap(clean_text(c))


def year_from_path(c, pattern=presets.YEAR_PATTERN) -> Column:
    """First 19xx/20xx path token as int, null when there is none."""
    return F.nullif(F.regexp_extract(as_col(c), pattern, 1), F.lit("")).try_cast("int")


def guarded_percent(part, whole, minimum: int) -> Column:
    """100*part/whole to one decimal, null while `whole` is below `minimum`."""
    return F.when(F.coalesce(as_col(whole), F.lit(0)) >= minimum,
                  F.round(F.try_divide(as_col(part) * 100, as_col(whole)), 1))


def last_segment(path) -> Column:
    """Last path segment without an html extension."""
    return F.regexp_replace(F.substring_index(as_col(path), "/", -1), r"\.html?$", "")


def product_name(heading, path, code_pattern=presets.MODEL_CODE_PATTERN) -> Column:
    """Heading up to the first bar; without a heading, the page address as a title."""
    slug = F.regexp_replace(last_segment(path), code_pattern, "")
    from_path = F.initcap(F.regexp_replace(slug, "[-_]+", " "))
    from_heading = F.regexp_replace(as_col(heading), r"\s*[|].*$", "")
    return clean_text(F.coalesce(from_heading, from_path))


def value_provenance(heading) -> Column:
    return F.when(as_col(heading).isNotNull(), F.lit("page heading")).otherwise(F.lit("page address"))


def format_phone(c) -> Column:
    """ddd-ddd-dddd for a valid North American number, else null."""
    digits = F.regexp_replace(F.regexp_replace(as_col(c), r"(?U)\D", ""), r"^1(?=\d{10}$)", "")
    valid = digits.rlike(r"^[2-9]\d{2}[2-9]\d{6}$")
    return F.when(valid, F.regexp_replace(digits, r"^(\d{3})(\d{3})(\d{4})$", "$1-$2-$3"))


def state_code(c, states: dict = presets.US_STATES) -> Column:
    return label_map(c, states)


def clean_city(c, street_words=tuple(presets.STREET_WORDS), directions=tuple(presets.DIRECTION_WORDS)) -> Column:
    """City without the street left in front of it: all up to the last street word goes,
    then any compass words that lead the rest."""
    street = r"^(?:.*\s)?[.,]*(?i:" + "|".join(street_words) + r")[.,]*(?:\s+|$)"
    compass = r"^(?:[.,]*(?i:" + "|".join(directions) + r")[.,]*(?:\s+|$))+"
    return F.regexp_replace(F.regexp_replace(squeeze(c), street, ""), compass, "")


def parse_address(c, pattern=presets.ADDRESS_VALUE_PATTERN) -> Column:
    """struct(city, state, zip) of "City, ST 12345", null for anything else."""
    text = as_col(c)
    parts = [F.regexp_extract(text, pattern, i).alias(n) for i, n in enumerate(["city", "state", "zip"], 1)]
    return F.when(text.rlike(pattern), F.struct(*parts))


def city_resolution(raw, looked_up) -> Column:
    """The cleaned city, else the looked-up one, else the raw text.  A cleaned city that is the
    looked-up one behind a leftover word gives way to it."""
    geo = as_col(looked_up)
    city = F.coalesce(F.nullif(clean_city(raw), F.lit("")), F.nullif(geo, F.lit("")), as_col(raw))
    return F.when(F.endswith(city, F.concat(F.lit(" "), F.nullif(geo, F.lit("")))), geo).otherwise(city)


def sentence_split(c) -> Column:
    return F.split(as_col(c), r"(?U)(?<=[.!?])\s+")
