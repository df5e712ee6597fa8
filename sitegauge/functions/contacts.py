"""Column functions that find phone numbers and postal addresses and score the evidence."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.functions.prefilter import matches
from sitegauge.functions.text import as_col, by_sql, clip_text, format_phone, let, sentence_split, state_code

CONTACT_TYPE = "array<struct<value:string,context:string,source:string>>"
#: Put around matches; a character that no text may hold, replaced where one does.
MARK = "\uffff"


def matches_in_context(text, pattern: str, width: int = presets.CONTACT_CONTEXT_CHARS, shortest: int = 10) -> Column:
    """All matches as array<struct<before, match, after>> with up to `width` characters on each side.

    One pass of the pattern puts marks around its matches, and the text is split at them, so every
    second piece is a match.  The surroundings come from the neighbouring pieces, of which only the
    ends are kept; neighbouring matches may share them.  `shortest`: no match is shorter, which
    bounds how many pieces the surroundings can reach over."""
    reach = 2 * -(-width // shortest) + 1
    plain = F.replace(as_col(text), F.lit(MARK), F.lit("\ufffd"))
    pieces = F.split(F.regexp_replace(plain, pattern, f"{MARK}$0{MARK}"), MARK)

    # place: of the match among the pieces, counted from 1
    one = f"""named_struct(
      'before', right(array_join(slice(tails, greatest(1, place - {reach}), place - greatest(1, place - {reach})), ''), {width}),
      'match', element_at(pieces, place), 'after', left(array_join(slice(heads, place + 1, {reach}), ''), {width}))"""
    typed = "array<struct<before:string,match:string,after:string>>"
    matches = f"transform(sequence(2, size(pieces) - 1, 2), place -> {one})"
    cut = let("tails", f"transform(pieces, x -> right(x, {width}))", let("heads", f"transform(pieces, x -> left(x, {width}))", matches))
    return F.coalesce(by_sql(pieces, "pieces", f"CASE WHEN size(pieces) > 1 THEN {cut} END").cast(typed), F.array().cast(typed))


def marked(m: Column) -> Column:
    """The match in double brackets inside its surroundings."""
    return F.concat(m["before"], F.lit("[["), m["match"], F.lit("]]"), m["after"])


def _contact(value: Column, context: Column, source: str) -> Column:
    return F.struct(value.alias("value"), context.alias("context"), F.lit(source).alias("source"))


def _valid(contacts: Column) -> Column:
    return F.filter(contacts, lambda c: c["value"].isNotNull())


def extract_text_phones(text, pattern=presets.PHONE_PATTERN) -> Column:
    found = matches_in_context(text, "(?U:" + pattern + ")")
    return _valid(F.transform(found, lambda m: _contact(format_phone(m["match"]), marked(m), "text")))


def extract_tel_links(links) -> Column:
    tel = F.filter(as_col(links), lambda l: F.lower(l).startswith("tel:"))
    return _valid(F.transform(tel, lambda l: _contact(format_phone(F.substr(l, F.lit(5))), l, "tel_link")))


def address_pattern(states: dict = presets.US_STATES) -> str:
    """City words, then a state name or code, then a ZIP code.  No capturing groups."""
    names = "|".join(sorted(states, key=len, reverse=True))
    codes = "|".join(sorted(set(states.values())))
    return rf"\b{presets.CITY_WORDS_PATTERN},?\s+(?:{names}|{codes})[.,]?\s+\d{{5}}(?:-\d{{4}})?\b"


def address_value(match, states: dict = presets.US_STATES) -> Column:
    """"City, ST 12345" from a matched address."""
    names = "|".join(sorted(states, key=len, reverse=True))
    codes = "|".join(sorted(set(states.values())))
    rx = rf"(?U)^({presets.CITY_WORDS_PATTERN}),?\s+({names}|{codes})[.,]?\s+(\d{{5}})"
    m = as_col(match)
    city, state, zip_code = (F.regexp_extract(m, rx, i) for i in (1, 2, 3))
    return F.concat(city, F.lit(", "), state_code(state, states), F.lit(" "), zip_code)


def extract_text_addresses(text, states: dict = presets.US_STATES) -> Column:
    found = matches_in_context(text, "(?U:" + address_pattern(states) + ")")
    return F.transform(found, lambda m: _contact(address_value(m["match"], states), marked(m), "text"))


def extract_jsonld_phones(blocks) -> Column:
    def phones(block):
        raw = F.regexp_extract_all(block, F.lit(presets.JSON_LD_PHONE_PATTERN), F.lit(1))
        context = clip_text(block)
        return F.transform(raw, lambda p: _contact(format_phone(p), context, "json_ld"))

    return _valid(F.flatten(F.transform(as_col(blocks), phones)))


def extract_jsonld_addresses(blocks, states: dict = presets.US_STATES) -> Column:
    """One address per block that has a postal code and a region; the locality may be missing."""
    def address(block):
        postal = F.nullif(F.regexp_extract(block, presets.JSON_LD_POSTAL_PATTERN, 1), F.lit(""))
        region = F.nullif(F.regexp_extract(block, presets.JSON_LD_REGION_PATTERN, 1), F.lit(""))
        city = F.nullif(F.regexp_extract(block, presets.JSON_LD_LOCALITY_PATTERN, 1), F.lit(""))
        tail = F.concat(state_code(region, states), F.lit(" "), postal)
        value = F.coalesce(F.concat(city, F.lit(", "), tail), tail)
        return _contact(value, clip_text(block), "json_ld")

    return _valid(F.transform(as_col(blocks), address))


def contacts_first_wins(candidates, keep: int | None = None) -> Column:
    """First candidate of each value, in order; with `keep`, of the first `keep` values.

    Candidates are sorted by value and place, the first of each run stays, and those are sorted by
    place again.  Each step is bound to a lambda variable, so it is computed once per page."""
    firsts = "filter(placed, (x, k) -> k = 0 OR placed[k - 1].v != x.v)"
    order = f"array_sort(transform({firsts}, x -> x.i))"
    chosen = order if keep is None else f"slice({order}, 1, {keep})"
    return by_sql(candidates, "found", let(
        "placed", "array_sort(transform(found, (c, i) -> named_struct('v', c.value, 'i', i)))", f"transform({chosen}, i -> found[i])"))


def page_phones(text, links, blocks) -> Column:
    found = F.concat(extract_text_phones(text), extract_tel_links(links), extract_jsonld_phones(blocks))
    return contacts_first_wins(found.cast(CONTACT_TYPE))


def page_addresses(text, blocks) -> Column:
    found = F.concat(extract_text_addresses(text), extract_jsonld_addresses(blocks))
    return contacts_first_wins(found.cast(CONTACT_TYPE))


def text_before(context) -> Column:
    """What stands in front of the marked match; the whole context when nothing is marked."""
    return F.substring_index(F.coalesce(as_col(context), F.lit("")), "[[", 1)


def text_after(context) -> Column:
    """What stands behind the first marked match; '' when nothing is marked."""
    c = as_col(context)
    return F.when(c.contains("]]"), F.substr(c, F.instr(c, "]]") + 2)).otherwise(F.lit(""))


def _score(points: int, label) -> Column:
    name = label if isinstance(label, Column) else F.lit(label)
    return F.struct(F.lit(points).alias("score"), name.alias("match"))


def score_address(context, source, url) -> Column:
    """struct(score, match): words for a head office in front, structured data, contact page, other."""
    return (F.when(matches(text_before(context), presets.HQ_PATTERN), _score(3, "stated headquarters"))
            .when(as_col(source) == "json_ld", _score(2, "structured data"))
            .when(matches(url, presets.CONTACT_URL_PATTERN), _score(1, "contact or about page"))
            .otherwise(_score(0, "most frequent on site")))


def score_phone(context, source, url) -> Column:
    """As score_address, phone links count as structured; null for a fax number."""
    before = text_before(context)
    fax = F.right(before, F.lit(presets.FAX_WINDOW_RANKING)).rlike(presets.FAX_PATTERN)
    structured = F.when(as_col(source) == "tel_link", F.lit("phone link")).otherwise(F.lit("structured data"))
    return (F.when(~fax & matches(before, presets.HQ_PATTERN), _score(3, "stated headquarters"))
            .when(~fax & as_col(source).isin("tel_link", "json_ld"), _score(2, structured))
            .when(~fax & matches(url, presets.CONTACT_URL_PATTERN), _score(1, "contact or about page"))
            .when(~fax, _score(0, "most frequent on site")))


def phone_next_to_address(context) -> Column:
    """First number behind the address that is not announced as a fax, as ddd-ddd-dddd."""
    after, width = text_after(context), presets.FAX_WINDOW_AFTER_ADDRESS
    found = matches_in_context(after, "(?U:" + presets.PHONE_AFTER_ADDRESS_PATTERN + ")", width)
    voice = F.filter(found, lambda m: ~m["before"].rlike(presets.FAX_PATTERN))
    first = F.get(voice, F.lit(0))["match"]
    return F.regexp_replace(F.right(F.regexp_replace(first, r"(?U)\D", ""), F.lit(10)),
                            r"^(\d{3})(\d{3})(\d{4})$", "$1-$2-$3")


def founded_years(text, own_words: bool) -> Column:
    """Founding years a text states, as array<int>.

    With own_words only sentences in the first person count that are not about a place, an award
    or a partner."""
    t = F.coalesce(as_col(text), F.lit(""))
    rx = F.lit("(?U)" + presets.FOUNDED_PATTERN)
    if own_words:
        said = F.filter(sentence_split(t), lambda s: s.rlike(presets.FIRST_PERSON_PATTERN)
                        & ~s.rlike(presets.NOT_FOUNDING_PATTERN))
        years = F.flatten(F.transform(said, lambda s: F.regexp_extract_all(s, rx, F.lit(1))))
    else:
        years = F.regexp_extract_all(t, rx, F.lit(1))
    hit = t.rlike("(?U)" + presets.FOUNDED_PATTERN)
    return F.when(hit, years.cast("array<int>")).otherwise(F.array().cast("array<int>"))
