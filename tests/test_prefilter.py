"""The words that a pattern needs."""

import random
import re

import pytest

from sitegauge import presets
from sitegauge.functions.prefilter import matches, needed_words

EVERY = [p for _, _, p in presets.CATEGORY_RULES] + list(presets.TECH_THEMES.values()) + [
    presets.NOT_PRODUCT_PATTERN, presets.ELECTRIC_PATH_PATTERN, presets.ELECTRIC_HEADING_PATTERN, presets.ELECTRIC_LANDING_PATTERN,
    presets.CAPTCHA_PATTERN, presets.HQ_PATTERN, presets.FOUNDED_PATTERN, presets.NOT_FOUNDING_PATTERN, presets.CONTACT_PAGE_PATTERN]


@pytest.mark.parametrize("pattern, words, ignore", [
    ("loader", ["loader"], False), ("(?i)Loader", ["loader"], True), ("a|loader", [], False), ("loaders?|dozer", ["dozer", "loader"], False),
    ("(^|/)(blades?|buckets?)(/|$)", ["blade", "bucket"], False), ("lo+ad", ["lo"], False), ("lo{0,3}adx", ["adx"], False), ("[abc]+", [], False),
    ("^(?!.*roller).*(dozer)", ["dozer"], False), ("(dozer)?crane", ["crane"], False), ("(dozer)*", [], False), (r"a\.bc\d", ["a.bc"], False),
    (r"(?iU)\b(the)\b", [], False), (r"\Qa.b\E", [], False), ("(?x) a b c", [], False), ("[[a]b]cde", [], False), ("", [], False), ("abc|", [], False),
    (r"\bnet[- ]zero\b", ["zero"], False), ("(ab|cd)(efgh|ijkl)", ["efgh", "ijkl"], False), ("mini-ex(/|-|$)", ["mini-ex"], False), ("[]x]yz", ["yz"], False)])
def test_words(pattern, words, ignore):
    found = needed_words(pattern)
    assert set(found[0]) == set(words)
    assert not words or found[1] == ignore


def test_every_match_holds_a_word():
    rng = random.Random(3)
    bits = sorted({w for p in EVERY for w in re.findall("[A-Za-z0-9-]+", p)}) + list("/-_ .s")
    for pattern in EVERY:
        words, ignore = needed_words(pattern)
        assert words
        for _ in range(300):
            text = rng.choice(["", "/", " "]) + rng.choice(["", "/", " ", "-"]).join(rng.choice(bits) for _ in range(rng.randint(1, 6)))
            text = text.upper() if rng.random() < 0.2 else text
            if words and re.search(pattern, text):
                assert any(w in (text.lower() if ignore else text) for w in words), (pattern, text)


def test_same_rows_as_the_pattern_alone(spark):
    texts = ["mini-excavators/x", "engine-powered-lift/x", "engine/x", None, "", "x/buckets", "x/bucketsful", "Electric", "zero emission", "ZERO-EMISSIONS.", "net zero", "Tier 4"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    patterns = EVERY
    row = df.select(*[matches("t", p).alias(f"m{i}") for i, p in enumerate(patterns)], *[df.t.rlike(p).alias(f"r{i}") for i, p in enumerate(patterns)])
    for r in row.collect():
        assert list(r)[:len(patterns)] == list(r)[len(patterns):]
