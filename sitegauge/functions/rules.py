"""Ordered rules and per-site settings, both given as data."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.functions import urls
from sitegauge.functions.prefilter import first_match, matches
from sitegauge.functions.text import as_col


def category_code(path, rules=tuple(presets.CATEGORY_RULES)) -> Column:
    """Small integer for the (category, segment) of the first matching rule, null without a match.

    One CASE over the rules; a rule whose words are not in the path is not tried.  Rules with the
    same category share a code, so the code can be the grouping key and the names are looked up
    after the aggregation."""
    names = category_names(rules)
    return first_match(path, [p for _, _, p in rules], [names.index((c, s)) for c, s, _ in rules])


def category_names(rules=tuple(presets.CATEGORY_RULES)) -> list:
    return list(dict.fromkeys((category, segment) for category, segment, _ in rules))


def category_of(code, rules=tuple(presets.CATEGORY_RULES)) -> Column:
    return F.get(F.array(*[F.lit(c) for c, _ in category_names(rules)]), as_col(code))


def segment_of(code, rules=tuple(presets.CATEGORY_RULES)) -> Column:
    return F.get(F.array(*[F.lit(s) for _, s in category_names(rules)]), as_col(code))


def rule_first_match(path, rules=tuple(presets.CATEGORY_RULES)) -> Column:
    """struct(category, segment) of the first matching rule, null when none matches."""
    code = category_code(path, rules)
    pairs = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(s).alias("segment"))
                      for c, s in category_names(rules)])
    return F.get(pairs, code)


def exclude_non_product(path, pattern=presets.NOT_PRODUCT_PATTERN) -> Column:
    return ~matches(path, pattern)


def keyword_or_filter(path, heading, path_pattern=presets.ELECTRIC_PATH_PATTERN,
                      heading_pattern=presets.ELECTRIC_HEADING_PATTERN) -> Column:
    """Keyword in the address or in the heading; a missing heading has no keyword."""
    return matches(path, path_pattern) | F.coalesce(matches(heading, heading_pattern), F.lit(False))


def custom_sort_order(c, order=tuple(presets.CATEGORY_ORDER)) -> Column:
    """1-based display position in a fixed list; values outside the list come last."""
    position = F.array_position(F.array(*[F.lit(v) for v in order]), as_col(c))
    return F.when(position > 0, position).otherwise(F.lit(len(order) + 1)).cast("int")


def word_pattern(words) -> str:
    """Whole words of a path, where / - _ . separate words."""
    return r"(?:^|[/_.-])(?:" + "|".join(words) + r")(?:$|[/_.-])"


def page_type(path, product_pattern=None, words=tuple(presets.PAGE_TYPE_WORDS)) -> Column:
    """Type of a page from its path.  A site's own product pattern comes before the word rules and
    switches the general product rule off."""
    text = as_col(path)
    site = product_pattern if isinstance(product_pattern, Column) else F.lit(product_pattern).cast("string")
    chosen = (F.when(urls.is_document(text), F.lit("document"))
              .when(~text.rlike("[^/]"), F.lit("home"))
              .when(F.coalesce(F.rlike(text, site), F.lit(False)), F.lit("product")))
    for name, tokens in words:
        hit = matches(text, word_pattern(tokens))
        if name == "product":
            hit = site.isNull() & hit
        chosen = chosen.when(hit, F.lit(name))
    return chosen.otherwise(F.lit("other"))


def rules_table(spark: SparkSession, rules: dict = presets.SITE_RULES) -> DataFrame:
    """Per-site settings as a table; what a rule leaves out is null."""
    fields = ["base_url", "start_url", "sitemaps", "exclude", "product_pattern", "category_segment"]
    rows = [(host, *[rule.get(f) for f in fields]) for host, rule in rules.items()]
    return spark.createDataFrame(rows, "host string, base_url string, start_url string, "
                                       "sitemaps array<string>, exclude string, product_pattern string, "
                                       "category_segment int")


def site_rule_defaults(sites: DataFrame, rules: DataFrame, url: str = "company_site_url") -> DataFrame:
    """Each site with its settings; no rule, or no value in it, means the default."""
    keyed = sites.withColumn("host", urls.url_host(url))
    settings = rules.select(
        "host", F.col("base_url").alias("rule_base"), F.col("start_url").alias("rule_start"),
        "sitemaps", "exclude", "product_pattern", F.col("category_segment").alias("rule_segment"))
    base = F.coalesce("rule_base", url)
    default_segment = presets.SITE_RULE_DEFAULTS["category_segment"]
    return keyed.join(settings, "host", "left").select(
        *[c for c in keyed.columns], base.alias("base_url"),
        F.coalesce(F.col("rule_start"), base).alias("start_url"),
        "sitemaps", "exclude", "product_pattern",
        F.coalesce("rule_segment", F.lit(default_segment)).alias("category_segment"))
