"""Choice of the best supported value per company."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegauge.functions import text as X
from sitegauge.operators.joins import lookup_join
from sitegauge.operators.ranking import first_per_group
from sitegauge.sources.staging import staged


def explode_contacts(pages: DataFrame, contacts: str, site: str = "serial_no", url: str = "url") -> DataFrame:
    return (pages.select(site, url, F.explode(contacts).alias("_c"))
            .select(site, url, "_c.value", "_c.context", "_c.source"))


def evidence_page_support(candidates: DataFrame, site: str = "serial_no") -> DataFrame:
    """Distinct pages on which each value stands."""
    return candidates.groupBy(site, "value").agg(F.count_distinct("url").alias("pages"))


def pick_best_evidence(candidates: DataFrame, score: Column, site: str = "serial_no") -> DataFrame:
    """Per site the value with the highest score, then the most pages, then the smallest value.

    Its evidence is the candidate with the highest score, then the smallest address and context.
    The scored candidates are written once.  Values are chosen on their keys alone, by hash
    aggregations; contexts are only looked at for the chosen ones, and every map task keeps one."""
    scored = candidates.withColumn("_s", score).where(F.col("_s").isNotNull()).select(
        site, "value", "url", "context", F.col("_s.score").alias("score"), F.col("_s.match").alias("match"))
    scored = staged(scored, "evidence")
    values = scored.groupBy(site, "value").agg(F.max("score").alias("score"), F.count_distinct("url").alias("pages"))
    chosen = first_per_group(values, [site], [F.desc("score"), F.desc("pages"), "value"])
    keys = [site, "value", "score"]
    own = lookup_join(scored.where(F.col("value").isNotNull()), chosen, keys, "inner", spread=["url"])
    return first_per_group(own, [site], ["url", "context", "match"]).select(site, "value", "score", "pages", "match", "url", "context")


def earliest_founding(pages: DataFrame, years: Column, as_of_year: int, min_year: int,
                      site: str = "serial_no") -> DataFrame:
    """Smallest plausible year per site and the smallest address that states it."""
    plausible = F.filter(years, lambda y: y.between(min_year, as_of_year))
    first = X.in_place(F.array_min(plausible))
    stated = pages.select(site, "url", first.alias("year")).where(F.col("year").isNotNull())
    return (stated.groupBy(site).agg(F.min(F.struct("year", "url")).alias("_f"))
            .select(site, F.col("_f.year").alias("founded_year"), F.col("_f.url").alias("founded_source_url")))


def geo_lookup(addresses: DataFrame, gazetteer: DataFrame, spread=("serial_no",)) -> DataFrame:
    """Coordinates by ZIP code; an entry that lies in another state does not count.

    The gazetteer is first reduced to one row per ZIP code that holds one place per state, so no
    address is doubled.  The place of the address's own state comes before one without a state."""
    columns = ["latitude", "longitude", "geocoded_city", "geocoded_place"]
    places = (gazetteer.groupBy("zip", F.upper("state").alias("_state")).agg(F.min(F.struct(*columns)).alias("_at"))
              .groupBy("zip").agg(F.collect_list(F.struct("_state", "_at")).alias("_places")))
    joined = lookup_join(addresses, places, "zip", "left", spread=spread)
    own = F.get(F.filter("_places", lambda p: p["_state"] == F.col("state")), F.lit(0))
    any_state = F.get(F.filter("_places", lambda p: p["_state"].isNull() & F.col("state").isNotNull()), F.lit(0))
    place = F.coalesce(own, any_state)["_at"]
    return joined.select(*addresses.columns, *[place[c].alias(c) for c in columns])


def known_locations(previous: DataFrame) -> DataFrame:
    """One location per (state, zip) out of an earlier contacts table."""
    place = F.struct("latitude", "longitude", "geocoded_city", "geocoded_place")
    return (previous.where(F.col("latitude").isNotNull()).groupBy("state", "zip").agg(F.min(place).alias("_p"))
            .select("state", "zip", "_p.*"))


def geo_cache_reuse(addresses: DataFrame, previous: DataFrame, gazetteer: DataFrame,
                    spread=("serial_no",)) -> DataFrame:
    """Earlier coordinates where the (state, zip) is known, the gazetteer for the rest."""
    columns = ["latitude", "longitude", "geocoded_city", "geocoded_place"]
    known = known_locations(previous).select("state", "zip", F.struct(*columns).alias("_known"))
    looked_up = geo_lookup(addresses, gazetteer, spread)
    joined = lookup_join(looked_up, known, ["state", "zip"], "left", spread=spread)
    return joined.select(*addresses.columns, *[
        F.when(F.col("_known").isNotNull(), F.col(f"_known.{c}")).otherwise(F.col(c)).alias(c) for c in columns])


def missing_locations(addresses: DataFrame, previous: DataFrame) -> DataFrame:
    """(state, zip) pairs that no earlier run has located."""
    return (addresses.select("state", "zip").distinct()
            .join(known_locations(previous).select("state", "zip"), ["state", "zip"], "left_anti"))
