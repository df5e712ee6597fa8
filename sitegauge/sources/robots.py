"""Texts of robots.txt to access rules.

Input: (host, http_status, text), one row per host; a null status means no answer.  The order of
lines matters only inside one file, so the windows here run over the lines of one file each.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitegauge.functions.text import as_col
from sitegauge.functions.urls import ORIGIN
from sitegauge.operators.joins import lookup_join

RULE_KEYS = ["allow", "disallow", "crawl-delay", "request-rate"]


def _lines(files: DataFrame) -> DataFrame:
    """One row per line with its kind and the number of the agent group it is in."""
    body = F.btrim(F.substring_index("line", "#", 1))
    split = F.when(body.contains(":"), F.instr(body, ":"))
    key = F.lower(F.btrim(F.substr(body, F.lit(1), split - 1)))
    parsed = (
        files.select("host", F.posexplode(F.split("text", r"\r\n|[\n\r]")).alias("position", "line"))
        .withColumn("key", key)
        .withColumn("value", F.btrim(F.substr(body, split + 1)))
        .withColumn("kind", F.when(F.col("line") == "", F.lit("blank"))
                    .when(F.col("key") == "user-agent", F.lit("agent"))
                    .when(F.col("key").isin(RULE_KEYS), F.lit("rule"))
                    .when(F.col("key") == "sitemap", F.lit("sitemap")))
        .where(F.col("kind").isNotNull())
    )
    file = Window.partitionBy("host").orderBy("position")
    before = file.rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("kind") != "sitemap", F.col("kind")), ignorenulls=True).over(before)
    opened = F.last(F.when(F.col("kind").isin("blank", "agent"), F.col("kind")), ignorenulls=True).over(before)
    starts = (F.col("kind") == "agent") & F.coalesce(last != "agent", F.lit(True))
    return (parsed.withColumn("_starts", starts)
            .withColumn("in_group", F.coalesce(opened == "agent", F.lit(False)))
            .withColumn("group_no", F.sum(F.col("_starts").cast("int")).over(file)).drop("_starts"))


def robots_rules(files: DataFrame) -> DataFrame:
    """Rule rows (host, group_no, agent, position, allow, prefix) in file order."""
    lines = _lines(files)
    rules = lines.where((F.col("kind") == "rule") & F.col("in_group") & F.col("key").isin("allow", "disallow")).select(
        "host", "group_no", "position",
        ((F.col("key") == "allow") | (F.col("value") == "")).alias("allow"), F.col("value").alias("prefix"))
    agents = lines.where(F.col("kind") == "agent").select("host", "group_no", F.lower("value").alias("agent"))
    return rules.join(agents.distinct(), ["host", "group_no"])


def robots_policy(files: DataFrame, agent: str) -> DataFrame:
    """One row per host: verdict (allow_all, deny_all, rules) and, for one robot, the rules of its
    group as an ordered array, the crawl delay and the sitemaps named."""
    lines = _lines(files)
    token = agent.split("/")[0].lower()
    groups = lines.groupBy("host", "group_no").agg(
        F.bool_or((F.col("kind") == "agent") & (F.col("value") == "*")).alias("general"),
        F.bool_or((F.col("kind") == "agent") & F.contains(F.lit(token), F.lower("value"))).alias("named"),
        F.bool_or((F.col("kind") == "rule") & F.col("in_group")).alias("has_rules"),
        F.array_sort(F.collect_list(F.when(
            (F.col("kind") == "rule") & F.col("in_group") & F.col("key").isin("allow", "disallow"),
            F.struct("position", ((F.col("key") == "allow") | (F.col("value") == "")).alias("allow"),
                     F.col("value").alias("prefix"))))).alias("rules"),
        F.max_by("value", F.when((F.col("key") == "crawl-delay") & F.col("in_group")
                                 & F.col("value").rlike("^[0-9]+$"), F.col("position"))).alias("delay"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "sitemap", F.struct("position", "value")))).alias("maps"),
    )
    usable = F.col("has_rules")
    order = F.when(usable & F.col("named") & ~F.col("general"), F.struct(F.lit(0), F.col("group_no"))).when(
        usable & F.col("general"), F.struct(F.lit(1), F.col("group_no")))
    chosen = groups.groupBy("host").agg(
        F.min_by("rules", order).alias("rules"),
        F.min_by("delay", order).try_cast("int").alias("crawl_delay"),
        F.flatten(F.array_sort(F.collect_list("maps"))).alias("maps"))
    status = F.col("http_status")
    verdict = (F.when(status.isin(401, 403), F.lit("deny_all"))
               .when(status.isNull() | (status >= 400), F.lit("allow_all")).otherwise(F.lit("rules")))
    return files.select("host", F.col("http_status").alias("robots_http_status"), verdict.alias("verdict")).join(
        chosen, "host", "left").select(
        "host", "robots_http_status", "verdict",
        F.when(F.col("verdict") == "rules", F.col("rules")).alias("rules"),
        F.when(F.col("verdict") == "rules", F.col("crawl_delay")).alias("crawl_delay"),
        F.when(F.col("verdict") == "rules", F.transform(F.array_sort("maps"), lambda m: m["value"])).alias("sitemaps"))


def _decoded(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def allowed(url, verdict, rules) -> Column:
    """Access decision: the first rule whose prefix fits decides; without one the page is open."""
    rest = F.regexp_replace(as_col(url), ORIGIN, "")
    path = _decoded(F.when(rest == "", F.lit("/")).otherwise(rest))
    fitting = F.filter(as_col(rules), lambda r: (r["prefix"] == "*") | F.startswith(path, _decoded(r["prefix"])))
    return (F.when(as_col(verdict) == "deny_all", F.lit(False))
            .when(as_col(verdict) == "rules", F.coalesce(F.get(fitting, F.lit(0))["allow"], F.lit(True)))
            .otherwise(F.lit(True)))


def robots_allow(urls: DataFrame, policy: DataFrame, url: str = "url") -> DataFrame:
    """Add `allowed`.  The rules of a host travel as one array, so an address is checked in its own
    row and never paired with the rules; hot hosts are salted."""
    kept = policy.select("host", "verdict", "rules")
    return (lookup_join(urls, kept, "host", "left", spread=[url])
            .withColumn("allowed", allowed(url, "verdict", "rules")).drop("verdict", "rules"))
