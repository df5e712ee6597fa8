"""Host-level quality rules in DataFrame functions.

Each document is measured once.  How often its documents fail a rule is counted per host; the rates are shrunk towards
the corpus by a beta prior whose mean and strength are found from the hosts themselves; hosts whose shrunk rate is too
high are rejected as a whole, and that verdict is joined back to their documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.common import OWN, named, staged, whole_text

WORD = r"[^\x20\x09-\x0D]+"
#: Document rules: least words; most words in repeated windows, symbols per character, repeated lines (shares); and
#: the shrunk rate of failing documents beyond which a host is rejected.
MIN_WORDS, MAX_REPEATED, MAX_SYMBOLS, MAX_DUP_LINES, MAX_HOST_RATE = 50, 0.5, 0.1, 0.5, 0.6
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RULES = ("short", "repeated", "symbols", "dup_lines")


def words_in_repeats(words: Column) -> Column:
    """How many words lie in a window of three words that is found twice or more.

    Windows are sorted by their 64-bit hash with their place, so that equal ones are neighbours; the places of those
    are sorted again and each adds the words that its window has before the next one begins.
    """
    at = lambda i: F.get(words, i)
    windows = F.transform(
        words, lambda w, i: F.struct(F.xxhash64(w, at(i + 1), at(i + 2)).alias("h"), i.alias("i")))
    return F.sort_array(F.slice(windows, 1, F.greatest(F.size(words) - 2, F.lit(0))))


def measured(documents: DataFrame) -> DataFrame:
    """`documents` with the measures under own names; texts stay in their row, nothing is shuffled."""
    own = lambda name: f"{OWN}{name}"
    text, words, order, places = F.col(own("text")), F.col(own("words")), F.col(own("order")), F.col(own("places"))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = documents.withColumn(own("text"), whole_text())
    df = df.withColumns({own("words"): F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), own("lines"): lines})
    df = df.withColumn(own("order"), words_in_repeats(words))
    hash_at = lambda i: F.get(order, i)["h"]
    df = df.withColumn(own("places"), F.array_sort(F.transform(
        F.filter(order, lambda x, i: (x["h"] == hash_at(i + 1)) | (x["h"] == hash_at(i - 1))), lambda x: x["i"])))
    following = lambda i: F.coalesce(F.get(places, i + 1), F.lit(1 << 30))
    covered = F.aggregate(
        F.transform(places, lambda p, i: F.least(F.lit(3), following(i) - p)), F.lit(0), lambda a, x: a + x)
    df = df.withColumns({
        own("n_words"): F.size(words).cast("long"),
        own("word_chars"): (F.length(text) - F.length(F.regexp_replace(text, WORD, ""))).cast("long"),
        own("n_symbols"): F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long"),
        own("n_lines"): F.size(own("lines")).cast("long"),
        own("n_dup_lines"): (F.size(own("lines")) - F.size(F.array_distinct(own("lines")))).cast("long"),
        own("n_repeat_words"): covered.cast("long"),
    })
    return df.drop(*map(own, ("text", "words", "lines", "order", "places")))


def failures() -> dict[str, Column]:
    """Rule -> whether a measured document fails it."""
    c = lambda name: F.col(f"{OWN}{name}")
    return {
        "short": c("n_words") < MIN_WORDS,
        "repeated": c("n_repeat_words") * 100 > c("n_words") * int(100 * MAX_REPEATED),
        "symbols": c("n_symbols") * 100 > c("word_chars") * int(100 * MAX_SYMBOLS),
        "dup_lines": c("n_dup_lines") * 100 > c("n_lines") * int(100 * MAX_DUP_LINES),
    }


def host_verdicts(facts: DataFrame, host: str, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: counts, the shrunk rate per rule and whether the host is rejected.

    `facts`: a row per document with `host` and one boolean per rule.  The prior of a rule has the corpus rate as mean;
    its strength comes from the variance between hosts beyond what chance alone would give.  Rows without a host get
    no verdict.
    """
    counts = facts.where(F.col(host).isNotNull()).groupBy(host).agg(
        F.count("*").alias("n"), *(F.sum(F.col(r).cast("long")).alias(r) for r in RULES))
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("hosts"), *(F.sum(r).alias(r) for r in RULES)).first()
    if not total["n"]:
        return counts.select(host, *(F.lit(0.0).alias(f"{r}_rate") for r in RULES), F.lit(False).alias("rejected"))
    mean = {r: total[r] / total["n"] for r in RULES}
    spread = counts.agg(*(F.sum(F.col("n") * (F.col(r) / F.col("n") - mean[r]) ** 2).alias(r) for r in RULES)).first()
    rates = {}
    for r in RULES:
        chance = mean[r] * (1 - mean[r])
        between = max((spread[r] - chance * (total["hosts"] - 1)) / total["n"], 0.0)
        strength = min(max(chance / between - 1, 1.0), 1e6) if between > 0 else 1e6
        rates[f"{r}_rate"] = (F.col(r) + mean[r] * strength) / (F.col("n") + strength)
    worst = F.greatest(*rates.values())
    return counts.select(host, *(v.alias(k) for k, v in rates.items()), (worst > max_rate).alias("rejected"))


def rejected_hosts(facts: DataFrame, host: str) -> DataFrame:
    return host_verdicts(facts, host).where("rejected").select(F.col(host).alias(f"{OWN}rejected_host"))


def judge(documents: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, the measures, base_failed, host_failed, kept of every row.

    Null and empty texts have no words and fail; repeated rows are each judged and each count for their host; rows
    without a host stand for themselves; an empty table gives no rows; other columns are ignored.  A document is kept
    if it fails no rule itself and its host is not rejected.
    """
    own = lambda name: F.col(f"{OWN}{name}")
    fails = failures()
    narrow = documents.select("doc_id", "text", F.col(host).cast("string").alias("host"))
    facts = measured(narrow).select(
        "doc_id", "host", *(own(m).alias(m) for m in MEASURES), *(F.coalesce(v, F.lit(False)).alias(k) for k, v in fails.items()))
    facts = staged(facts, "host-rules")
    bad = rejected_hosts(facts, "host")
    verdict = facts.join(bad, facts["host"] == bad[f"{OWN}rejected_host"], "left")
    base, host_failed = F.col("short") | F.col("repeated"), F.col(f"{OWN}rejected_host").isNotNull()
    return verdict.select(
        F.col("doc_id").cast("long").alias("doc_id"), *MEASURES, base.alias("base_failed"), host_failed.alias("host_failed"),
        (~(base | F.col("symbols") | F.col("dup_lines") | host_failed)).alias("kept"))


def keep_good(documents: DataFrame, host: str = "source") -> DataFrame:
    """The rows that `judge` keeps, with the columns of `documents`.

    Rows are measured once and written with their four flags to the shared folder; the verdicts on hosts and the rows
    themselves are read from there.  Null and empty texts have no words and go; repeated rows are each judged, each count
    for their host and all stay if they pass; rows without a host only stand for themselves; an empty table gives no rows.
    """
    flags = [F.coalesce(v, F.lit(False)).alias(f"{OWN}{k}") for k, v in failures().items()]
    marked = staged(measured(documents).select(*named(documents), *flags), "host-rows")
    own_host = F.col(f"`{host}`").cast("string")
    bad = rejected_hosts(marked.select(own_host.alias("host"), *(F.col(f"{OWN}{r}").alias(r) for r in RULES)), "host")
    bad = staged(bad, "host-rejected")  # its size is known then: texts are not shuffled by host where it is small
    good = marked.where(~(F.col(f"{OWN}short") | F.col(f"{OWN}repeated") | F.col(f"{OWN}symbols") | F.col(f"{OWN}dup_lines")))
    return good.join(bad, own_host == F.col(f"{OWN}rejected_host"), "left_anti").select(*named(documents))


ORACLE = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
m AS (SELECT r, doc_id, source, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM t),
w AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win FROM m, unnest(range(1, len(words) - 1)) AS u(i)),
d AS (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM w),
c AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM d, unnest([i, i + 1, i + 2]) AS v(j) WHERE n > 1 GROUP BY r),
f AS (SELECT m.r, doc_id, source, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(lines) AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM m LEFT JOIN c USING (r)),
x AS (SELECT *, n_words < {MIN_WORDS} AS short, n_repeat_words * 100 > n_words * {int(100 * MAX_REPEATED)} AS repeated,
    n_symbols * 100 > word_chars * {int(100 * MAX_SYMBOLS)} AS symbols, n_dup_lines * 100 > n_lines * {int(100 * MAX_DUP_LINES)} AS dup_lines FROM f),
h AS (SELECT source, rule, count(*) AS n, sum(bad::INT) AS k FROM (
    SELECT source, 1 AS rule, short AS bad FROM x UNION ALL SELECT source, 2, repeated FROM x
    UNION ALL SELECT source, 3, symbols FROM x UNION ALL SELECT source, 4, dup_lines FROM x)
    WHERE source IS NOT NULL GROUP BY source, rule),
p AS (SELECT *, sum(k) OVER a / sum(n) OVER a AS mean, sum(n) OVER a AS total, count(*) OVER a AS hosts FROM h WINDOW a AS (PARTITION BY rule)),
q AS (SELECT *, greatest((sum(n * (k / n - mean) ** 2) OVER (PARTITION BY rule) - mean * (1 - mean) * (hosts - 1)) / total, 0) AS between_hosts FROM p),
s AS (SELECT *, CASE WHEN between_hosts > 0 THEN least(greatest(mean * (1 - mean) / between_hosts - 1, 1), 1e6) ELSE 1e6 END AS strength FROM q),
bad AS (SELECT source FROM s GROUP BY source HAVING max((k + mean * strength) / (n + strength)) > {MAX_HOST_RATE})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeated AS base_failed, bad.source IS NOT NULL AS host_failed,
    NOT (short OR repeated OR symbols OR dup_lines OR bad.source IS NOT NULL) AS kept
FROM x LEFT JOIN bad ON x.source = bad.source
"""
