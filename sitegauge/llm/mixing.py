"""Mixing sources to target weights by temperature, in DataFrame functions.

The share of a source in all tokens is raised to an exponent between 0 (all sources alike) and 1 (as they are).  The
exponent is found by repeated section: the largest whose weights reach a target entropy, but no smaller than the
repetition limit allows.  The weights are then realised under a token budget: each source's documents are dealt into
blocks by hash, the blocks and the documents in them stand in one permuted order, and the source's stream goes through
that order again and again until its part of the budget is spent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.common import OWN, named, staged, whole_text

WORD = r"[^\x20\x09-\x0D]+"
#: Target entropy as a share of the entropy of equal weights; most passes over a source; documents in a block; seed.
ENTROPY, REPETITION, BLOCK_DOCS, SEED = 0.9, 1.5, 500, 17
#: The exponent is a multiple of 1 / SECTION**2: two rounds of SECTION values each.
SECTION = 64
NO_SOURCE = "\x00"


def tokens_of(text: Column) -> Column:
    """Words of a text, and one for its end: no document is free."""
    return (F.regexp_count(text, F.lit(WORD)) + 1).cast("long")


def source_tokens(documents: DataFrame, source: str = "source") -> DataFrame:
    """One row per source: documents and tokens; rows without a source are a source of their own."""
    return documents.groupBy(F.coalesce(F.col(source).cast("string"), F.lit(NO_SOURCE)).alias("s")).agg(
        F.count("*").alias("docs"), F.sum(tokens_of(whole_text())).alias("tokens"))


def find_exponent(sources: DataFrame, entropy: float = ENTROPY, repetition: float = REPETITION) -> int:
    """The exponent times SECTION**2.

    Entropy falls and the passes over the smallest source fall as the exponent grows, so the values that meet the
    target are found by sections; a round sums over all sources in one aggregation and brings SECTION + 1 numbers back.
    """
    whole = SECTION * SECTION
    total = sources.agg(F.sum("tokens").alias("t"), F.count("*").alias("n"), F.min("tokens").alias("low"), F.max("tokens").alias("high")).first()
    if not total["n"] or total["n"] == 1:
        return whole
    share = F.col("tokens") / F.lit(float(total["t"]))
    log_n = F.log(F.lit(float(total["n"])))

    def largest(low: int, step: int, count: int) -> int:
        """The largest low + step * k that reaches the entropy; `low` if none does."""
        grid = sources.select("tokens", F.explode(F.sequence(F.lit(0), F.lit(count))).alias("k"))
        a = (F.lit(low) + F.col("k") * step) / F.lit(float(whole))
        sums = grid.groupBy("k").agg(F.sum(F.pow(share, a)).alias("z"), F.sum(F.pow(share, a) * a * F.log(share)).alias("x"))
        entropy_of = F.log("z") - F.col("x") / F.col("z")
        found = sums.where(entropy_of >= log_n * entropy - 1e-9).agg(F.max("k").alias("k")).first()["k"]
        return low + step * (found or 0)

    coarse = largest(0, SECTION, SECTION)
    exponent = min(largest(coarse, 1, SECTION), whole)
    # the smallest source is passed (high / low) ** (1 - exponent) times, the largest once; equal sources need no exponent
    if total["high"] == total["low"]:
        return exponent
    row = sources.select(
        F.ceil(whole * (1 - F.log(F.lit(float(repetition))) / F.log(F.lit(float(total["high"])) / F.lit(float(total["low"])))) - 1e-9).alias("k")).first()
    needed = row["k"] if row["k"] is not None else 0
    return max(exponent, min(max(int(needed), 0), whole))


def level(shares: DataFrame, budget: float, rounds: int = 4) -> float:
    """The budget for which min(weight * level, most) sums up to `budget`, as far as all `most` together allow.

    Found by sections: each round sums over all sources in one aggregation.
    """
    total = shares.agg(F.sum("most").alias("most"), F.max(F.col("most") / F.col("weight")).alias("top")).first()
    if total["most"] <= budget:
        return float(total["top"])
    low, step = 0.0, float(total["top"]) / SECTION
    for _ in range(rounds):
        grid = shares.select("weight", "most", F.explode(F.sequence(F.lit(0), F.lit(SECTION))).alias("k"))
        at = F.lit(low) + F.col("k") * F.lit(step)
        sums = grid.groupBy("k").agg(F.sum(F.least(F.col("weight") * at, F.col("most"))).alias("given"))
        low += step * (sums.where(F.col("given") <= budget).agg(F.max("k").alias("k")).first()["k"] or 0)
        step /= SECTION
    return low


def quotas(sources: DataFrame, exponent: int, budget: int | None = None, repetition: float = REPETITION) -> DataFrame:
    """s, docs, tokens, weight and the tokens that each source may give.

    Without a budget it is the smallest that leaves out no document: the largest source is passed once.  With a budget no
    source gives more than `repetition` times its tokens; what it cannot give goes to the others by their weights, and
    a budget beyond what all may give is not spent in full.
    """
    power = exponent / (SECTION * SECTION)
    total = sources.agg(F.sum("tokens").alias("t"), F.max("tokens").alias("high")).first()
    if not total["t"]:
        return sources.select("s", "docs", "tokens", F.lit(1.0).alias("weight"), F.lit(0).cast("long").alias("quota"))
    share = F.col("tokens") / F.lit(float(total["t"]))
    z = sources.agg(F.sum(F.pow(share, F.lit(power))).alias("z")).first()["z"]
    weight = F.pow(share, F.lit(power)) / F.lit(z)
    if budget is None:
        passes = F.pow(F.lit(float(total["high"])) / F.col("tokens"), F.lit(1 - power))
        quota = F.greatest(F.floor(F.col("tokens") * passes + 1e-6).cast("long"), F.col("tokens"))
    else:
        most = F.col("tokens") * F.lit(float(repetition))
        spread = level(sources.select(weight.alias("weight"), most.alias("most")), float(budget))
        quota = F.floor(F.least(weight * F.lit(spread), most) + 1e-6).cast("long")
    return sources.select("s", "docs", "tokens", weight.alias("weight"), quota.alias("quota"))


def mix(
    documents: DataFrame, source: str = "source", entropy: float = ENTROPY, repetition: float = REPETITION,
    budget: int | None = None, block_docs: int = BLOCK_DOCS, seed: int = SEED,
) -> DataFrame:
    """`documents` once for each pass in which the row is taken, with own columns n_tokens, epoch, block, token_start, weight.

    A row is taken in pass e if e * (tokens of its source) + token_start lies within the source's quota, so the last
    pass may end early and the realised tokens of a source differ from its quota by less than one document.  Null texts
    count as empty (one token); rows without a source form a source; repeated rows are rows of their own; ties are
    broken by id, then tokens; an empty table gives no rows.  Helper columns cannot clash with those of `documents`.
    """
    own = lambda name: f"{OWN}{name}"
    c = lambda name: F.col(own(name))
    sources = staged(source_tokens(documents, source), "mix-sources")
    plan = quotas(sources, find_exponent(sources, entropy, repetition), budget, repetition).select(
        *(F.col(x).alias(own(x)) for x in ("s", "docs", "tokens", "weight", "quota")))

    # the text is part of the key: rows without an id, or with equal ids, are dealt to different blocks
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(whole_text().cast("binary"))).cast("binary"))
    rows = documents.withColumns({
        own("s"): F.coalesce(F.col(source).cast("string"), F.lit(NO_SOURCE)), own("key"): key, own("n"): tokens_of(whole_text())})
    rows = rows.join(plan, own("s"))
    blocks = F.ceil(c("docs") / block_docs)
    rows = rows.withColumn(own("block"), F.conv(F.substring(c("key"), 1, 8), 16, 10).cast("long") % blocks)

    # tokens before each block: within runs of 1,000 blocks, then of the runs before
    dealt = rows.groupBy(own("s"), own("block")).agg(F.sum(own("n")).alias(own("sum")))
    dealt = staged(dealt.withColumn(own("run"), F.floor(c("block") / 1000)), "mix-blocks")
    before = lambda part, order: (
        F.coalesce(F.sum(own("sum")).over(_window(part, order)), F.lit(0)))
    runs = dealt.groupBy(own("s"), own("run")).agg(F.sum(own("sum")).alias(own("sum")))
    runs = runs.select(own("s"), own("run"), before([own("s")], own("run")).alias(own("runs_before")))
    dealt = dealt.withColumn(own("blocks_before"), before([own("s"), own("run")], own("block"))).join(runs, [own("s"), own("run")])
    offsets = dealt.select(own("s"), own("block"), (c("blocks_before") + c("runs_before")).alias(own("before")))

    inside = F.coalesce(F.sum(own("n")).over(_window([own("s"), own("block")], own("key"), "doc_id", own("n"))), F.lit(0))
    rows = rows.withColumn(own("inside"), inside).join(offsets, [own("s"), own("block")])
    start = c("before") + c("inside")
    passes = F.ceil((c("quota") - start) / c("tokens")).cast("int")
    rows = rows.withColumn(own("start"), start).where(c("quota") > start)
    return rows.withColumn(own("epoch"), F.explode(F.sequence(F.lit(0), passes - 1))).select(
        *named(documents), c("n").alias(own("n_tokens")), own("epoch"), own("block"), c("start").alias(own("token_start")), own("weight"))


def _window(part: list[str], *order: str):
    from pyspark.sql import Window

    return Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def mixed_documents(documents: DataFrame) -> DataFrame:
    """The mixture with the columns of `documents`: each row once for each pass in which it is taken.

    Null and empty texts count one token and are taken like any other; rows without a source form a source; repeated
    rows are rows of their own; ties in the order are broken as in `mix`; an empty table gives no rows.
    """
    return mix(documents).select(*named(documents))


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(source, chr(0)) AS s, source, md5('{SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT + 1 AS n FROM documents),
t AS (SELECT s, count(*) AS docs, sum(n)::BIGINT AS tokens FROM d GROUP BY s),
u AS (SELECT *, tokens / sum(tokens) OVER () AS p, count(*) OVER () AS sources, min(tokens) OVER () AS low, max(tokens) OVER () AS high FROM t),
g AS (SELECT k, ln(sum(p ** (k / 4096.0))) - sum(p ** (k / 4096.0) * (k / 4096.0) * ln(p)) / sum(p ** (k / 4096.0)) AS h, max(ln(sources)) AS top
    FROM u, range(0, 4097) AS r(k) GROUP BY k),
e AS (SELECT greatest((SELECT coalesce(max(k), 0) FROM g WHERE h >= top * {ENTROPY} - 1e-9),
    (SELECT coalesce(max(CASE WHEN high > low THEN ceil(4096 * (1 - ln({REPETITION}) / ln(high / low)) - 1e-9) END), 0) FROM u)) / 4096.0 AS a),
q AS (SELECT s, docs, tokens, p ** a / sum(p ** a) OVER () AS weight,
    greatest(floor(tokens * (high / tokens) ** (1 - a) + 1e-6)::BIGINT, tokens) AS quota FROM u, e),
b AS (SELECT d.*, docs, tokens, weight, quota, (('0x' || substr(key, 1, 8))::BIGINT % ceil(docs / {BLOCK_DOCS})::BIGINT) AS block FROM d JOIN q USING (s)),
o AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY s ORDER BY block, key, doc_id, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS token_start FROM b)
SELECT doc_id, source, n AS n_tokens, epoch::INTEGER AS epoch, block, token_start, round(weight, 6) AS weight
FROM o, range(0, 100) AS r(epoch) WHERE epoch * tokens + token_start < quota
"""
