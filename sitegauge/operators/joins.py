"""Joins that stay balanced when one key holds a large part of the rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partitions_of(df: DataFrame) -> int:
    """The session's shuffle partitions."""
    setting = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    # some platforms choose the number themselves and say "auto"
    return int(setting) if setting.isdigit() else 4 * df.sparkSession.sparkContext.defaultParallelism


def salts_of(df: DataFrame) -> int:
    """Buckets that a hot key is spread over: a quarter of the session's shuffle partitions."""
    return max(2, partitions_of(df) // 4)


def spread_rows(df: DataFrame) -> DataFrame:
    """The same rows dealt evenly over the session's shuffle partitions, copies of one row too.

    For narrow rows before much work on each of them: a scan has no more busy tasks than its files have row groups.
    Filters on what is computed afterwards are moved below the shuffle unless they are `in_place`."""
    return df.repartition(partitions_of(df))


def broadcast_by_size(df: DataFrame) -> bool:
    """Whether Spark's own estimate of the table is within the session's broadcast threshold."""
    java = getattr(df, "_jdf", None)
    if java is None:  # a remote session does not tell its estimates
        return False
    estimate = java.queryExecution().optimizedPlan().stats().sizeInBytes()
    return estimate <= java.sparkSession().sessionState().conf().autoBroadcastJoinThreshold()


def repeated(lookup: DataFrame, salts: int) -> DataFrame:
    """Each row once per bucket, the bucket in `_salt`.

    An unpivot, as its estimated size grows with the buckets.  An exploded list is taken to be as large as what it was
    made from, and Spark would bring all its rows to the driver to broadcast them."""
    buckets = [f"_salt{i}" for i in range(salts)]
    return (lookup.select("*", *[F.lit(i).alias(b) for i, b in enumerate(buckets)])
            .unpivot(lookup.columns, buckets, "_bucket", "_salt").drop("_bucket"))


def lookup_join(facts: DataFrame, lookup: DataFrame, on, how: str = "left", spread=(), salts: int | None = None) -> DataFrame:
    """Join a large table to a table with at most one row per key.

    No broadcast is forced: Spark broadcasts the lookup when its size is under the session's threshold, as it is, for no
    row of the facts is shuffled then.  Beyond that the facts of a key are spread over `salts` buckets by a hash of the
    `spread` columns, and each lookup row is repeated once per bucket, so a hot key is shared by `salts` tasks."""
    keys = [on] if isinstance(on, str) else list(on)
    salts = salts_of(facts) if salts is None else salts
    if not spread or salts <= 1 or broadcast_by_size(lookup):
        return facts.join(lookup, keys, how)
    bucket = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    return facts.withColumn("_salt", bucket).join(repeated(lookup, salts), keys + ["_salt"], how).drop("_salt")
