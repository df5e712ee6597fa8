"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Prefix of helper columns, so that they cannot clash with a caller's columns.
OWN = "__llm_"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is read from `spark.checkpoint.dir`.  Only where neither that nor a checkpoint folder is set, as in
    local tests, a temporary folder is taken and set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package also where the driver runs in another folder."""
    here = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if here not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [here, known]))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage is cut, later steps survive lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(df: DataFrame) -> list[Column]:
    """All columns, whatever characters their names hold."""
    return [F.col(f"`{c}`") for c in df.columns]


def whole_text(column: str = "text") -> Column:
    """The text; a null text counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def sampled(df: DataFrame, rows: int, *by: str, buckets: int = 32, within: tuple[str, ...] = ()) -> DataFrame:
    """At most `rows` rows (for each value of `within`): the first by hash of the columns `by` in each of so many buckets.

    Every map task keeps no more than that many rows before the shuffle, and the buckets are cut by separate tasks, so
    neither the driver nor one task gets more as the table grows, as it would with an ordered limit.
    """
    bucket, rank = f"{OWN}bucket", f"{OWN}rank"
    first = Window.partitionBy(bucket, *within).orderBy(F.xxhash64(*by), *by)
    return (df.withColumn(bucket, F.pmod(F.xxhash64(F.lit(41), *by), F.lit(buckets)))
            .withColumn(rank, F.row_number().over(first)).where(F.col(rank) <= max(1, rows // buckets)).drop(bucket, rank))


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal digits modulo `modulus`; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(-1))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, modulus: int, out: int, rows: int, *more: str) -> DataFrame:
    """doc_id, text, the columns `more` and the label of at most `rows` labelled documents outside the held-out fold `out`.

    The bound makes broadcasting the chosen ids safe: `rows` ids and labels, whatever the corpus size.
    Repeated label rows of one id count once, with their largest label; of document rows with one id the first by the
    hash of the text counts, so that the bound holds for the rows as well.
    """
    chosen = sampled(
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (fold(F.col("doc_id"), modulus) != out))
        .groupBy("doc_id").agg(F.max("label").alias("label")), rows, "doc_id")
    found = documents.select("doc_id", whole_text().alias("text"), *more).join(F.broadcast(chosen), "doc_id")
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    return found.withColumn(f"{OWN}place", F.row_number().over(one)).where(F.col(f"{OWN}place") == 1).drop(f"{OWN}place")
