"""Token counts through a digest cache.

The cache is a Parquet table of (digest, tokenizer version, count).  A run joins the texts' digests to it, encodes one
text for each digest that is missing, appends those counts, and answers from stored and new counts alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitegauge.llm.common import staged, whole_text
from sitegauge.llm.tokens import byte_counts, tokenizer_path

#: Session setting that names the cache's folder for the registered query.
FOLDER = "spark.sitegauge.tokenCache"
CACHE = "digest binary, version string, n_tokens bigint"


def tokenizer_version(name: str) -> str:
    """Digest of the vocabulary file: another vocabulary never answers from this one's counts."""
    with open(tokenizer_path(name), "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def read_cache(spark: SparkSession, path: str | None, version: str) -> DataFrame:
    """Stored counts of this tokenizer version; empty where nothing was stored yet."""
    empty = spark.createDataFrame([], CACHE)
    if path is None:
        return empty.select("digest", "n_tokens")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return empty.select("digest", "n_tokens")
    stored = spark.read.schema(CACHE).parquet(path).where(F.col("version") == version)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    documents: DataFrame, cache_path: str | None = None, tokenizer: str = "byte_bpe_50k.json",
    ranks: str = "byte_bpe_50k.tiktoken", limit: int = 512,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    `cache_path`: the cache's folder in storage that all executors share; None: nothing is stored beyond this run.
    A null text counts as empty.  Repeated rows are each returned and encoded once; null ids stay null; an empty table
    gives no rows; other columns are ignored.  Appended counts may repeat after a retried run, with equal values.
    """
    spark, version = documents.sparkSession, tokenizer_version(tokenizer)
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    keyed = texts.withColumn("digest", F.unhex(F.sha2("text", 256)))
    stored = read_cache(spark, cache_path, version)

    # every task keeps one row of each digest before texts are shuffled, so that a text with many copies is sent a few times only
    one = Window.partitionBy("digest").orderBy("doc_id")
    firsts = keyed.withColumn("place", F.row_number().over(one)).where("place = 1").drop("place")
    to_encode = firsts.join(stored.select("digest"), "digest", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = byte_counts(tokenizer, ranks)
        last: dict[bytes, int] = {}
        for batch in batches:
            digests, counts = batch.column(0).to_pylist(), []
            for digest, text in zip(digests, batch.column(1), strict=True):
                if digest not in last:
                    if len(last) > 10_000:
                        last.clear()
                    last[digest] = counter.count(text.as_py())
                counts.append(last[digest])
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    encoded = to_encode.select("digest", "text").mapInArrow(encode, "digest binary, n_tokens bigint")
    if cache_path is None:
        fresh = staged(encoded, "token-counts")
    else:
        stored = staged(stored, "stored-counts")
        encoded.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(cache_path)
        fresh = spark.read.schema(CACHE).parquet(cache_path).where(F.col("version") == version)
    counts = stored.unionByName(fresh.select("digest", "n_tokens")).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    wide = keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    return wide.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
