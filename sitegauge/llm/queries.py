"""The registered queries: each operator over its whole table, in the columns of its contract."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegauge.llm import (
    hadamard, host_rules, importance, licenses, mixing, packing, pii_crf, quality_gam, rp_forest, simhash_bk, token_cache, toxicity_cnn,
    warc_bundles)
from sitegauge.llm.common import shared_dir, table, workers_find_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and the SQL for the same rows, where SQL can express it."""
    def add(function):
        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            workers_find_package(spark)
            return function(spark, sf_dir)
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return function
    return add


@query("op1_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op2_quality_gam")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality_gam.train(documents, table(spark, sf_dir, "labels"))
    return quality_gam.score_quality(documents, model)


@query("op3_rp_forest")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op4_pii_crf")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.find_personal_data(table(spark, sf_dir, "documents"))


@query("op5_toxicity_cnn")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity_cnn.train(documents, table(spark, sf_dir, "labels"))
    return toxicity_cnn.score_toxicity(documents, model)


@query("op6_host_rules", host_rules.ORACLE)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(table(spark, sf_dir, "documents"))


@query("op7_mixing", mixing.ORACLE)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = mixing.OWN
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "source", *(F.col(f"{own}{c}").alias(c) for c in ("n_tokens", "epoch", "block", "token_start")),
        F.round(f"{own}weight", 6).alias("weight"))


@query("op8_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_bk.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_token_cache")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache is the folder named in the session's setting; where none is named, a new one, which the run fills and reads back."""
    folder = spark.conf.get(token_cache.FOLDER, None) or f"{shared_dir(spark)}/token-cache-{uuid.uuid4().hex}"
    return token_cache.count_tokens(table(spark, sf_dir, "documents"), cache_path=folder)


@query("op10_licenses", licenses.oracle())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


@query("op11_warc_bundles", warc_bundles.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_bundles.pages_of(warc_bundles.write_archive(table(spark, sf_dir, "pages")))


@query("op12_importance")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_hadamard", hadamard.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hadamard.cluster(table(spark, sf_dir, "embeddings")).drop("finished")
