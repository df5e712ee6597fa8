"""Sources and sinks on the given tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegauge import presets
from sitegauge.catalog import checks as K
from sitegauge.catalog import standins as S
from sitegauge.catalog.registry import register
from sitegauge.plans import pipeline
from sitegauge.sources import tables as I

RAW = f"SELECT serial_no, company_name, company_site_url FROM {S.sql(S.COMPANIES)}"


def raw_companies(spark, sf):
    """Companies under the headers of a landing file, one with a byte order mark, one with spaces."""
    rows = S.frame(spark, sf, S.COMPANIES)
    return rows.toDF("﻿Serial No", " Company Name ", "Company Site URL").withColumn("extra", F.lit(1))


@register("read_landing_csv", RAW)
def read_landing_csv(spark, sf):
    """Companies written as CSV files and read back as a landing folder."""
    folder = S.shared_folder(spark)
    rows = S.frame(spark, sf, S.COMPANIES).toDF(*presets.LANDING_COLUMNS)
    rows.repartition(3).write.csv(folder, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return I.ingest_landing(spark, folder).drop("_source_file", "_ingested_at")


@register("bronze_stage", RAW)
def bronze_stage(spark, sf):
    """The whole first stage: landing folder to the table in use, after one that an empty folder could not replace."""
    rows = S.frame(spark, sf, S.COMPANIES).toDF(*presets.LANDING_COLUMNS)
    folder, empty = S.shared_folder(spark), S.shared_folder(spark)
    rows.repartition(3).write.csv(folder, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    spark.createDataFrame([], rows.schema).repartition(1).write.csv(empty, header=True)
    name = S.scratch_table(spark, "companies")
    database, _, table = name.partition(".")
    pipeline.build_bronze(spark, database, folder, name=table)
    try:
        pipeline.build_bronze(spark, database, empty, name=table)
    except ValueError:
        return spark.table(name).drop("_source_file", "_ingested_at")
    raise AssertionError("an empty folder replaced the table")


@register("file_lineage", "SELECT s_suppkey, 'supplier.parquet' AS file_name, TRUE AS stamped FROM supplier")
def file_lineage(spark, sf):
    rows = I.file_lineage(I.with_source_file(spark.read.parquet(f"{sf}/supplier.parquet")))
    return rows.select("s_suppkey", F.substring_index("_source_file", "/", -1).alias("file_name"), F.col("_ingested_at").isNotNull().alias("stamped"))


@register("normalize_headers", f"SELECT serial_no AS \"Serial No\", company_name AS \"Company Name\", company_site_url AS \"Company Site URL\", CAST(1 AS INT) AS extra FROM {S.sql(S.COMPANIES)}")
def normalize_headers(spark, sf):
    return I.normalize_headers(raw_companies(spark, sf))


@register("require_columns", "SELECT s_suppkey, s_name FROM supplier")
def require_columns(spark, sf):
    return I.require_columns(S.table(spark, sf, "supplier").select("s_suppkey", "s_name"), ["s_name", "s_suppkey"])


@register("rename_project", RAW)
def rename_project(spark, sf):
    return I.rename_project(I.normalize_headers(raw_companies(spark, sf)), presets.LANDING_COLUMNS)


@register("read_table", "SELECT c_custkey, c_name FROM customer")
def read_table(spark, sf):
    name = S.scratch_table(spark, "customer")
    I.overwrite_table(S.table(spark, sf, "customer"), name)
    return I.read_table(spark, name, ["c_custkey", "c_name"])


SEGMENT_CODES = [("BUILDING", 1), ("MACHINERY", 2), ("FURNITURE", 3)]
SEGMENT_VALUES = ", ".join(f"('{s}', {c})" for s, c in SEGMENT_CODES)


@register("rows_to_df", f"SELECT c_custkey, CAST(code AS INT) AS code FROM customer LEFT JOIN (VALUES {SEGMENT_VALUES}, ('HOUSEHOLD', NULL)) AS v(s, code) ON s = c_mktsegment")
def rows_to_df(spark, sf):
    schema = T.StructType([T.StructField("c_mktsegment", T.StringType()), T.StructField("code", T.IntegerType())])
    rows = [{"c_mktsegment": s, "code": c} for s, c in SEGMENT_CODES] + [{"c_mktsegment": "HOUSEHOLD"}]
    return S.table(spark, sf, "customer").join(I.rows_to_df(spark, rows, schema), "c_mktsegment", "left").select("c_custkey", "code")


@register("inline_table", f"SELECT code, count(*) AS customers FROM customer JOIN (VALUES {SEGMENT_VALUES}) AS v(s, code) ON s = c_mktsegment GROUP BY code")
def inline_table(spark, sf):
    codes = I.inline_table(spark, SEGMENT_CODES, "c_mktsegment string, code int")
    return S.table(spark, sf, "customer").join(codes, "c_mktsegment").groupBy("code").agg(F.count("*").alias("customers"))


@register("read_previous_snapshot", f"SELECT state, zip, latitude, longitude, geocoded_city, geocoded_place FROM {S.sql(S.PREVIOUS)}")
def read_previous_snapshot(spark, sf):
    name = S.scratch_table(spark, "contacts")
    I.overwrite_table(S.frame(spark, sf, S.PREVIOUS), name)
    schema = "state string, zip string, latitude double, longitude double, geocoded_city string, geocoded_place string"
    return I.read_previous_snapshot(spark, name, schema, "geocoded_city").withColumns(
        {"latitude": F.col("latitude").cast("double"), "longitude": F.col("longitude").cast("double")})


@register("overwrite_table", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def overwrite_table(spark, sf):
    """A catalog table replaced by one with more columns that is made from the table itself."""
    name = S.scratch_table(spark, "orders")
    orders = S.table(spark, sf, "orders")
    I.overwrite_table(orders.select("o_orderkey", "o_custkey"), name, nonempty=True)
    wider = I.read_table(spark, name).join(orders.select("o_orderkey", "o_totalprice"), "o_orderkey")
    I.overwrite_table(wider, name, nonempty=True)
    return I.read_table(spark, name)


@register("report_row_count", "SELECT count(*) AS written FROM orders")
def report_row_count(spark, sf):
    name = S.scratch_table(spark, "orders")
    I.overwrite_table(S.table(spark, sf, "orders"), name)
    return I.written_rows(spark, name).select("written")


@register("guard_nonempty", "SELECT c_custkey FROM customer")
def guard_nonempty(spark, sf):
    return I.guard_nonempty(S.table(spark, sf, "customer").select("c_custkey"))


@register("guard_any_success", "SELECT user_id, count(*) FILTER (WHERE event_type <> 'error') AS pages_ok FROM events GROUP BY user_id")
def guard_any_success(spark, sf):
    status = S.table(spark, sf, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") != "error").alias("pages_ok"))
    I.guard_any_success(status)
    return status
