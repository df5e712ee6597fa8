"""Tables in and out: landing files, catalog tables, guards and full replacement.

A table that is replaced as a whole is a view over its newest version.  A version is a table of its
own, written and checked beside the one in use; the switch is one change in the catalog.  Until then,
and after a write that failed, everybody reads the old rows.
"""

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegauge import presets


def read_landing_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every *.csv of a folder, header row, all strings, with the file of each row.

    The header of the first file gives the columns; Spark checks every other file against it and
    fails on a file whose columns are ordered differently, instead of reading it by position."""
    reader = spark.read.option("header", True).option("pathGlobFilter", "*.csv")
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return with_source_file(reader.schema(schema).option("enforceSchema", False).csv(path))


def with_source_file(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"))


def file_lineage(df: DataFrame) -> DataFrame:
    """Add the load time; the source file has to be taken at the scan (with_source_file)."""
    return df.withColumn("_ingested_at", F.current_timestamp())


def normalize_headers(df: DataFrame) -> DataFrame:
    """Column names without a byte order mark and without white space around them."""
    return df.toDF(*[name.strip("\ufeff \t\r\n") for name in df.columns])


def require_columns(df: DataFrame, names) -> DataFrame:
    absent = sorted(n for n in names if n not in df.columns)
    if absent:
        raise ValueError(f"missing columns {absent}, found {df.columns}")
    return df


def rename_project(df: DataFrame, names: dict, keep=()) -> DataFrame:
    """Only the named columns, under their new names, and `keep` as it is."""
    renamed = [F.col(f"`{old}`").alias(new) for old, new in names.items()]
    return df.select(*renamed, *keep)


def ingest_landing(spark: SparkSession, path: str, columns: dict = presets.LANDING_COLUMNS) -> DataFrame:
    """Landing folder to the raw company table."""
    raw = require_columns(normalize_headers(read_landing_csv(spark, path)), columns)
    return file_lineage(rename_project(raw, columns, keep=["_source_file"]))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table as it is; the session's split size decides how many tasks read it."""
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str, columns=None) -> DataFrame:
    table = spark.table(name)
    return table.select(*columns) if columns else table


def read_previous_snapshot(spark: SparkSession, name: str, schema: str, required: str) -> DataFrame:
    """Last run's table, or an empty one when it does not exist or lacks the required column."""
    empty = spark.createDataFrame([], schema)
    if not spark.catalog.tableExists(name):
        return empty
    table = spark.table(name)
    return table.select(*empty.columns) if required in table.columns else empty


def rows_to_df(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """Small driver-side rows as a typed table; a field that a row lacks is null."""
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def inline_table(spark: SparkSession, rows: list, ddl: str) -> DataFrame:
    return spark.createDataFrame(rows, ddl)


def guard_nonempty(df: DataFrame, what: str = "table") -> DataFrame:
    """Fail on an empty table before anything is overwritten; reads no more than one row."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows; nothing was overwritten")
    return df


def guard_any_success(status: DataFrame, pages_ok: str = "pages_ok") -> None:
    """Fail when no site delivered a page; call it after the status table has been written."""
    if status.where(F.col(pages_ok) > 0).isEmpty():
        raise RuntimeError("no page was read from any site; the other tables were left alone")


def _counted(df: DataFrame, write) -> int:
    """Write and return the row count, seen while writing instead of by a second scan."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


VERSION = "__version_"


@dataclass
class Version:
    """A written version of a table that is not in use yet."""

    name: str
    table: str
    rows: int


def write_version(df: DataFrame, name: str) -> Version:
    """Write a new version beside the one in use; `df` may read the table itself."""
    table = f"{name}{VERSION}{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    return Version(name, table, _counted(df, lambda d: d.write.saveAsTable(table)))


def versions_of(spark: SparkSession, name: str) -> list:
    """Tables of the written versions, oldest first."""
    database, _, short = name.rpartition(".")
    tables = spark.catalog.listTables(database or None)
    start = (short + VERSION).lower()
    return sorted((f"{database}." if database else "") + t.name for t in tables if t.name.lower().startswith(start))


def switch_to(spark: SparkSession, version: Version, columns=None, keep: int = 2) -> None:
    """Let the table be this version, or `columns` of it, and drop all but the `keep` newest versions.

    A plain table of that name becomes the oldest version first."""
    if spark.catalog.tableExists(version.name) and spark.catalog.getTable(version.name).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {version.name} RENAME TO {version.name}{VERSION}{0:020d}_{uuid.uuid4().hex[:8]}")
    listed = ", ".join(f"`{c}`" for c in columns) if columns else "*"
    spark.sql(f"CREATE OR REPLACE VIEW {version.name} AS SELECT {listed} FROM {version.table}")
    for old in [t for t in versions_of(spark, version.name) if t.lower() != version.table.lower()][:-(keep - 1) or None]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def overwrite_table(df: DataFrame, name: str, nonempty: bool = False) -> int:
    """Replace a catalog table, also its columns; returns the row count.

    With `nonempty` a table without rows is not taken: the old one stays and the call fails."""
    version = write_version(df, name)
    if nonempty and not version.rows:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {version.table}")
        raise ValueError(f"{name}: no rows; nothing was overwritten")
    switch_to(df.sparkSession, version)
    return version.rows


def written_rows(spark: SparkSession, name: str) -> DataFrame:
    """(table_name, written): how many rows the table in use holds, counted where they lie."""
    return spark.table(name).agg(F.count("*").alias("written")).select(F.lit(name).alias("table_name"), "written")


def overwrite_files(df: DataFrame, path: str) -> int:
    """Replace a table kept as Parquet files in a folder; returns the row count."""
    return _counted(df, lambda d: d.write.mode("overwrite").parquet(path))
