"""Rows of one row group are worked on by all tasks, costly expressions once, and no broadcast holds repeated rows."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sitegauge.catalog import contact_queries
from sitegauge.catalog.all_queries import ORACLES, QUERIES
from sitegauge.functions import text as X
from sitegauge.operators.joins import lookup_join, spread_rows
from sitegauge.plans import gold
from tests.oracle import compare, connect


def tasks(df):
    """Rows of each partition that has any."""
    return Counter(r[0] for r in df.select(F.spark_partition_id()).collect())


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def below_shuffle(df):
    lines = plan(df)
    return lines[next(k for k, line in enumerate(lines) if "Repartition" in line):]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """One customer table of one row group."""
    at = str(tmp_path_factory.mktemp("one-group"))
    spark.range(400).select(F.col("id").alias("c_custkey"), F.concat(F.lit("Customer "), "id").alias("c_name")).coalesce(1).write.parquet(f"{at}/customer.parquet")
    return at


def test_product_addresses_of_one_task_are_spread(spark):
    paths = ["products/excavators/a", "products/warranty/b", "products/other/c", None]
    rows = [(str(k % 7), f"u{k // 2}", paths[k // 2 % 4], "news" if k % 10 == 9 else "product") for k in range(800)]
    urls = spark.createDataFrame(rows, "serial_no string, url string, relative_path string, page_type string").coalesce(1)
    found = gold.product_urls(urls)
    assert len(tasks(found)) == 8 and max(tasks(found).values()) < 100
    assert not any("RLIKE" in line for line in below_shuffle(found))
    names = gold.with_category_names(found)
    kept = Counter((int(s), u, p, "Excavators" if "excavators" in p else None)
                   for s, u, p, kind in rows if kind == "product" and p and "warranty" not in p)
    assert Counter((r.serial_no, r.url, r.relative_path, r.category) for r in names.collect()) == kept


def test_copies_of_one_row_are_spread(spark):
    assert min(tasks(spread_rows(spark.range(800).select(F.lit(1)).coalesce(1))).values()) > 50


def test_a_value_in_place_is_not_copied_into_filters(spark):
    listed = spark.createDataFrame([("a,b",), ("",), (None,)], "t string")
    found = listed.select(X.in_place(F.split("t", ",")).alias("parts")).select(F.explode("parts").alias("p")).where("p <> ''")
    assert sum(line.count("split(") for line in plan(found)) == 1
    assert sorted(r.p for r in found.collect()) == ["a", "b"]


@pytest.mark.parametrize("name", ["extract_text_phones", "extract_text_addresses", "contacts_first_wins", "score_address"])
def test_contact_pages_are_spread_and_searched_once(spark, folder, name):
    found = getattr(contact_queries, name)(spark, folder)
    assert len(tasks(found)) == 8 and found.count() == 400
    assert not any("regexp_extract_all" in line or "split(" in line for line in below_shuffle(found))
    assert not any(re.match(r"\W*Filter", line) and ("regexp" in line or "split(" in line) for line in plan(found))


def test_founding_years_are_searched_after_the_spread(spark, folder):
    found = contact_queries.founded_year(spark, folder)
    assert found.count() > 0
    assert not any("regexp_extract_all" in line or "RLIKE" in line for line in below_shuffle(found))


def broadcasts(df):
    """The plan's broadcasts as they are run, each with what is below it, one text each."""
    df.collect()
    lines = df._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0].splitlines()
    depth = [re.search(r"\w|$", line).start() for line in lines]
    found = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((k for k in range(i + 1, len(lines)) if depth[k] <= depth[i]), len(lines))
            found.append("\n".join(lines[i:end]))
    return found


@pytest.fixture
def threshold(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    yield lambda limit: spark.conf.set(name, str(limit))
    spark.conf.set(name, old)


FACTS = 2000


def facts(spark):
    return spark.range(FACTS).select((F.col("id") % 7).alias("k"), "id")


def test_a_small_lookup_is_broadcast_once(spark, threshold):
    threshold(1 << 20)
    lookup = spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    found = lookup_join(facts(spark), lookup, "k", "inner", spread=["id"], salts=50)
    assert len(broadcasts(found)) == 1 and "_salt" not in broadcasts(found)[0]
    assert Counter((r.id, r.w) for r in found.collect()) == Counter((i, i % 7 * 2) for i in range(FACTS))


def test_a_lookup_that_gets_small_by_lost_columns_is_not_broadcast_repeated(spark, threshold):
    threshold(12_000)
    lookup = spark.range(900).select(F.col("id").alias("k"), *[(F.col("id") * i).alias(f"w{i}") for i in range(2, 5)])
    found = lookup_join(facts(spark), lookup, "k", "inner", spread=["id"], salts=50).select("id", "w2")
    assert not any("_salt" in b for b in broadcasts(found))
    assert Counter((r.id, r.w2) for r in found.collect()) == Counter((i, i % 7 * 2) for i in range(FACTS))


def test_a_lookup_found_small_while_running_is_not_broadcast_repeated(spark, threshold):
    threshold(400_000)
    lookup = spark.range(100_000).groupBy((F.col("id") % 900).alias("k")).agg(F.count("*").alias("n"))
    found = lookup_join(facts(spark), lookup, "k", "left", spread=["id"], salts=50)
    assert not any("_salt" in b for b in broadcasts(found))
    assert Counter((r.id, r.n) for r in found.collect()) == Counter((i, 112) for i in range(FACTS))


@pytest.fixture(scope="module")
def machines(spark, tmp_path_factory):
    """Suppliers, parts and line items of the product queries; one supplier has most of the products."""
    at = str(tmp_path_factory.mktemp("machines"))
    spark.range(40).select(F.col("id").alias("s_suppkey"), F.format_string("Supplier#%09d", "id").alias("s_name")).coalesce(1).write.parquet(f"{at}/supplier.parquet")
    spark.range(360).select(F.col("id").alias("p_partkey"), F.concat(F.lit("large ring "), "id").alias("p_name"), F.concat(F.lit("Brand#"), F.col("id") % 25).alias("p_brand")).coalesce(1).write.parquet(f"{at}/part.parquet")
    spark.range(3600).withColumn("n", F.floor(F.col("id") / 360)).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 360).alias("l_partkey"), (F.col("n") % 5).cast("int").alias("l_linenumber"),
        F.when((F.col("id") + F.col("n")) % 3 > 0, 7).otherwise((F.col("id") * 7 + F.col("n")) % 45).alias("l_suppkey"),
        F.to_timestamp(F.lit("1996-01-01")).alias("l_shipdate")).coalesce(1).write.parquet(f"{at}/lineitem.parquet")
    return at


def companies_once(spark, name, folder):
    """The query's rows are those of its SQL, and its companies are broadcast one row each."""
    assert compare(spark, connect(folder), QUERIES[name], ORACLES[name], folder) is None
    found = QUERIES[name](spark, folder)
    sent = broadcasts(found)
    assert any("supplier" in b or "s_suppkey" in b for b in sent)
    assert not any("_salt" in b for b in sent)
    return found


def test_bar_electric_broadcasts_companies_once(spark, machines):
    assert companies_once(spark, "bar_electric", machines).count() > 10


def test_ds_electric_broadcasts_companies_once(spark, machines):
    assert companies_once(spark, "ds_electric", machines).count() > 20


def test_electric_products_broadcasts_companies_once(spark, machines):
    assert companies_once(spark, "electric_products", machines).count() > 20


def test_kpi_electric_broadcasts_companies_once(spark, machines):
    assert companies_once(spark, "kpi_electric", machines).count() == 1
