"""The bucketed star join: no exchange, hot keys spread, rows as the plain join's."""

import collections

import pytest
from pyspark.sql import functions as F

from sparkplate.operators import bucketed as B
from sparkplate.operators import dashboards as A
from sparkplate.operators.gold import analyses_review
from sparkplate.sources.catalog import ensure_namespace


def tables(spark, hot):
    n = 6000
    key = F.when(F.col("id") % 97 == 5, None).when((F.col("id") % 3 == 0) & F.lit(hot), "b0").when(
        F.col("id") % 50 == 1, "unknown").otherwise(F.concat(F.lit("b"), F.col("id") % 400))
    fact = spark.range(0, n, 1, 6).select(
        F.concat(F.lit("r"), "id").alias("review_id"), key.alias("restaurant_id"), F.concat(F.lit("u"), F.col("id") % 30).alias("user_id"),
        (F.col("id") % 5 + 1).alias("stars"), *[(F.col("id") % 3).alias(c) for c in ("cool", "funny", "useful")],
        F.lit("2021-01-01 00:00:00").alias("review_date"), F.lit("t").alias("review_description"))
    dim = spark.range(0, 400).select(
        F.concat(F.lit("b"), "id").alias("restaurant_id"), F.concat(F.lit("n"), "id").alias("restaurant_name"), F.lit("c").alias("categories"),
        F.concat(F.lit("city"), F.col("id") % 9).alias("city"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"),
        (F.col("id") % 9 / 2 + 1).alias("stars"), F.lit("S").alias("state"), F.col("id").alias("review_count"))
    return fact, dim


def stored(spark, hot, buckets=8):
    ensure_namespace(spark, "bucket_check")
    fact, dim = tables(spark, hot)
    names = f"bucket_check.fact_{hot}_{buckets}".lower(), f"bucket_check.dim_{hot}_{buckets}".lower()
    B.store_star(fact, dim, *names, buckets=buckets)
    return fact, dim, B.bucketed_gold(spark, *names), names


@pytest.mark.parametrize("hot", [False, True])
def test_no_exchange_and_the_same_rows(spark, hot):
    fact, dim, gold, _ = stored(spark, hot)
    plan = gold._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    want = analyses_review(fact, dim, spark.createDataFrame([], "user_id string, user_name string"), needed=["city"], unique_dims=True)
    assert sorted(gold.columns) == sorted(want.columns)
    assert gold.exceptAll(want.select(*gold.columns)).count() == 0 and want.select(*gold.columns).exceptAll(gold).count() == 0


def test_a_chart_shuffles_partial_sums_only(spark):
    fact, dim, gold, _ = stored(spark, True)
    chart = A.a15_avg_rating_by_city(gold)
    plan = chart._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan
    text = chart._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in text.splitlines() if "Exchange" in line]
    assert exchanges and all("restaurant_id" not in line for line in exchanges)


def test_a_hot_key_fills_no_bucket(spark):
    """A third of all rows share a key; no bucket holds more than some fair shares."""
    _, _, _, (fact_table, dim_table) = stored(spark, True)
    per_file = [r["n"] for r in spark.table(fact_table).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert sum(per_file) == 6000 and max(per_file) < 3 * 6000 / 8
    copies = collections.Counter(r["restaurant_id"] for r in spark.table(dim_table).collect())
    assert copies["b0"] >= 3 and sum(c > 1 for c in copies.values()) == 1


def test_without_rows(spark):
    ensure_namespace(spark, "bucket_check")
    fact, dim = tables(spark, False)
    B.store_star(fact.where("false"), dim, "bucket_check.fact_none", "bucket_check.dim_none", buckets=4)
    assert B.bucketed_gold(spark, "bucket_check.fact_none", "bucket_check.dim_none").count() == 0
