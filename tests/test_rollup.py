"""Charts from the rollup against the charts over the gold table, with nulls, hot keys and filters."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from sparkplate.operators import dashboards as A
from sparkplate.operators import rollup as RU
from sparkplate.operators.gold import analyses_review
from sparkplate.session import checkpoint_dir


def tables(spark, n=2000):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        rest = "b000" if i % 3 == 0 else rng.choice([None, "missing1", "missing2"] + [f"b{j:03d}" for j in range(60)])
        date = rng.choice([None, "not a date", "2021-02-28 23:59:59", "2021-03-01 00:00:00", "2020-02-29 10:00:00"])
        rows.append((f"r{i}", rest, f"u{i % 50}", rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, 0, 3]), i % 4, None, date, "t"))
    fact = spark.createDataFrame(rows, "review_id string, restaurant_id string, user_id string, stars bigint, cool bigint, "
                                       "funny bigint, useful bigint, review_date string, review_description string").repartition(6)
    dims = [(f"b{j:03d}", f"name{j}", rng.choice([None, "x, y", "z"]), rng.choice([None, "A", "B", "C"]), rng.choice(["S", None]),
             rng.choice([None, 1.5, 4.0])) for j in range(60)]
    dim = spark.createDataFrame(dims, "restaurant_id string, restaurant_name string, categories string, city string, state string, stars double")
    users = spark.createDataFrame([("u1", "n")], "user_id string, user_name string")
    return fact, dim, analyses_review(fact, dim, users)


@pytest.fixture(scope="module")
def built(spark):
    fact, dim, gold = tables(spark)
    return RU.build_rollup(fact, dim), gold


def rows(df):
    return df.columns, [t for _, t in df.dtypes], sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(RU.CHARTS))
@pytest.mark.parametrize("filters", [None, {"stars": [4, 5]}, {"city": "A", "stars": 3}, {"city": None}])
def test_same_rows_as_the_chart(built, name, filters):
    rollup, gold = built
    fn, _ = A.CHARTS[name]
    assert rows(RU.chart(rollup, name, filters)) == rows(fn(A.apply_filters(gold, filters)))


def test_filters_beyond_the_rollup_are_refused(built):
    with pytest.raises(ValueError, match="user_name"):
        RU.chart(built[0], "a07_reviews_over_time", {"user_name": "n"})
    with pytest.raises(ValueError, match="month"):
        RU.chart(built[0], "a16_city_metrics", {"month": "2021-02-01"})


def test_the_fact_is_scanned_once(spark):
    """The rollup is read from written tables: charts over it do not touch the fact's files."""
    fact, dim, _ = tables(spark, 300)
    path = f"{checkpoint_dir(spark)}/rollup-fact"
    fact.write.mode("overwrite").parquet(path)
    rollup = RU.build_rollup(spark.read.parquet(path), dim)
    for name in RU.CHARTS:
        assert not any("rollup-fact" in f for f in RU.chart(rollup, name).inputFiles())
    sizes = sorted(glob.glob(path.replace("file:", "") + "/*.parquet"))
    assert sizes


def test_many_buckets_and_an_empty_fact(spark):
    fact = spark.range(0, 100_000, 1, 4).select(
        F.concat(F.lit("b"), F.col("id")).alias("restaurant_id"), F.lit("2021-01-01 00:00:00").alias("review_date"),
        F.lit(5).cast("bigint").alias("stars"), *[F.lit(1).cast("bigint").alias(c) for c in RU.SUMS])
    dim = spark.createDataFrame([("b5", "c", "A", "S", 2.0)], "restaurant_id string, categories string, city string, state string, stars double")
    got = {r.city: r.restaurants for r in RU.chart(RU.build_rollup(fact, dim), "a24_top_cities_by_restaurants").collect()}
    assert got == {None: 99_999, "A": 1}
    empty = RU.build_rollup(fact.where("false"), dim)
    assert RU.chart(empty, "a16_city_metrics").count() == 0
    assert RU.chart(empty, "a09_total_funny").first()[0] is None
