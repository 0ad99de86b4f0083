"""One key holding a third of all rows: results stay whole and equal to brute force."""

from pyspark.sql import functions as F

from sparkplate.operators import dashboards as A
from sparkplate.operators import lookup as L
from sparkplate.operators import quality as Q
from sparkplate.operators import split as SP
from sparkplate.operators.gold import analyses_review
from sparkplate.operators.ids import encode_ratings
from sparkplate.session import cut_lineage


def _reviews(spark, n=3000):
    # user u0000 and restaurant b0000 each hold a third of the rows
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        rows.append((f"r{i}", "b0000" if hot else f"b{i % 97 + 1:04d}", "u0000" if hot else f"u{i % 211 + 1:04d}",
                     i % 5 + 1, f"2021-{i % 12 + 1:02d}-{i % 28 + 1:02d} 00:00:00"))
    return spark.createDataFrame(rows, "review_id string, business_id string, user_id string, stars bigint, "
                                       "date string").repartition(8)


def test_hot_keys_in_joins_and_aggregates(spark):
    rv = _reviews(spark)
    fact = rv.select("review_id", F.col("business_id").alias("restaurant_id"), "user_id", "stars",
                     F.lit(0).cast("bigint").alias("cool"), F.lit(0).cast("bigint").alias("funny"),
                     F.lit(0).cast("bigint").alias("useful"), F.col("date").alias("review_date"),
                     F.lit("t").alias("review_description"))
    dr = rv.select(F.col("business_id").alias("restaurant_id")).distinct().select(
        "restaurant_id", F.col("restaurant_id").alias("restaurant_name"), F.lit("c").alias("categories"),
        F.when(F.col("restaurant_id") == "b0000", "Hot").otherwise("Cold").alias("city"),
        F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude"), F.lit(4.0).alias("stars"),
        F.lit("S").alias("state"), F.lit(1).cast("bigint").alias("review_count"))
    du = rv.select("user_id").distinct().select("user_id", F.col("user_id").alias("user_name"))
    ar = analyses_review(fact, dr, du)
    assert ar.count() == 3000
    got = {r.city: (r.restaurants, r.reviews) for r in A.a16_city_metrics(ar).collect()}
    assert got["Hot"] == (1, 1000) and got["Cold"][1] == 2000
    assert Q.check_unique(rv, "user_id").where("user_id = 'u0000'").first().n == 1000
    first = L.first_per(rv, "user_id", "review_id").where("user_id = 'u0000'").first()
    assert first.review_id == "r0"


def _splits_skew(spark, build) -> bool:
    """Whether AQE splits a hot key in the joins of ``build()`` under low thresholds."""
    low = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
           "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        df = build()
        df.collect()
        return "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_keys_are_split_in_plans(spark):
    rows = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 997).cast("int").alias("businessid"),
        F.col("id").cast("int").alias("userid"), F.rand(1).cast("float").alias("rating"))
    items = rows.select("businessid").distinct().select("businessid", F.col("businessid").cast("string").alias("business_id"),
                                                        F.col("businessid").cast("string").alias("name"))
    assert _splits_skew(spark, lambda: L.enrich_recommendations(rows, items))
    late = rows.select(F.col("businessid").alias("userid"), "rating")
    trains = cut_lineage(late.where("userid % 3 = 0").select("userid").distinct())
    assert _splits_skew(spark, lambda: SP.users_never_in(late, trains))


def test_time_split_with_hot_user(spark):
    ratings = encode_ratings(_reviews(spark).select("business_id", "user_id", "stars", "date"), own_keys=True)
    base = ratings.distinct()
    train, test = SP.time_split(ratings)
    assert test.count() == base.count() * 3 // 10
    assert train.unionByName(test).exceptAll(base.select(*train.columns)).count() == 0
    hot = base.where("user_id = 'u0000'").count()
    assert train.where("user_id = 'u0000'").count() + test.where("user_id = 'u0000'").count() == hot
