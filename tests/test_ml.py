"""Invariants of the split and the ALS recommender on the small driver tables."""

from pyspark.sql import functions as F

from sparkplate.operators import als as M
from sparkplate.operators import split as SP
from sparkplate.plans import registry as G

from conftest import SMALL


def test_time_split_invariants(spark):
    ratings = G.ratings_by_order(spark, SMALL)
    base = ratings.distinct()
    train, test = SP.time_split(ratings)
    n = int(base.count() * 3 // 10)
    assert test.count() == n
    assert train.join(test, train.columns, "inner").count() == 0
    assert train.unionByName(test).exceptAll(base.select(*train.columns)).count() == 0
    assert train.count() + test.count() == base.count()
    again_train, _ = SP.time_split(ratings)
    assert again_train.exceptAll(train).count() == 0  # deterministic


def test_random_split_disjoint_complete(spark):
    ratings = G.ratings(spark, SMALL)
    a, b = SP.random_split(ratings, (0.8, 0.2), 42)
    assert a.count() + b.count() == ratings.count()
    assert a.intersect(b).count() == 0


def test_random_split_pieces_sum_to_the_input(spark):
    df = spark.range(0, 20000, 1, 4).select(F.col("id").cast("string").alias("k"))
    for weights in ((0.7, 0.2, 0.1), (0.6, 0.3, 0.1), [1] * 10, (1,), (3, 0, 1)):
        sizes = [p.count() for p in SP.random_split(df, weights)]
        total = sum(weights)
        assert sum(sizes) == 20000
        assert all(abs(n - 20000 * w / total) < 500 for n, w in zip(sizes, weights))


def test_time_split_swaps_all_or_none(spark):
    ratings = G.ratings_by_order(spark, SMALL)
    none_train, none_test = SP.time_split(ratings, swap=0)
    all_train, all_test = SP.time_split(ratings, swap=1)
    assert none_test.count() == all_test.count()
    # everybody who is only in the test part moves to training
    new = none_test.join(none_train.select("userid"), "userid", "left_anti")
    assert new.count() > 0 and new.select(*all_train.columns).exceptAll(all_train).count() == 0


def test_als_result_does_not_depend_on_partitions(spark):
    ratings = G.shared_ratings(spark, SMALL).select("userid", "businessid", "stars")
    few = M.recommend(M.train_als(ratings.coalesce(1)), ratings.select("userid"), 3)
    many = M.recommend(M.train_als(ratings.repartition(23)), ratings.select("userid"), 3)
    both = few.alias("a").join(many.alias("b"), ["userid", "businessid"])
    n = few.count()
    assert both.count() >= 0.98 * n  # same blocks; sums of floats may order near-ties differently
    assert both.where("abs(a.rating - b.rating) > 0.01").count() == 0


def test_requests_with_their_own_length(spark):
    ratings = G.shared_ratings(spark, SMALL)
    model = M.train_als(ratings)
    asked = spark.createDataFrame([(1, 2), (1, 4), (2, 0), (3, 99)], "userid int, res_num int")
    asked = asked.join(ratings.select("userid").distinct(), "userid")
    got = {r.userid: r["count"] for r in M.recommend(model, asked, 5, count_col="res_num").groupBy("userid").count().collect()}
    assert got == {u: n for u, n in {1: 4, 3: 5}.items() if u in {r.userid for r in asked.collect()}}


def test_requests_longer_than_the_default(spark):
    ratings = G.shared_ratings(spark, SMALL)
    model = M.train_als(ratings)
    items = model.itemFactors.count()
    users = [r.userid for r in ratings.select("userid").distinct().orderBy("userid").limit(4).collect()]
    asked = spark.createDataFrame(list(zip(users, [8, 10**9, None, 0])), "userid int, res_num int")
    got = {r.userid: r["count"] for r in M.recommend(model, asked, count_col="res_num").groupBy("userid").count().collect()}
    assert items > 8 and got == dict(zip(users, [8, items, 5]))


def test_als_bounds(spark, scratch):
    ratings = G.ratings(spark, SMALL)
    train, test = SP.time_split(ratings)
    model = M.train_als(train)
    recs = M.recommend(model, test.select("userid"), 5)
    per_user = recs.groupBy("userid").count().agg(F.max("count")).first()[0]
    assert per_user <= 5
    assert recs.where("rating < 0").count() == 0  # non-negative factors
    train_err = M.error_metrics(M.predict(model, train)).first()
    c = train.agg(F.avg("stars")).first()[0]
    base = M.error_metrics(train.withColumn("prediction", F.lit(c))).first()
    assert train_err["rmse"] < base["rmse"]
    grouped = M.recommend_grouped(recs).first()
    ratings_sorted = [x["rating"] for x in grouped["results"]]
    assert ratings_sorted == sorted(ratings_sorted, reverse=True)
    path = f"{scratch}/als-model"
    M.save_model(model, path)
    again = M.load_model(path)
    assert again.rank == 4


def test_train_and_evaluate_modes(spark):
    ratings = G.ratings(spark, SMALL)
    _, full = M.train_and_evaluate(ratings, full_data=True, just_train=True)
    assert full["training_nrows"] == full["test_nrows"] == ratings.count() and "test_rmse" not in full
    _, split = M.train_and_evaluate(ratings)
    assert split["test_nrows"] == ratings.distinct().count() * 3 // 10
    assert split["train_rmse"] > 0 and split["test_mse"] >= 0 and split["rank"] == 4
