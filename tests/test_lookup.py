"""Look-ups, enrichment, cards and run selection on hand-made frames."""

from datetime import datetime

from sparkplate.operators import lookup as L
from sparkplate.operators import runs as R
from sparkplate.operators.ids import user_account


def test_account_names_collide_smallest_userid_wins(spark):
    users = spark.createDataFrame([("u2", "Ann Lee", ""), ("u1", "ann lee", ""), ("u3", "Bo", "")],
                                  "user_id string, name string, friends string")
    acc = user_account(users)
    assert {r.account_name for r in acc.collect()} == {"annlee", "bo"}
    got = L.lookup(acc, "account_name", acc.select("account_name"), ["name", "userid"], "userid")
    assert {r.account_name: r.userid for r in got.collect()} == {"annlee": 1, "bo": 3}
    hashed = user_account(users, with_pass=True).first()
    assert len(hashed.account_pass) == 64 and hashed.account_pass != hashed.account_name


def test_enrich_drops_missing_and_dedups(spark):
    recs = spark.createDataFrame([(7, 1, 4.5), (7, 2, 4.0), (7, 9, 3.0)], "userid int, businessid int, rating float")
    items = spark.createDataFrame([(1, "b1", "Pho"), (1, "b1", "Pho"), (2, "b2", None)],
                                  "businessid int, business_id string, name string")
    got = [tuple(r) for r in L.enrich_recommendations(recs, items).collect()]
    assert got == [(7, "b1", "Pho", 4.5)]


def test_first_photo_and_fallback(spark):
    items = spark.createDataFrame([("b1",), ("b2",)], "business_id string")
    photos = spark.createDataFrame([("b1", "p9", "c", "l"), ("b1", "p3", "c", "l")],
                                   "business_id string, photo_id string, caption string, label string")
    got = {r.business_id: r.poster for r in L.with_poster(items, photos).collect()}
    assert got == {"b1": "photos/p3.jpg", "b2": "fallback.jpg"}


def test_detail_card(spark):
    scored = spark.createDataFrame([("b1", "A", 1, 3.14159), ("b2", "B", 0, 2.345)],
                                   "business_id string, name string, is_open bigint, score double")
    got = {r.business_id: (r.status, r.score_card, r.score_list) for r in L.detail_card(scored).collect()}
    assert got == {"b1": ("Opening", 3.14, 3.142), "b2": ("Closed", 2.35, 2.345)}


def test_runs_best_and_find(spark):
    t0, t1 = datetime(2024, 1, 1), datetime(2024, 2, 1)
    m = (R.metrics_rows(spark, "r1", "als", {"rmse": 1.2, "mse": 1.44}, t0)
         .unionByName(R.metrics_rows(spark, "r2", "als", {"rmse": 0.9, "mse": 0.81}, t1))
         .unionByName(R.metrics_rows(spark, "r3", "other", {"rmse": 0.5}, t1)))
    assert R.best_run(m).first().run_id == "r3"
    assert R.best_run(m, run_name="als").first().run_id == "r2"
    assert [r.run_id for r in R.find_run(m, "als").collect()][:2] == ["r2", "r2"]
