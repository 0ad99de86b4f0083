"""Hand-made frames for the traps: ties, nulls, namesakes, unmatched keys, calendar edges."""

import math
from datetime import date

from pyspark.sql import functions as F

from sparkplate.operators import content as C
from sparkplate.operators import dashboards as A
from sparkplate.operators import lookup as L
from sparkplate.operators import quality as Q
from sparkplate.operators import scoring as S
from sparkplate.operators.gold import analyses_review
from sparkplate.operators.ids import encode_ids, global_row_number
from sparkplate.operators.silver import dim_date
from sparkplate.functions.text import text_features


def _dr(spark, rows):
    return spark.createDataFrame(rows, "restaurant_id string, restaurant_name string, categories string, "
                                       "city string, latitude double, longitude double, stars double, "
                                       "state string, review_count bigint, is_open bigint")


def test_gold_keeps_unmatched_facts(spark):
    fact = spark.createDataFrame(
        [("r1", "b1", "u1", 5, 0, 0, 0, "2020-01-01 00:00:00", "t"),
         ("r2", "bX", "uX", 3, 0, 0, 0, "2020-02-01 00:00:00", "t")],
        "review_id string, restaurant_id string, user_id string, stars bigint, cool bigint, funny bigint, "
        "useful bigint, review_date string, review_description string")
    dr = _dr(spark, [("b1", "A", "c", "X", 0.0, 0.0, 4.0, "S", 10, 1)])
    du = spark.createDataFrame([("u1", "Ann")], "user_id string, user_name string")
    ar = analyses_review(fact, dr, du)
    assert ar.count() == 2
    miss = ar.where("review_id = 'r2'").first()
    assert miss.city is None and miss.user_name is None and miss.restaurant_stars is None
    cities = {r.city: r.reviews for r in A.a16_city_metrics(ar).collect()}
    assert cities == {"X": 1, None: 1}
    assert ar.columns[:9] == fact.columns and "restaurant_stars" in ar.columns


def test_namesakes_merge_in_top_restaurants(spark):
    dr = _dr(spark, [("b1", "Same", "c", "X", 0.0, 0.0, 4.0, "S", 10, 1),
                     ("b2", "Same", "c", "X", 0.0, 0.0, 4.0, "S", 30, 1),
                     ("b3", "Other", "c", "X", 0.0, 0.0, 4.0, "S", 30, 0)])
    got = [(r.restaurant_name, r.review_count) for r in A.a05_top_restaurants_by_reviews(dr).collect()]
    assert got == [("Other", 30), ("Same", 30)]  # tie broken by name
    pct = {r.is_open: r.pct for r in A.a06_open_vs_closed(dr).collect()}
    assert math.isclose(pct[1], 200 / 3) and math.isclose(pct[0], 100 / 3)


def test_first_per_name_takes_smallest_id(spark):
    df = spark.createDataFrame([("b2", "Same"), ("b1", "Same"), ("b3", "Solo")], "business_id string, name string")
    got = {r.name: r.business_id for r in L.first_per(df, "name", "business_id").collect()}
    assert got == {"Same": "b1", "Solo": "b3"}


def test_dense_ids_match_literal_row_number(spark):
    keys = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).cast("string").alias("k"))
    got = encode_ids(keys.union(keys), "k", "kid", num_partitions=5)
    want = keys.distinct().selectExpr("k", "CAST(row_number() OVER (ORDER BY k) AS INT) AS kid")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_global_row_number_has_no_single_partition_sort(spark):
    from sparkplate.plans.checks import single_partition_exchanges
    df = spark.range(0, 1000, 1, 4).select(F.col("id"))
    out = global_row_number(df, [F.col("id").desc()], "rn", 4)
    # the only single-partition exchange is the running sum over the per-partition counts
    assert single_partition_exchanges(out) <= 1
    literal = df.selectExpr("id", "row_number() OVER (ORDER BY id DESC) AS rn")
    assert single_partition_exchanges(literal) == 1
    assert [r.rn for r in out.orderBy(F.col("id").desc()).limit(3).collect()] == [1, 2, 3]


def test_dim_date_calendar_edges(spark):
    rows = {r.CalendarDate: r for r in dim_date(spark, "2023-09-01", "2024-12-31").collect()}
    leap = rows[date(2024, 2, 29)]
    assert leap.IsLastDayOfMonth == "Y" and leap.dateInt == 20240229
    sunday = rows[date(2024, 3, 31)]
    assert (sunday.DayOfWeek, sunday.IsWeekDay, sunday.WeekOfYearIso, sunday.CalendarDay) == (7, "N", 13, "Sunday")
    assert (rows[date(2023, 9, 1)].FiscalMonthOctToSep, rows[date(2023, 10, 1)].FiscalMonthOctToSep) == (12, 1)
    assert (rows[date(2024, 6, 1)].FiscalMonthJulToJun, rows[date(2024, 7, 1)].FiscalMonthJulToJun) == (12, 1)
    assert rows[date(2023, 10, 1)].FiscalYearOctToSep == 2024
    assert dim_date(spark).count() == 9863


def test_weighted_rating_threshold_and_nulls(spark):
    df = spark.createDataFrame([(f"b{i}", f"n{i}", float(i % 5 + 1), i, 1) for i in range(1, 11)]
                               + [("bn", "nn", 5.0, None, 1)],
                               "business_id string, name string, stars double, review_count bigint, is_open bigint")
    out = S.weighted_rating(df)
    counts = sorted(r.review_count for r in out.collect())
    assert counts == [8, 9, 10]  # m = 7.3 (linear interpolation); null dropped
    top = S.top_scored(out, 2).collect()
    assert len(top) == 2 and top[0].score >= top[1].score


def test_text_features_null_and_missing(spark):
    df = spark.createDataFrame([("b1", "Cafe", None), ("b2", "Bar", "Pubs")],
                               "business_id string, name string, categories string")
    got = {r.business_id: r.text_features for r in text_features(df).collect()}
    assert got == {"b1": " Cafe", "b2": "Pubs Bar"}


def test_tfidf_numbers_and_unknown_title(spark):
    items = spark.createDataFrame([("b1", "x", "pizza pasta"), ("b2", "y", "pizza sushi"), ("b3", "z", "the and")],
                                  "business_id string, name string, text_features string")
    vec = C.tfidf(items)
    w = {(r.business_id, r.term): r.weight for r in vec.collect()}
    idf_p, idf_q = (math.log((1 + 3) / (1 + df)) + 1 for df in (2, 1))
    assert math.isclose(w[("b1", "pizza")], idf_p / math.hypot(idf_p, idf_q))
    assert not any(k[0] == "b3" for k in w)  # stop words only: zero vector
    sim = C.similar_items(vec, items, ["x"], k=5).collect()
    assert [r.business_id for r in sim] == ["b2", "b3"] and sim[1].score == 0.0
    empty = C.similar_items(vec, items, ["nope"], k=5)
    assert empty.count() == 0 and empty.columns == ["business_id", "name", "score"]


def test_weighted_rating_without_votes(spark):
    df = spark.createDataFrame([(f"b{i}", f"n{i}", 4.0, 0 if i < 9 else 5, 1) for i in range(10)],
                               "business_id string, name string, stars double, review_count bigint, is_open bigint")
    got = {r.business_id: r.score for r in S.weighted_rating(df).collect()}
    assert len(got) == 10 and got["b0"] is None and got["b9"] == 4.0  # m = 0: nothing to weigh for no votes


def test_exact_quantile_with_a_hot_value(spark):
    df = spark.range(0, 3000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"))
    vals = sorted(r.v for r in df.collect())
    for q in (0.0, 0.1, 0.5, 0.7, 0.999, 1.0):
        pos = q * (len(vals) - 1)
        lo = int(pos)
        hi = min(lo + 1, len(vals) - 1)
        assert math.isclose(S.exact_quantile(df, "v", q), vals[lo] + (vals[hi] - vals[lo]) * (pos - lo))
    assert S.exact_quantile(df.where("v < 0"), "v", 0.5) is None


def test_exact_quantile_narrows_by_sketch(spark, monkeypatch):
    """Small limits force many brackets; ties, gaps and hot values at the position stay exact."""
    monkeypatch.setattr(S, "FEW", 20)
    monkeypatch.setattr(S, "ACCURACY", 50)
    base = spark.range(0, 4000, 1, 6)
    for value in (F.col("id").cast("double"), F.col("id") % 7, F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") * F.col("id")),
                  F.lit(4), F.when(F.col("id") % 5 == 1, None).otherwise(-F.col("id") / 3), F.col("id") % 2):
        df = base.select(value.alias("v"))
        vals = sorted(float(r.v) for r in df.collect() if r.v is not None)
        for q in (0.0, 0.001, 0.3337, 0.5, 0.7, 0.9999, 1.0):
            pos = q * (len(vals) - 1)
            lo = int(pos)
            hi = min(lo + 1, len(vals) - 1)
            assert math.isclose(S.exact_quantile(df, "v", q), vals[lo] + (vals[hi] - vals[lo]) * (pos - lo))


def test_first_per_keeps_values_of_null_orders(spark):
    df = spark.createDataFrame([("k1", None, "v1"), ("k2", None, "x"), ("k2", 3, "b"), ("k2", 3, "a")],
                               "k string, o int, v string")
    got = {r.k: (r.o, r.v) for r in L.first_per(df, "k", "o").collect()}
    assert got == {"k1": (None, "v1"), "k2": (3, "a")}


def test_rounding_happens_once(spark):
    from sparkplate.functions.numeric import round_half_up
    df = spark.createDataFrame([(2.345,), (2.3449999996,), (-2.345,), (None,), (3.125,)], "x double")
    assert [r[0] for r in df.select(round_half_up("x", 2)).collect()] == [2.35, 2.34, -2.35, None, 3.13]


def test_malformed_dates_form_the_null_month(spark):
    ar = spark.createDataFrame([("2020-01-05 10:00:00", 4), ("not a date", 2), (None, 1)], "review_date string, stars int")
    got = {r.month: r.reviews for r in A.a07_reviews_over_time(ar).collect()}
    assert got == {date(2020, 1, 1): 1, None: 2}


def test_unreviewed_restaurants_keep_their_ids(spark):
    """Ratings numbered by the dimensions: recommendations name the right restaurant."""
    from sparkplate.operators.ids import encode_ratings, restaurant_transform, user_account
    rest = spark.createDataFrame([("b1", "Empty"), ("b2", "Pho"), ("b3", "Taco")], "business_id string, name string")
    users = spark.createDataFrame([("u0", "Ann", ""), ("u1", "Bo", "")], "user_id string, name string, friends string")
    reviews = spark.createDataFrame([("b2", "u1", 5, "2020-01-01"), ("b3", "u1", 1, "2020-01-02")],
                                    "business_id string, user_id string, stars int, date string")
    items = restaurant_transform(rest)
    r = encode_ratings(reviews, user_ids=user_account(users), item_ids=items)
    assert {(x.business_id, x.businessid, x.userid) for x in r.collect()} == {("b2", 2, 2), ("b3", 3, 2)}
    recs = r.select("userid", "businessid", F.col("stars").cast("float").alias("rating"))
    got = {(x.business_id, x.name, x.score) for x in L.enrich_recommendations(recs, items).collect()}
    assert got == {("b2", "Pho", 5.0), ("b3", "Taco", 1.0)}
    import pytest
    with pytest.raises(ValueError):
        encode_ratings(reviews)


def test_quality_checks_report_offenders(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert [(r.k, r.n) for r in Q.check_unique(df, "k").collect()] == [("a", 2)]
    assert Q.check_not_null(df, "k").count() == 1
    counts = {r.table_name: r.row_count for r in Q.table_counts({"t1": df, "t2": df.limit(1)}).collect()}
    assert counts == {"t1": 4, "t2": 1}


def test_except_distinct_aligns_by_name_and_dedups(spark):
    from sparkplate.operators.split import except_distinct
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int")
    assert [tuple(r) for r in except_distinct(a, b).collect()] == [(1, "x")]


def test_city_dashboard_prunes_columns(spark):
    from sparkplate.plans.checks import read_schemas
    from sparkplate.plans import registry as G
    from conftest import SMALL
    schemas = read_schemas(A.a16_city_metrics(G.ar(spark, SMALL)))
    assert "struct<l_orderkey:bigint,l_partkey:bigint>" in schemas
    assert all("l_extendedprice" not in s for s in schemas)


def test_skipping_unused_dimensions_keeps_results(spark):
    from sparkplate.plans import registry as G
    from sparkplate.plans.checks import read_schemas
    from conftest import SMALL
    fr, dr, du = G.fr(spark, SMALL), G.dr(spark, SMALL), G.du(spark, SMALL)
    full = A.a16_city_metrics(analyses_review(fr, dr, du))
    lean_ar = analyses_review(fr, dr, du, needed=["city", "state", "restaurant_id", "restaurant_stars"],
                              unique_dims=True)
    lean = A.a16_city_metrics(lean_ar)
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, lean.collect()))
    assert "user_name" not in lean_ar.columns
    assert not any("c_custkey" in s for s in read_schemas(lean))  # the user dimension is not read
    facts_only = analyses_review(fr, dr, du, needed=["review_date", "stars"], unique_dims=True)
    assert facts_only.columns == fr.columns
    assert A.a07_reviews_over_time(facts_only).exceptAll(
        A.a07_reviews_over_time(analyses_review(fr, dr, du))).count() == 0
