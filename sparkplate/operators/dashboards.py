"""Dashboard queries A1-A26 and dashboard filters.

Each chart is ``GROUP BY group -> metric [ORDER BY metric DESC, group] [LIMIT k]`` over one of
the silver/gold tables. Every top-k carries a total order (metric desc, then the group
columns ascending with nulls last) so the same rows come back on every run; null groups
are kept. Aggregations are partial-then-final (map-side combine), so a hot group is
pre-aggregated in every task before the shuffle.

Inputs: ``dr`` = dim_restaurant, ``du`` = dim_user, ``fr`` = fact_review,
``ar`` = analyses_review.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkplate.functions.dates import month_start
from sparkplate.functions.numeric import round_half_up


def apply_filters(df: DataFrame, filters: Mapping[str, object] | None) -> DataFrame:
    """Equality / IN predicates of native and cross filters, applied before a chart.

    Declared as a plain ``where`` so Catalyst pushes it through views and joins to the scan.
    """
    for col, value in (filters or {}).items():
        if isinstance(value, (list, tuple, set, frozenset)):
            df = df.where(F.col(col).isin(list(value)))
        elif value is None:
            df = df.where(F.col(col).isNull())
        else:
            df = df.where(F.col(col) == F.lit(value))
    return df


def grouped_metric(df: DataFrame, by: Sequence[str | Column], metrics: Sequence[Column],
                   order_by: str | None = None, limit: int | None = None) -> DataFrame:
    """``GROUP BY by`` with ``metrics``; with ``limit``: top-k by ``order_by`` desc, ties by group."""
    out = df.groupBy(*by).agg(*metrics)
    if order_by is None:
        return out
    keys = [F.col(order_by).desc_nulls_last()] + [F.col(g).asc_nulls_last()
                                                  for g in out.columns[:len(by)]]
    out = out.orderBy(*keys)
    return out.limit(limit) if limit else out


def total(df: DataFrame, metric: Column) -> DataFrame:
    """A big-number chart: one row, one metric."""
    return df.agg(metric)


# ---- Dashboard 1: restaurant overview -------------------------------------------------

def a01_total_restaurants(dr: DataFrame) -> DataFrame:
    return total(dr, F.count_distinct("restaurant_id").alias("total_restaurants"))


def a02_avg_restaurant_rating(dr: DataFrame) -> DataFrame:
    return total(dr, round_half_up(F.avg("stars"), 2).alias("avg_rating"))


def a03_total_reviews(fr: DataFrame) -> DataFrame:
    return total(fr, F.count(F.lit(1)).alias("total_reviews"))


def a04_star_distribution(dr: DataFrame) -> DataFrame:
    return grouped_metric(dr, ["stars"], [F.count(F.lit(1)).alias("count")], order_by="count")


def a05_top_restaurants_by_reviews(dr: DataFrame, k: int = 20) -> DataFrame:
    """Grouped by name: restaurants sharing a name merge into one bar."""
    return grouped_metric(dr, ["restaurant_name"], [F.max("review_count").alias("review_count")],
                          order_by="review_count", limit=k)


def a06_open_vs_closed(dr: DataFrame) -> DataFrame:
    """Counts per ``is_open`` with the share of the total (W2). The window has no partition,
    but it runs on the already aggregated rows (one per ``is_open`` value)."""
    counts = dr.groupBy("is_open").agg(F.count(F.lit(1)).alias("count"))
    share = (F.col("count").cast("double") * 100) / F.sum("count").over(Window.partitionBy()).cast("double")
    return counts.select("is_open", "count", share.alias("pct"))


# ---- Dashboard 2: review analytics ----------------------------------------------------

def a07_reviews_over_time(ar: DataFrame) -> DataFrame:
    return grouped_metric(ar, [month_start("review_date").alias("month")],
                          [F.count(F.lit(1)).alias("reviews")])


def a08_avg_stars_over_time(ar: DataFrame) -> DataFrame:
    return grouped_metric(ar, [month_start("review_date").alias("month")],
                          [round_half_up(F.avg("stars"), 2).alias("avg_stars")])


def a09_total_funny(ar: DataFrame) -> DataFrame:
    return total(ar, F.sum("funny").cast("bigint").alias("total_funny"))


def a10_total_cool(ar: DataFrame) -> DataFrame:
    return total(ar, F.sum("cool").cast("bigint").alias("total_cool"))


def a11_total_useful(ar: DataFrame) -> DataFrame:
    return total(ar, F.sum("useful").cast("bigint").alias("total_useful"))


def a12_review_stars_distribution(ar: DataFrame) -> DataFrame:
    return grouped_metric(ar, ["stars"], [F.count(F.lit(1)).alias("count")])


# ---- Dashboard 3: geography -----------------------------------------------------------

def a13_top_cities(dr: DataFrame, k: int = 15) -> DataFrame:
    return grouped_metric(dr, ["city"], [F.count(F.lit(1)).alias("count")], order_by="count", limit=k)


def a14_restaurants_by_state(dr: DataFrame) -> DataFrame:
    return grouped_metric(dr, ["state"], [F.count(F.lit(1)).alias("count")])


def a15_avg_rating_by_city(ar: DataFrame, k: int = 15) -> DataFrame:
    """Mean over reviews (each review row counts), not over restaurants."""
    return grouped_metric(ar, ["city"], [round_half_up(F.avg("restaurant_stars"), 2).alias("avg_rating")],
                          order_by="avg_rating", limit=k)


def a16_city_metrics(ar: DataFrame, k: int = 50) -> DataFrame:
    return grouped_metric(ar, ["city", "state"], [
        F.count_distinct("restaurant_id").alias("restaurants"),
        F.count(F.lit(1)).alias("reviews"),
        round_half_up(F.avg("restaurant_stars"), 2).alias("avg_rating"),
    ], order_by="reviews", limit=k)


# ---- Dashboard 4: users ---------------------------------------------------------------

def a17_total_users(du: DataFrame) -> DataFrame:
    return total(du, F.count(F.lit(1)).alias("total_users"))


def a18_avg_reviews_per_user(du: DataFrame) -> DataFrame:
    return total(du, round_half_up(F.avg("review_count"), 1).alias("avg_reviews"))


def a19_top_reviewers(du: DataFrame, k: int = 20) -> DataFrame:
    return grouped_metric(du, ["user_name"], [F.max("review_count").alias("reviews")],
                          order_by="reviews", limit=k)


def a20_user_rating_distribution(du: DataFrame) -> DataFrame:
    return grouped_metric(du, ["average_stars"], [F.count(F.lit(1)).alias("users")])


# ---- Dashboard 5: executive summary ---------------------------------------------------

def a21_kpi_restaurants(dr: DataFrame) -> DataFrame:
    return a01_total_restaurants(dr)


def a22_kpi_reviews(fr: DataFrame) -> DataFrame:
    return a03_total_reviews(fr)


def a23_kpi_users(du: DataFrame) -> DataFrame:
    return a17_total_users(du)


def a24_top_cities_by_restaurants(ar: DataFrame, k: int = 5) -> DataFrame:
    return grouped_metric(ar, ["city"], [F.count_distinct("restaurant_id").alias("restaurants")],
                          order_by="restaurants", limit=k)


def a25_reviews_trend(ar: DataFrame) -> DataFrame:
    return a07_reviews_over_time(ar)


def a26_top_categories(ar: DataFrame, k: int = 10) -> DataFrame:
    """Grouped by the whole categories text (not split), counting reviews."""
    return grouped_metric(ar, ["categories"], [F.count(F.lit(1)).alias("count")],
                          order_by="count", limit=k)


# chart id -> (function, input table key)
CHARTS = {
    "a01_total_restaurants": (a01_total_restaurants, "dr"),
    "a02_avg_restaurant_rating": (a02_avg_restaurant_rating, "dr"),
    "a03_total_reviews": (a03_total_reviews, "fr"),
    "a04_star_distribution": (a04_star_distribution, "dr"),
    "a05_top_restaurants_by_reviews": (a05_top_restaurants_by_reviews, "dr"),
    "a06_open_vs_closed": (a06_open_vs_closed, "dr"),
    "a07_reviews_over_time": (a07_reviews_over_time, "ar"),
    "a08_avg_stars_over_time": (a08_avg_stars_over_time, "ar"),
    "a09_total_funny": (a09_total_funny, "ar"),
    "a10_total_cool": (a10_total_cool, "ar"),
    "a11_total_useful": (a11_total_useful, "ar"),
    "a12_review_stars_distribution": (a12_review_stars_distribution, "ar"),
    "a13_top_cities": (a13_top_cities, "dr"),
    "a14_restaurants_by_state": (a14_restaurants_by_state, "dr"),
    "a15_avg_rating_by_city": (a15_avg_rating_by_city, "ar"),
    "a16_city_metrics": (a16_city_metrics, "ar"),
    "a17_total_users": (a17_total_users, "du"),
    "a18_avg_reviews_per_user": (a18_avg_reviews_per_user, "du"),
    "a19_top_reviewers": (a19_top_reviewers, "du"),
    "a20_user_rating_distribution": (a20_user_rating_distribution, "du"),
    "a21_kpi_restaurants": (a21_kpi_restaurants, "dr"),
    "a22_kpi_reviews": (a22_kpi_reviews, "fr"),
    "a23_kpi_users": (a23_kpi_users, "du"),
    "a24_top_cities_by_restaurants": (a24_top_cities_by_restaurants, "ar"),
    "a25_reviews_trend": (a25_reviews_trend, "ar"),
    "a26_top_categories": (a26_top_categories, "ar"),
}
