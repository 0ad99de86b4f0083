"""A dashboard's charts from one scan of the review fact.

``build_rollup`` reads the fact once: counts and sums per (restaurant, month, stars), a partial
aggregate, so a restaurant with a third of all reviews is a few rows per task. All else comes
from that small table, which is written once:

* ``measures``: sums per (month, stars, city, state, categories, restaurant stars);
* ``members``: the restaurants of each (city, state, stars) as Spark bitmaps, which merge
  by ``bitmap_or_agg`` and count exactly. Restaurants get dense ids in the order of city and
  state, so a city's bits lie in few buckets of 32,768.

Charts add these states up, under any filter on the columns they carry, and give the rows of
the chart over ``analyses_review``. Nulls stay a group of their own; unmatched restaurants have
null dimension columns but count as restaurants, a null restaurant id counts only as reviews.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkplate.functions.dates import month_start
from sparkplate.functions.numeric import round_half_up
from sparkplate.operators.dashboards import apply_filters, grouped_metric
from sparkplate.operators.ids import global_row_number
from sparkplate.session import cut_lineage

DIMENSIONS = ["city", "state", "categories", "restaurant_stars"]
SUMS = ["funny", "cool", "useful"]


@dataclass
class Rollup:
    measures: DataFrame
    members: DataFrame


def build_rollup(fact: DataFrame, dim_restaurant: DataFrame) -> Rollup:
    """Both tables, from one scan of the fact. ``dim_restaurant`` has one row per restaurant."""
    base = cut_lineage(fact.groupBy("restaurant_id", month_start("review_date").alias("month"), "stars").agg(
        F.count(F.lit(1)).alias("reviews"), *[F.sum(c).alias(c) for c in SUMS]))
    dim = dim_restaurant.select(F.col("restaurant_id").alias("_rid"), "city", "state", "categories",
                                F.col("stars").alias("restaurant_stars"))
    joined = cut_lineage(base.join(dim, F.col("restaurant_id") == F.col("_rid"), "left").drop("_rid"))
    measures = joined.groupBy("month", "stars", *DIMENSIONS).agg(*[F.sum(c).alias(c) for c in ["reviews", *SUMS]])
    rated = joined.where(F.col("restaurant_id").isNotNull()).select("restaurant_id", "city", "state", "stars").distinct()
    rated = cut_lineage(rated)
    keys = rated.select("restaurant_id", "city", "state").distinct()
    numbered = cut_lineage(global_row_number(keys, [F.col(c).asc_nulls_first() for c in ("city", "state", "restaurant_id")], "number")
                           .select("restaurant_id", "number"))
    members = (rated.join(numbered, "restaurant_id")
               .groupBy("city", "state", "stars", F.bitmap_bucket_number("number").alias("bucket"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")))
    return Rollup(cut_lineage(measures), cut_lineage(members))


def _reviews() -> Column:
    return F.sum("reviews").alias("reviews")


def _mean(col: str, name: str) -> Column:
    """Mean of a group column over reviews; reviews without a value do not count."""
    n = F.sum(F.when(F.col(col).isNotNull(), F.col("reviews")))
    return round_half_up(F.sum(F.col(col) * F.col("reviews")) / n, 2).alias(name)


def _restaurants(r: Rollup, by: list[str]) -> DataFrame:
    """(by, restaurants): distinct restaurants of each group."""
    merged = r.members.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("restaurants"))


def _total(col: str, name: str) -> Callable[[Rollup], DataFrame]:
    return lambda r: r.measures.agg(F.sum(col).cast("bigint").alias(name))


def _over_time(r: Rollup) -> DataFrame:
    return grouped_metric(r.measures, ["month"], [_reviews()])


def _by_stars(r: Rollup) -> DataFrame:
    return grouped_metric(r.measures, ["stars"], [F.sum("reviews").alias("count")])


def _city_metrics(r: Rollup, k: int = 50) -> DataFrame:
    # measures and members side by side in one aggregate, so null cities need no null-safe join
    by = ["city", "state"]
    none = F.lit(None).cast("bigint")
    rows = r.measures.select(*by, "restaurant_stars", "reviews", none.alias("restaurants")).unionByName(
        _restaurants(r, by).select(*by, F.lit(None).cast("double").alias("restaurant_stars"), none.alias("reviews"), "restaurants"))
    metrics = [F.coalesce(F.sum("restaurants"), F.lit(0)).alias("restaurants"), _reviews(), _mean("restaurant_stars", "avg_rating")]
    return grouped_metric(rows, by, metrics, order_by="reviews", limit=k)


def _top_cities(r: Rollup, k: int = 5) -> DataFrame:
    # a city all of whose reviews lack a restaurant has none, but is a city
    rows = _restaurants(r, ["city"]).unionByName(r.measures.select("city", F.lit(0).cast("bigint").alias("restaurants")))
    return grouped_metric(rows, ["city"], [F.sum("restaurants").alias("restaurants")], order_by="restaurants", limit=k)


#: chart id -> its rows from the rollup
CHARTS: dict[str, Callable[[Rollup], DataFrame]] = {
    "a07_reviews_over_time": _over_time,
    "a08_avg_stars_over_time": lambda r: grouped_metric(r.measures, ["month"], [_mean("stars", "avg_stars")]),
    "a09_total_funny": _total("funny", "total_funny"),
    "a10_total_cool": _total("cool", "total_cool"),
    "a11_total_useful": _total("useful", "total_useful"),
    "a12_review_stars_distribution": _by_stars,
    "a15_avg_rating_by_city": lambda r: grouped_metric(r.measures, ["city"], [_mean("restaurant_stars", "avg_rating")],
                                                       order_by="avg_rating", limit=15),
    "a16_city_metrics": _city_metrics,
    "a24_top_cities_by_restaurants": _top_cities,
    "a25_reviews_trend": _over_time,
    "a26_top_categories": lambda r: grouped_metric(r.measures, ["categories"], [F.sum("reviews").alias("count")],
                                                   order_by="count", limit=10),
}
#: Columns that filters may name: those of both tables for charts that count restaurants.
COUNTING = {"a16_city_metrics", "a24_top_cities_by_restaurants"}


def chart(rollup: Rollup, name: str, filters: Mapping[str, object] | None = None) -> DataFrame:
    """A chart under dashboard filters (P17): on stars, city and state, and for charts that do not
    count restaurants also on month, categories and restaurant_stars."""
    known = set(rollup.members.columns if name in COUNTING else rollup.measures.columns) - {"bits", "bucket", "reviews", *SUMS}
    if wrong := set(filters or {}) - known:
        raise ValueError(f"{name} cannot be filtered by {sorted(wrong)} from the rollup; it carries {sorted(known)}")
    members = apply_filters(rollup.members, filters) if name in COUNTING else rollup.members
    return CHARTS[name](Rollup(apply_filters(rollup.measures, filters), members))
