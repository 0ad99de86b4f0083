"""Gold layer: the review fact joined to both dimensions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Restaurant columns carried into the gold table, (dimension name, gold name).
GOLD_RESTAURANT_COLUMNS = [
    ("restaurant_name", "restaurant_name"), ("categories", "categories"), ("city", "city"),
    ("latitude", "latitude"), ("longitude", "longitude"), ("stars", "restaurant_stars"),
    ("state", "state"), ("review_count", "review_count"), ("hours", "hours"),
]


def analyses_review(fact: DataFrame, dim_restaurant: DataFrame, dim_user: DataFrame,
                    needed: Iterable[str] | None = None, unique_dims: bool = False) -> DataFrame:
    """Fact LEFT JOIN restaurants LEFT JOIN users; 20 columns, unmatched facts kept.

    Only the needed dimension columns enter the joins. Users come first: they add one short column,
    so the wide restaurant columns are not shuffled again, and a filter on the user's name is
    applied before the restaurants are joined. No broadcast hint: AQE broadcasts a
    dimension only when its runtime size is under the threshold and otherwise keeps the
    sort-merge join, splitting a hot restaurant or user key (skew join) on the fact side.

    ``needed`` + ``unique_dims=True``: when the caller uses only the listed columns and
    the dimension keys are known to be unique (D1 passes), a dimension none of whose
    columns is needed is not joined at all. Catalyst keeps an unused left join (it cannot
    know the key is unique), so this saves a shuffle of the whole fact per skipped
    dimension. Off by default: with a duplicated key the join would fan rows out.
    """
    if unique_dims and needed is not None:
        needed = set(needed)
        gold_names = {g for _, g in GOLD_RESTAURANT_COLUMNS}
        if not needed & gold_names:
            dim_restaurant = None
        if "user_name" not in needed:
            dim_user = None
    return _star_join(fact, dim_restaurant, dim_user)


def gold_sql(fact: str, dim_restaurant: str, dim_user: str) -> str:
    """J4 as SQL text over catalog views, for a view that outlives the session."""
    carried = ", ".join(f"dr.{c} AS {g}" for c, g in GOLD_RESTAURANT_COLUMNS)
    return (f"SELECT fr.*, {carried}, du.user_name FROM {fact} fr "
            f"LEFT JOIN {dim_user} du ON fr.user_id = du.user_id "
            f"LEFT JOIN {dim_restaurant} dr ON fr.restaurant_id = dr.restaurant_id")


def _star_join(fact: DataFrame, dim_restaurant: DataFrame | None, dim_user: DataFrame | None) -> DataFrame:
    out = fact
    if dim_user is not None:
        du = dim_user.select(F.col("user_id").alias("_uid"), F.col("user_name").alias("_du_user_name"))
        out = out.join(du, out["user_id"] == du["_uid"], "left")
    if dim_restaurant is not None:
        wanted = [c for c, _ in GOLD_RESTAURANT_COLUMNS if c in dim_restaurant.columns]
        dr = dim_restaurant.select(F.col("restaurant_id").alias("_rid"),
                                   *[F.col(c).alias(f"_dr_{c}") for c in wanted])
        out = out.join(dr, out["restaurant_id"] == dr["_rid"], "left")
    cols = [fact[c] for c in fact.columns]
    if dim_restaurant is not None:
        cols += [F.col(f"_dr_{c}").alias(g) for c, g in GOLD_RESTAURANT_COLUMNS if c in wanted]
    if dim_user is not None:
        cols.append(F.col("_du_user_name").alias("user_name"))
    return out.select(*cols)

