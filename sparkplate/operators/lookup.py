"""Look-ups, first-row rules and enrichment.

The reference answers these with one SQL round-trip per item; here each is one join or
one aggregation over all requested keys at once. "First row" means the row with the
smallest value of an explicit order column, so the answer is the same on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkplate.session import cut_lineage


def first_per(df: DataFrame, key: str | Sequence[str], order: str) -> DataFrame:
    """One row per ``key``, the one with the smallest ``order``; a null ``order`` comes
    last, ties go to the smallest row of the other (orderable) columns.

    ``min_by`` over a struct is a partial aggregate: a key that holds a third of all rows
    is reduced inside every task before the shuffle, unlike a window over the key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    orderable = [c for c, t in df.dtypes if c in rest and "map<" not in t and "variant" not in t]
    rank = F.struct(F.col(order).isNull(), F.col(order), *[F.col(c) for c in orderable if c != order])
    packed = F.min_by(F.struct(*[F.col(c) for c in rest]), rank).alias("_first")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest])


def lookup(df: DataFrame, key: str, keys: DataFrame, value_cols: Sequence[str], order: str) -> DataFrame:
    """P10: for every requested key (a DataFrame with column ``key``), the values of its
    first matching row (smallest ``order``); keys without a match are absent."""
    wanted = df.select(key, *[c for c in dict.fromkeys([*value_cols, order]) if c != key])
    hits = wanted.join(keys.select(key).distinct(), key, "left_semi")
    return first_per(hits, key, order).select(key, *value_cols)


def read_item(df: DataFrame, name: str, name_col: str = "name", order: str = "business_id") -> DataFrame:
    """The first row carrying ``name`` (by ``order``); empty if the name is unknown."""
    return df.where(F.col(name_col) == F.lit(name)).orderBy(F.col(order).asc_nulls_last()).limit(1)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """U4: the distinct values of one column (e.g. names for a picker)."""
    return df.select(col).distinct()


def enrich_recommendations(recs: DataFrame, items: DataFrame, id_col: str = "businessid",
                           key_col: str = "business_id", name_col: str = "name") -> DataFrame:
    """``(userid, businessid, rating)`` -> ``(userid, business_id, name, score)``.

    One inner join against the item table deduplicated to one row per id (the first by
    ``key_col``); recommendations whose id or name is missing are dropped, as in the
    reference. The item side is written once to the shared folder, so the join has an
    exchange of its own on both sides: AQE broadcasts a small item table, and otherwise can
    split an item that sits in a large share of all lists.
    """
    one = cut_lineage(first_per(items.select(id_col, key_col, name_col).where(
        F.col(key_col).isNotNull() & F.col(name_col).isNotNull()), id_col, key_col))
    return (recs.join(one, id_col)
            .select("userid", key_col, name_col, F.col("rating").alias("score")))


def with_poster(df: DataFrame, photos: DataFrame, fallback: str = "fallback.jpg",
                prefix: str = "photos/", key: str = "business_id") -> DataFrame:
    """Every row of ``df`` plus ``poster``: its first photo (smallest ``photo_id``) as
    ``prefix + photo_id + '.jpg'``, else ``fallback``. Photos are reduced to one row per
    business before the left join, so a business with many photos costs one row."""
    first = first_per(photos.select(key, "photo_id"), key, "photo_id")
    return (df.join(first, key, "left")
            .withColumn("poster", F.coalesce(F.concat(F.lit(prefix), F.col("photo_id"), F.lit(".jpg")),
                                             F.lit(fallback)))
            .drop("photo_id"))


def detail_card(scored: DataFrame) -> DataFrame:
    """Status text and the two roundings of the score used by the cards and lists."""
    from sparkplate.functions.numeric import round_half_up
    return scored.select(
        "business_id", "name",
        F.when(F.col("is_open") == 1, F.lit("Opening")).otherwise(F.lit("Closed")).alias("status"),
        round_half_up(F.col("score"), 2).alias("score_card"),
        round_half_up(F.col("score"), 3).alias("score_list"),
    )
