"""Dense surrogate ids (M1) and the id joins.

The reference numbers keys with ``row_number()`` over a window with no partition, which
moves every key into one task. Here the same numbers come from a distributed rank:

1. range-partition the rows by the order (``num_partitions`` if given, else AQE sizes the
   partitions by merging adjacent ranges) and sort inside each;
2. tag each row with ``monotonically_increasing_id`` = (partition index, position);
3. count rows per partition (one row each), turn the counts into offsets with a running
   sum over those rows, and broadcast them (size bound: one row per partition);
4. number = offset of the partition + position + 1.

The tagged rows are written once to the shared checkpoint folder before steps 3-4: range
bounds come from sampling, and a second evaluation of step 1 could sample different bounds,
so counts and positions must come from one materialisation. The checkpoint also lets a
lost executor re-read its rows instead of recomputing the ranking. The order must be total
over the rows (the keys are distinct here).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkplate.session import cut_lineage

_POS_BITS = 33  # monotonically_increasing_id: partition index << 33 | position in partition


def global_row_number(df: DataFrame, order: Sequence[Column], out: str = "row_number",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based bigint ``row_number() OVER (ORDER BY order)`` without a single-partition exchange."""
    # without an explicit count AQE may merge adjacent range partitions (a merged
    # partition is still one contiguous range, so positions stay in order)
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    tagged = cut_lineage(
        ranged.sortWithinPartitions(*order)
        .withColumn("__rn_mid", F.monotonically_increasing_id())
        .withColumn("__rn_part", F.shiftright(F.col("__rn_mid"), _POS_BITS))
        .withColumn("__rn_idx", F.col("__rn_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))))
    sizes = tagged.groupBy("__rn_part").agg(F.count(F.lit(1)).alias("__rn_n"))
    before = Window.orderBy("__rn_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__rn_part", F.coalesce(F.sum("__rn_n").over(before), F.lit(0)).alias("__rn_off"))
    return (tagged.join(F.broadcast(offsets), "__rn_part")
            .withColumn(out, F.col("__rn_off") + F.col("__rn_idx") + 1)
            .drop("__rn_mid", "__rn_part", "__rn_idx", "__rn_off"))


def encode_ids(df: DataFrame, key: str, out: str, num_partitions: int | None = None) -> DataFrame:
    """M1: ``(key, out)``, with ``out`` = 1-based int rank of the distinct key (nulls first)."""
    keys = df.select(key).distinct()
    numbered = global_row_number(keys, [F.col(key).asc_nulls_first()], out, num_partitions)
    return numbered.withColumn(out, F.col(out).cast("int"))  # MLlib's ALS takes int ids only


def extend_ids(dictionary: DataFrame, df: DataFrame, key: str, out: str,
               num_partitions: int | None = None) -> DataFrame:
    """M1 for tables that grow: ``dictionary`` (key, out) with the unknown keys of ``df`` appended.

    Known keys keep their ids, so a saved model and published tables keep their meaning; new
    keys get the following numbers in key order (nulls first, a null key is a key). Over an empty
    dictionary this is ``encode_ids``. Only new keys are ranked; the dictionary is read for the
    anti-join and its greatest id.
    """
    known = dictionary.select(F.col(key).alias("_known"))
    new = df.select(key).distinct()
    new = new.join(known, new[key].eqNullSafe(F.col("_known")), "left_anti")
    last = dictionary.agg(F.max(out)).first()[0] or 0
    numbered = global_row_number(new, [F.col(key).asc_nulls_first()], out, num_partitions)
    appended = numbered.select(key, (F.col(out) + F.lit(int(last))).cast("int").alias(out))
    return dictionary.select(key, F.col(out).cast("int").alias(out)).unionByName(appended)


def restaurant_transform(restaurant: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Every restaurant row plus its dense ``businessid``."""
    ids = encode_ids(restaurant, "business_id", "businessid", num_partitions)
    return restaurant.join(ids, "business_id")


def user_account(user: DataFrame, with_pass: bool = False,
                 num_partitions: int | None = None) -> DataFrame:
    """``user_id, name, friends, userid, account_name`` (+ hashed ``account_pass``).

    ``account_name`` = name without spaces, lower-cased. The reference stores the plain
    name as the password; here only its SHA-256 is emitted, and only on request.
    """
    base = user.select("user_id", "name", "friends")
    ids = encode_ids(base, "user_id", "userid", num_partitions)
    out = base.join(ids, "user_id").withColumn(
        "account_name", F.lower(F.regexp_replace("name", " ", "")))
    if with_pass:
        out = out.withColumn("account_pass", F.sha2(F.col("account_name"), 256))
    return out


def encode_ratings(ratings: DataFrame, user_ids: DataFrame | None = None,
                   item_ids: DataFrame | None = None, own_keys: bool = False,
                   num_partitions: int | None = None) -> DataFrame:
    """Ratings with int ids: ``business_id, user_id, stars, date, userid, businessid``.

    Pass the maps built from the dimensions (``restaurant_transform`` / ``user_account``):
    training and look-up then share one numbering. ``own_keys=True`` numbers each missing
    side over the keys present in ``ratings`` instead (the reference's training script);
    such ids mean nothing to a dimension that has keys without ratings, so it must be asked
    for. The ratings are then written once and read for both maps and the join.
    """
    if (user_ids is None or item_ids is None) and not own_keys:
        raise ValueError("pass user_ids and item_ids, or own_keys=True")
    if user_ids is None or item_ids is None:
        ratings = cut_lineage(ratings)
    if user_ids is None:
        user_ids = encode_ids(ratings, "user_id", "userid", num_partitions)
    if item_ids is None:
        item_ids = encode_ids(ratings, "business_id", "businessid", num_partitions)
    return (ratings.join(user_ids.select("user_id", "userid"), "user_id")
            .join(item_ids.select("business_id", "businessid"), "business_id")
            .select("business_id", "user_id", "stars", "date", "userid", "businessid"))
