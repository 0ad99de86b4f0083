"""Train/test splits.

``time_split`` builds the documented intent of the reference's split, deterministically:

1. distinct ratings; ``n = floor(count * ratio)``; test = the ``n`` latest rows under the
   total order (date desc, user_id, business_id, stars), train = the rest;
2. "new" test rows = rows whose user has no training row (an anti-join by intent);
3. a share ``swap`` of the new rows moves to train, chosen by a hash of the row (same rows
   on every run and in every engine); the same number ``k`` of the latest training rows
   moves to test, so the test size stays ``n``.

The ratings are counted and made distinct in tasks of about ``ROWS_PER_TASK`` rows, so that a
task's memory does not grow with the table. The distinct ratings are written once. Both cuts of the order (after ``n`` and after ``n + k``
rows) come from a histogram by day, of which only the boundary day is ordered
(``select.Front``), and are plain predicates over the stored rows. New users are found by one
partial aggregate (users all of whose rows are late) and written, one row each; the late rows
are joined to them, both sides exchanged for it alone, so that AQE can split a hot user.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkplate.operators.select import Front, Key
from sparkplate.session import cut_lineage, shuffle_tasks

RATING_COLUMNS = ["business_id", "user_id", "stars", "date", "userid", "businessid"]
#: O1: latest first, ties by user, item and stars.
LATEST = [Key("date", descending=True), Key("user_id"), Key("business_id"), Key("stars")]

HASH_BITS = 60

#: Rows of one task that keeps its rows in memory to tell them apart.
ROWS_PER_TASK = 500_000


def hash60(*parts: Column) -> Column:
    """A 60-bit non-negative integer from the md5 of the parts joined by ``|``."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def share_bound(share: float | Fraction) -> int:
    """Hashes below it make up ``share`` of all; 1 and more take every row, 0 none."""
    return min(1 << HASH_BITS, max(0, int((share if isinstance(share, Fraction) else Fraction(str(share))) * (1 << HASH_BITS))))


def row_hash(seed: int) -> Column:
    return hash60(F.lit(str(seed)), F.col("user_id"), F.col("business_id"), F.col("date"),
                  F.col("stars").cast("string"))


def users_never_in(rows: DataFrame, users: DataFrame) -> DataFrame:
    """``rows`` whose ``userid`` is not among ``users`` (one row each, already written, so
    that both sides are exchanged for this join alone and a hot user can be split)."""
    return rows.join(users.select(F.col("userid").alias("_uid")), F.col("userid") == F.col("_uid"), "left").where(
        F.col("_uid").isNull()).drop("_uid")


def tasks_of(rows: int) -> int:
    return -(-rows // ROWS_PER_TASK)


def distinct_rows(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The distinct rows of a table of about ``rows``, which are counted if not given. Spark merges partitions by
    compressed bytes, of which such rows have few; a table of many rows is dealt out by all columns to tasks of
    ``ROWS_PER_TASK``."""
    tasks = tasks_of(df.count() if rows is None else rows)
    return (df.repartition(tasks, *df.columns) if tasks > df.sparkSession.sparkContext.defaultParallelism else df).distinct()


def time_split(ratings: DataFrame, ratio: float = 0.3, swap: float = 0.3, seed: int = 42,
               num_partitions: int | None = None, rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """M3: ``(train, test)`` with ``userid``, ``businessid``, ``stars`` cast to int. ``rows``, the number
    of ratings as far as it is known, sets the number of tasks only; without it they are counted."""
    spark, ratings = ratings.sparkSession, ratings.select(*RATING_COLUMNS)
    rows = ratings.count() if rows is None else rows
    with shuffle_tasks(spark, tasks_of(rows)):  # the joins that make the ratings run here too
        d = cut_lineage(distinct_rows(ratings, rows))
    front = Front(d, LATEST, num_partitions=num_partitions)
    n = int(Fraction(front.total) * Fraction(str(ratio)))
    late, bound = front.first(n), share_bound(swap)
    early_rows, late_rows = d.where(~late), d.where(late)
    if not bound:
        return _typed(early_rows), _typed(late_rows)
    late_users = d.groupBy("userid").agg(F.min(late).alias("_late")).where("_late")
    new = cut_lineage(late_users.select(F.col("userid").alias("_uid"), F.lit(True).alias("_new")))
    flagged = late_rows.join(new, F.col("userid").eqNullSafe(F.col("_uid")), "left").withColumn(
        "_moves", F.col("_new").isNotNull() & (row_hash(seed) < F.lit(bound)))
    k = flagged.where("_moves").count()
    if not k:
        return _typed(early_rows), _typed(late_rows)
    swapped = front.first(n + k)
    train = d.where(~swapped).unionByName(flagged.where("_moves").select(*d.columns))
    test = flagged.where("NOT _moves").select(*d.columns).unionByName(d.where(~late & swapped))
    return _typed(train), _typed(test)


def _typed(df: DataFrame) -> DataFrame:
    return df.select("business_id", "user_id", F.col("stars").cast("int").alias("stars"), "date",
                     F.col("userid").cast("int").alias("userid"),
                     F.col("businessid").cast("int").alias("businessid"))


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """M3(c): split by weights, each row placed by a seeded hash of its values.

    The piece of a row depends only on the row and the seed, never on partitioning or
    re-evaluation, so the pieces are disjoint and complete on every run (``randomSplit``
    samples per partition and may differ when a partition is recomputed).
    """
    shares = [Fraction(str(w)) for w in weights]
    total, acc, bounds = sum(shares), Fraction(0), []
    for w in shares:
        acc += w
        bounds.append(share_bound(acc / total))
    u = hash60(F.lit(str(seed)), *[F.col(c).cast("string") for c in df.columns])
    pieces, lower = [], 0
    for i, upper in enumerate(bounds):
        cond = u >= F.lit(lower)
        if i < len(bounds) - 1:  # the last piece is open, so every row has a piece
            cond = cond & (u < F.lit(upper))
        pieces.append(df.where(cond))
        lower = upper
    return pieces


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` not in ``right``, duplicates removed (``EXCEPT DISTINCT``).

    Columns are matched by name: the right side is re-ordered to the left's columns first,
    so a join that moved a key to the front cannot turn this into a comparison of unlike
    columns (the positional pitfall of ``subtract``)."""
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"columns differ: {left.columns} vs {right.columns}")
    return left.subtract(right.select(*left.columns))
