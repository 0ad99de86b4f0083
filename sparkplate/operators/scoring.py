"""Score-based recommendations."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkplate.functions.scoring import weighted_rating as _formula


#: Values inside a bracket that are few enough to be ordered in one task.
FEW = 100_000
#: Accuracy of the sketch (rank errors of 1 / ACCURACY of the rows).
ACCURACY = 10_000


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    """Linear-interpolation quantile of the non-null values (pandas' default rule), exact.

    A mergeable sketch (``percentile_approx``, one partial aggregate) brackets the position; one
    pass counts what lies below and inside. While more than ``FEW`` rows lie inside, the bracket
    is narrowed the same way, by thousands each time. The values inside are then counted by
    value and only they are ordered. A bracket that misses the position (the sketch's errors
    are no promise) is widened, so the result never depends on the sketch. Nothing is range
    partitioned and no distinct value leaves its task unless it lies inside the last bracket.
    """
    v = F.col("_v")
    vals = df.select(F.col(col).cast("double").alias("_v")).where(v.isNotNull())
    inside, below, slack = vals, 0, 2 / ACCURACY
    n = rows = vals.count()
    if not n:
        return None
    pos = q * (n - 1)
    lo = math.floor(pos)
    hi = min(lo + 1, n - 1)
    while rows > FEW and slack < 1:
        shares = [max(0.0, (lo - below) / rows - slack), min(1.0, (hi - below + 1) / rows + slack)]
        a, b = inside.agg(F.percentile_approx("_v", shares, ACCURACY)).first()[0]
        less, upto = inside.agg(F.count_if(v < F.lit(a)), F.count_if(v <= F.lit(b))).first()
        if not below + less <= lo <= hi < below + upto:
            slack *= 8
            continue
        if a == b:  # ties cover the position
            return a
        if upto - less == rows:
            break  # few values with many ties each: counted by value below
        inside, below, rows = inside.where(v.between(F.lit(a), F.lit(b))), below + less, upto - less
    counts = inside.groupBy("_v").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)) + F.lit(below)
    ends = counts.select("_v", "_n", upto.alias("_end"))
    holds = [(F.col("_end") > i) & (F.col("_end") - F.col("_n") <= i) for i in (lo, hi)]
    got = ends.agg(*[F.max(F.when(h, F.col("_v"))) for h in holds]).first()
    return got[0] + (got[1] - got[0]) * (pos - lo)


def weighted_rating(df: DataFrame, q: float = 0.70, votes: str = "review_count", stars: str = "stars",
                    approx: bool = False, accuracy: int = 100000) -> DataFrame:
    """M8: keep items with ``votes >= m`` (m = q-quantile of votes, linear interpolation;
    null votes dropped) and score them against the global mean ``C`` of ``stars``.

    Both statistics are scalars from distributed jobs (the mean a partial aggregate, the
    quantile ``exact_quantile``); as literals they let Catalyst push ``votes >= m`` into
    the scan. ``approx=True`` uses ``percentile_approx`` (one pass, bounded memory).
    """
    if approx:
        stats = df.agg(F.avg(stars).alias("C"),
                       F.percentile_approx(votes, q, accuracy).cast("double").alias("m")).first()
        c_val, m_val = stats["C"], stats["m"]
    else:
        c_val, m_val = df.agg(F.avg(stars)).first()[0], exact_quantile(df, votes, q)
    if m_val is None:  # no votes at all: nothing qualifies
        return df.where(F.lit(False)).withColumn("score", F.lit(None).cast("double"))
    c, m = F.lit(c_val).cast("double"), F.lit(m_val).cast("double")
    return (df.where(F.col(votes) >= m)
            .withColumn("score", _formula(F.col(votes).cast("double"), F.col(stars), m, c)))


def ranked(scored: DataFrame) -> DataFrame:
    """O2: score desc, ties by votes desc then id (a total order)."""
    return scored.orderBy(F.col("score").desc(), F.col("review_count").desc(), F.col("business_id"))


def top_scored(scored: DataFrame, k: int = 5) -> DataFrame:
    """The first ``k`` items of the ranking: ``business_id, name, score``."""
    return ranked(scored).limit(k).select("business_id", "name", "score")
