"""Collaborative filtering with ALS.

``pyspark.ml.recommendation.ALS`` is Spark's distributed block ALS: user and item factors
live in blocks joined per iteration, never on the driver. Iterative lineage is cut by
checkpoints into the shared checkpoint folder (``checkpointInterval``).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkplate.operators.topitems import top_items
from sparkplate.session import checkpoint_dir, cut_lineage

# The reference's two model configurations.
MAIN_CONFIG = dict(rank=4, max_iter=4, reg=0.35, nonnegative=True, seed=42)
ALT_CONFIG = dict(rank=12, max_iter=10, reg=0.1, nonnegative=False, seed=42)

#: Least factor blocks of users and of items. MLlib seeds its factors per block, so the number is
#: part of the result: it is taken from the ratings, not from the cluster. A block holds all
#: ratings of its users or items, so above ``NUM_BLOCKS * BLOCK_RATINGS`` ratings there are more.
NUM_BLOCKS = 10
BLOCK_RATINGS = 25_000_000


def _blocks(ratings: DataFrame, num_blocks: int | None) -> int:
    return num_blocks or max(NUM_BLOCKS, -(-ratings.count() // BLOCK_RATINGS))


def _training_rows(ratings: DataFrame, *cols: str) -> DataFrame:
    """The three columns of the fit, written once: MLlib evaluates its input twice."""
    checkpoint_dir(ratings.sparkSession)
    return cut_lineage(ratings.select(*cols))


def _als(rank, max_iter, reg, nonnegative, seed, cold_start, user_col, item_col, rating_col,
         num_blocks) -> ALS:
    return ALS(rank=rank, maxIter=max_iter, regParam=reg, userCol=user_col, itemCol=item_col,
              ratingCol=rating_col, nonnegative=nonnegative, implicitPrefs=False,
              coldStartStrategy=cold_start, seed=seed, checkpointInterval=5,
               numUserBlocks=num_blocks, numItemBlocks=num_blocks)


def train_als(ratings: DataFrame, rank: int = MAIN_CONFIG["rank"], max_iter: int = MAIN_CONFIG["max_iter"],
              reg: float = MAIN_CONFIG["reg"], nonnegative: bool = True, seed: int = 42, cold_start: str = "drop",
              user_col: str = "userid", item_col: str = "businessid", rating_col: str = "stars",
              num_blocks: int | None = None) -> ALSModel:
    """M4: explicit-feedback ALS; defaults are the reference's main configuration."""
    num_blocks = _blocks(ratings := _training_rows(ratings, user_col, item_col, rating_col), num_blocks)
    return _als(rank, max_iter, reg, nonnegative, seed, cold_start, user_col, item_col,
                rating_col, num_blocks).fit(ratings)


def train_als_pipeline(ratings: DataFrame, rank: int = ALT_CONFIG["rank"],
                       max_iter: int = ALT_CONFIG["max_iter"], reg: float = ALT_CONFIG["reg"],
                       seed: int = 42, user_col: str = "userid", item_col: str = "businessid",
                       rating_col: str = "stars", num_blocks: int | None = None) -> PipelineModel:
    """M4, second configuration: ALS as the single stage of a ``Pipeline``."""
    num_blocks = _blocks(ratings := _training_rows(ratings, user_col, item_col, rating_col), num_blocks)
    als = _als(rank, max_iter, reg, False, seed, "drop", user_col, item_col, rating_col,
               num_blocks)
    return Pipeline(stages=[als]).fit(ratings)


def predict(model, df: DataFrame) -> DataFrame:
    """M5: add ``prediction``; rows with an unseen user or item are dropped (cold start)."""
    return model.transform(df)


def error_metrics(pred: DataFrame, label: str = "stars", prediction: str = "prediction") -> DataFrame:
    """One row ``n, mse, rmse`` in one distributed aggregate (the reference logs the
    root-mean-square error under the name "mse"; both are given, named correctly)."""
    err = F.pow(F.col(label).cast("double") - F.col(prediction).cast("double"), 2)
    return (pred.where(F.col(prediction).isNotNull() & ~F.isnan(F.col(prediction)))
            .agg(F.count(F.lit(1)).alias("n"), F.avg(err).alias("mse"))
            .withColumn("rmse", F.sqrt("mse")))


def recommend(model: ALSModel, users: DataFrame, n: int | None = None, user_col: str = "userid",
              count_col: str | None = None) -> DataFrame:
    """Top-``n`` (5) items per requested user, long form ``(userid, businessid, rating)``.

    ``users`` is a table of requests (one HTTP request of the reference = one row here).
    ``count_col`` names a column with a request's own list length (null asks for 5), served
    whole; a user who asks several times gets the longest list. Only an ``n`` that is given
    beside it cuts lists, to the greatest length served.
    Lists come from the index of the item factors in boxes (``topitems``), so a user is not
    scored against items that cannot enter the list; ties go to the smaller item id.
    """
    if count_col:
        want = F.coalesce(F.max(count_col), F.lit(5))
        asked = users.groupBy(user_col).agg((want if n is None else F.least(want, F.lit(n))).alias("_want"))
    else:
        asked = users.select(user_col).distinct()
    asked = cut_lineage(asked)  # read up to four times
    if count_col:
        if n is None:  # no list is longer than the items, so a huge request needs no more room
            n = max(1, min(asked.agg(F.max("_want")).first()[0] or 0, model.itemFactors.count()))
    n = 5 if n is None else n
    named = asked.select(F.col(user_col).alias("id"))
    found = top_items(model.userFactors.join(named, "id", "left_semi").withColumnRenamed("id", "user"),
                      model.itemFactors.withColumnRenamed("id", "item"), n).rows
    recs = found.select(F.col("user").cast("int").alias(user_col), F.col("item").cast("int").alias(model.getItemCol()),
                        F.col("score").cast("float").alias("rating"), "rank")
    if count_col:
        recs = recs.join(asked, user_col).where(F.col("rank") <= F.col("_want"))
    return recs.select(user_col, model.getItemCol(), "rating")


def top_n(scores: DataFrame, n: int = 5, user_col: str = "userid", item_col: str = "businessid",
          score_col: str = "rating") -> DataFrame:
    """O5 over any scored candidates ``(user, item, score)``: each user's ``n`` best, ties by item.

    The row limit per group is applied inside every task before the shuffle."""
    best = Window.partitionBy(user_col).orderBy(F.col(score_col).desc(), F.col(item_col))
    return (scores.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= n).drop("_rank"))


def recommend_grouped(recs: DataFrame, user_col: str = "userid", item_col: str = "businessid") -> DataFrame:
    """M7, grouped form: one row per user with ``results`` sorted by rating desc.

    The list per user is bounded by ``n`` of ``recommend``."""
    packed = F.struct(F.col("rating"), F.col(item_col))
    ordered = F.sort_array(F.collect_list(packed), asc=False)
    return recs.groupBy(user_col).agg(
        F.transform(ordered, lambda s: F.struct(s[item_col].alias(item_col),
                                                s["rating"].alias("rating"))).alias("results"))


def save_model(model, path: str) -> None:
    """Overwrite-save of a fitted model (ALS or pipeline)."""
    model.write().overwrite().save(path)


def load_model(path: str, pipeline: bool = False):
    """Load a saved model once; reuse the returned object for every request batch."""
    return PipelineModel.load(path) if pipeline else ALSModel.load(path)


def train_and_evaluate(ratings: DataFrame, rank: int = 4, max_iter: int = 4, reg: float = 0.35,
                       full_data: bool = False, just_train: bool = False, seed: int = 42,
                       split=None) -> tuple[ALSModel, dict]:
    """M4-M6 wrapper: split (or train = test = all with ``full_data``), fit, and unless
    ``just_train`` evaluate on both sides. Returns the model and the run's metrics (row
    counts, errors and parameters), ready for ``runs.metrics_rows``."""
    if full_data:
        train, test = ratings, ratings
    else:
        from sparkplate.operators.split import time_split
        train, test = (split or time_split)(ratings)
    # Both sides are read several times below
    train, test = cut_lineage(train), cut_lineage(test)
    model = train_als(train, rank=rank, max_iter=max_iter, reg=reg, seed=seed)
    metrics = {"rank": rank, "max_iter": max_iter, "reg": reg,
               "training_nrows": train.count(), "test_nrows": test.count()}
    if not just_train:
        for side, df in (("test", test), ("train", train)):
            row = error_metrics(predict(model, df)).first()
            metrics[f"{side}_rmse"], metrics[f"{side}_mse"] = row["rmse"], row["mse"]
    return model, metrics
