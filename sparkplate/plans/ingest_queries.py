"""Registered queries of the readers, saved models and the whole pipeline.

The driver's tables are Parquet, so each query first writes a given table, whole, as the raw
files that an operator reads (JSON lines in the shared folder), then reads them back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkplate.operators import als as M
from sparkplate.operators import split as SP
from sparkplate.plans import registry as G
from sparkplate.plans.pipeline import run_pipeline
from sparkplate.plans.sqlviews import with_views
from sparkplate.session import checkpoint_dir, cut_lineage, shuffle_tasks
from sparkplate.sources import analogs
from sparkplate.sources import raw as Rw
from sparkplate.sources.catalog import ensure_namespace, list_tables, write_table


def _folder(spark) -> str:
    return f"{checkpoint_dir(spark)}/raw-{uuid.uuid4().hex}"


def _json(df: DataFrame, path: str) -> str:
    df.write.json(path, compression="gzip")
    return path


# ---- readers (S1, S12, P14, P6, S6) ----------------------------------------------------

G.query("raw_reviews", with_views("SELECT * FROM an_review", "an_review"))(
    lambda s, d: Rw.read_raw(s, _json(analogs.an_review(s, d), _folder(s)), "review"))
G.query("raw_users_inferred", with_views("SELECT * FROM an_user", "an_user"))(
    lambda s, d: Rw.read_raw(s, _json(analogs.an_user(s, d), _folder(s)), "user", infer=True))
G.query("raw_restaurants", with_views("SELECT * FROM an_restaurant", "an_restaurant"))(
    lambda s, d: G.flat_hours(Rw.read_raw(s, _json(analogs.an_restaurant(s, d), _folder(s)), "business")))
G.query("photo_index", with_views("SELECT * FROM an_photos", "an_photos"))(
    lambda s, d: Rw.read_photo_index(s, _json(analogs.an_photos(s, d), _folder(s))))


@G.query("requests", "SELECT CAST(c_custkey AS INTEGER) AS userid, CAST(c_custkey % 9 AS INTEGER) AS res_num FROM customer")
def requests(s, d):
    """One request a customer; the token is not part of the table."""
    asked = analogs.table(s, d, "customer").select(
        F.col("c_custkey").alias("userid"), (F.col("c_custkey") % 9).alias("res_num"), F.md5("c_name").alias("token"))
    return Rw.read_requests(s, _json(asked, _folder(s)))


@G.query("image_info", """SELECT 'photos/' || event_id || '.jpg' AS origin, CAST(event_id % 640 + 1 AS INTEGER) AS width,
  CAST(event_id % 480 + 1 AS INTEGER) AS height FROM events""")
def image_info(s, d):
    """Fields out of an image struct, one a photo."""
    k = F.col("event_id")
    image = F.struct(F.concat(F.lit("photos/"), k, F.lit(".jpg")).alias("origin"), (k % 480 + 1).cast("int").alias("height"),
                     (k % 640 + 1).cast("int").alias("width"), F.lit(3).alias("nChannels"), F.lit(16).alias("mode"),
                     F.lit(None).cast("binary").alias("data"))
    return Rw.image_info(analogs.table(s, d, "events").select(image.alias("image")))


@G.query("listed_tables", "SELECT t AS table_name FROM (VALUES ('customer'), ('nation'), ('part')) v(t) "
         "WHERE (SELECT count(*) FROM part) >= 0")
def listed_tables(s, d):
    """Three tables written to a namespace, one of them twice; stored versions are not listed."""
    ns = f"sparkplate_list_{uuid.uuid4().hex}"
    ensure_namespace(s, ns)
    for name in ("nation", "customer", "part", "part"):
        write_table(analogs.table(s, d, name), f"{ns}.{name}")
    return list_tables(s, ns).select(F.col("tableName").alias("table_name"))


# ---- models (S11, S13, M4, M6) ---------------------------------------------------------

@G.query("als_saved_model", with_views(G._TRAINED + """SELECT count(*) AS predicted, CAST(0 AS BIGINT) AS changed FROM te
WHERE userid IN (SELECT userid FROM tr) AND businessid IN (SELECT businessid FROM tr)""", "shared_ratings"))
def als_saved_model(s, d):
    """A model that was saved and loaded predicts every test row as before."""
    model, test = G._model_and_test(s, d)
    path = _folder(s)
    M.save_model(model, path)
    test = cut_lineage(test)
    keys = ["userid", "businessid", "stars", "date"]
    before = M.predict(model, test).select(*keys, F.col("prediction").alias("_before"))
    after = M.predict(M.load_model(path), test).select(*keys, "prediction")
    both = before.join(after, keys).agg(
        F.count(F.lit(1)).alias("predicted"), F.count_if(~F.col("_before").eqNullSafe(F.col("prediction"))).alias("changed"))
    with shuffle_tasks(s, SP.tasks_of(test.count())):
        return cut_lineage(both)


@G.query("als_training_errors", with_views(G._TRAINED + """SELECT (SELECT count(*) FROM tr) AS training_nrows,
  (SELECT count(*) FROM te) AS test_nrows, true AS train_below_mean, true AS mse_is_rmse_squared""", "shared_ratings"))
def als_training_errors(s, d):
    """The train-and-evaluate run; on training rows the model must err less than their mean."""
    kept = {}

    def split(ratings):
        kept["train"], test = (cut_lineage(p) for p in SP.time_split(ratings))
        return kept["train"], test

    _, metrics = M.train_and_evaluate(G.shared_ratings(s, d), split=split)
    mean = kept["train"].agg(F.var_pop("stars").alias("mse"))  # the error of predicting the mean everywhere
    return mean.select(
        F.lit(metrics["training_nrows"]).cast("bigint").alias("training_nrows"),
        F.lit(metrics["test_nrows"]).cast("bigint").alias("test_nrows"),
        (F.lit(metrics["train_mse"]) < F.col("mse")).alias("train_below_mean"),
        F.lit(abs(metrics["test_rmse"] ** 2 - metrics["test_mse"]) < 1e-9).alias("mse_is_rmse_squared"))


# ---- the whole pipeline (M13) ----------------------------------------------------------

def raw_datasets(s, d) -> str:
    """The five raw datasets as JSON lines, from the given tables."""
    folder = _folder(s)
    review = analogs.an_review(s, d)
    # tips are taken from the written reviews, so their join runs once
    written = s.read.schema(review.schema).json(_json(review, f"{folder}/review.json"))
    for name, df in {"business": analogs.an_restaurant(s, d), "user": analogs.an_user(s, d),
                     "checkin": analogs.an_photos(s, d).select("business_id", F.col("label").alias("date")),
                     "tip": written.select("user_id", "business_id", "text", "date", F.col("cool").alias("compliment_count"))}.items():
        _json(df, f"{folder}/{name}.json")
    return folder


@G.query("pipeline_gold", with_views("SELECT * FROM analyses_review", "analyses_review"))
def pipeline_gold(s, d):
    """Raw files to bronze, silver and gold; the gold view's rows."""
    return G.flat_hours(run_pipeline(s, raw_datasets(s, d), train=False)["analyses_review"])


@G.query("pipeline_checks", """SELECT 'rows bronze.restaurant' AS name, count(*) AS n FROM part UNION ALL
SELECT 'rows bronze.user', count(*) FROM customer UNION ALL SELECT 'rows bronze.checkin', count(*) FROM events UNION ALL
SELECT 'rows bronze.review', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey UNION ALL
SELECT 'rows bronze.tip', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey UNION ALL
SELECT c, CAST(0 AS BIGINT) FROM (VALUES ('unique silver.dim_user.user_id'), ('not null silver.dim_user.user_id'),
  ('unique silver.dim_restaurant.restaurant_id'), ('not null silver.dim_restaurant.restaurant_id')) v(c)""")
def pipeline_checks(s, d):
    """What the pipeline counted while it wrote, and its key checks."""
    out = run_pipeline(s, raw_datasets(s, d), train=False)
    found = {**{f"rows {t}": n for t, n in out["rows"].items()}, **out["checks"]}
    return s.createDataFrame([(k, int(n)) for k, n in found.items()], "name string, n bigint")
