"""The whole medallion build in one Spark application.

raw JSON lines -> bronze tables -> id-mapped bronze tables and feature store -> silver
views and the calendar table -> gold view -> ALS training with the time split and a
metrics table. Each step is a function of DataFrames; the steps a user re-runs alone are
the same functions.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from sparkplate.operators import als as M
from sparkplate.operators import quality as Q
from sparkplate.operators import runs as R
from sparkplate.operators.gold import gold_sql
from sparkplate.operators.ids import encode_ratings, restaurant_transform, user_account
from sparkplate.operators.split import random_split
from sparkplate.operators.silver import dim_date, review_features, view_sql
from sparkplate.sources.catalog import ensure_namespace, publish_table, publish_view, write_table
from sparkplate.session import cut_lineage
from sparkplate.sources.raw import read_images, read_raw

# Raw dataset -> bronze table.
BRONZE = {"business": "restaurant", "user": "user", "review": "review", "checkin": "checkin", "tip": "tip"}


# The keys that must be unique and present, as (bronze dataset, its key).
KEYS = {"silver.dim_user": ("user_id", "user", "user_id"), "silver.dim_restaurant": ("restaurant_id", "business", "business_id")}


def observed(dataset: str) -> dict[str, Column]:
    """What the write of a bronze table counts on its way: rows (A32), and nulls of a checked key."""
    out = {"rows": F.count(F.lit(1))}
    for _, source, key in KEYS.values():
        if source == dataset:
            out["nulls"] = F.count_if(F.col(key).isNull())
    return out


def check_keys(spark: SparkSession, written: dict[str, dict]) -> dict[str, int]:
    """D1/D2 after the build: offending rows per check (0 = passed). The nulls were counted while the
    bronze tables were written (the silver views keep every row); only uniqueness needs a scan."""
    found = {}
    for view, (key, source, _) in KEYS.items():
        found[f"unique {view}.{key}"] = Q.check_unique(spark.table(view), key).count()
        found[f"not null {view}.{key}"] = written[source]["nulls"]
    return found


def run_pipeline(spark: SparkSession, raw_dir: str, fmt: str = "parquet", train: bool = True,
                 model_path: str | None = None, metrics_table: str = "feature_store.metrics",
                 images: str | None = None) -> dict:
    """Build everything; ``images`` names a photo folder to ingest. Silver and gold are
    catalog views, so any later session of the same catalog can query them."""
    for ns in ("bronze", "silver", "gold", "feature_store"):
        ensure_namespace(spark, ns)
    written = {dataset: write_table(read_raw(spark, f"{raw_dir}/{dataset}.json", dataset), f"bronze.{name}", fmt,
                                    observe=observed(dataset))
               for dataset, name in BRONZE.items()}
    if images:
        write_table(read_images(spark, images), "bronze.images", fmt)
    restaurant, user, review = (spark.table(f"bronze.{t}") for t in ("restaurant", "user", "review"))
    write_table(restaurant_transform(restaurant), "bronze.restaurant_transform", fmt)
    write_table(user_account(user), "bronze.user_account", fmt)
    write_table(review_features(review), "feature_store.review", fmt)

    for name, sql in view_sql("bronze.restaurant", "bronze.user", "bronze.review").items():
        publish_view(spark, sql, f"silver.{name}")
    publish_table(dim_date(spark), "silver.dim_date", fmt)
    publish_view(spark, gold_sql("silver.fact_review", "silver.dim_restaurant", "silver.dim_user"), "gold.analyses_review")

    out = {"analyses_review": spark.table("gold.analyses_review"), "checks": check_keys(spark, written),
           "rows": {f"bronze.{BRONZE[dataset]}": seen["rows"] for dataset, seen in written.items()}}
    if train:
        # one numbering: the ids published above
        ratings = encode_ratings(spark.table("feature_store.review"), user_ids=spark.table("bronze.user_account"),
                                 item_ids=spark.table("bronze.restaurant_transform"))
        model, metrics = M.train_and_evaluate(ratings)
        if model_path:
            M.save_model(model, model_path)
            metrics["model_path"] = model_path
        run_id = datetime.now(timezone.utc).strftime("als-%Y%m%dT%H%M%S%f")
        R.log_metrics(R.metrics_rows(spark, run_id, "spark_als_model", metrics), metrics_table)
        out.update(model=model, metrics=spark.table(metrics_table))
    return out


def run_second_training(spark: SparkSession, ratings, metrics_table: str = "feature_store.metrics", seed: int = 42):
    """The second training flow: 80/20 random split, the alternative configuration as a
    one-stage pipeline, errors on both sides, logged."""
    train, test = (cut_lineage(p) for p in random_split(ratings, (0.8, 0.2), seed))
    model = M.train_als_pipeline(train, seed=seed)
    metrics: dict = {**{k: v for k, v in M.ALT_CONFIG.items() if k in ("rank", "max_iter", "reg")},
                     "training_nrows": train.count(), "test_nrows": test.count()}
    for side, df in (("test", test), ("train", train)):
        row = M.error_metrics(M.predict(model, df)).first()
        metrics[f"{side}_rmse"], metrics[f"{side}_mse"] = row["rmse"], row["mse"]
    run_id = datetime.now(timezone.utc).strftime("als-pipeline-%Y%m%dT%H%M%S%f")
    R.log_metrics(R.metrics_rows(spark, run_id, "als_pipeline", metrics), metrics_table)
    return model, metrics
