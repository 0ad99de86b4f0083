"""Run metrics table and run selection.

A metrics table of rows ``(run_id, run_name, run_ts, metric, value, text)`` replaces the
experiment server (numbers in ``value``, text parameters such as a model path in ``text``): runs append to it, look-ups are filters and orderings over it.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRICS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("run_name", T.StringType(), True),
    T.StructField("run_ts", T.TimestampType(), True),
    T.StructField("metric", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("text", T.StringType(), True),
])


def metrics_rows(spark: SparkSession, run_id: str, run_name: str, metrics: Mapping[str, float | str],
                 run_ts: datetime | None = None) -> DataFrame:
    """The rows one run logs (a handful of scalars per run)."""
    ts = run_ts or datetime.now(timezone.utc).replace(tzinfo=None)
    rows = [(run_id, run_name, ts, k, None, v) if isinstance(v, str) else (run_id, run_name, ts, k, float(v), None)
            for k, v in metrics.items()]
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def metrics_from_frame(df: DataFrame, run_name_col: str = "run_name", ts: datetime | None = None) -> DataFrame:
    """Turn a wide metrics result (one row per run, one column per metric) into long rows."""
    metric_cols = [c for c, t in df.dtypes if c != run_name_col and t in ("double", "bigint", "int", "float")]
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                                  for c in metric_cols])).alias("_m")
    run_ts = F.lit(ts).cast("timestamp") if ts else F.current_timestamp()
    return df.select(F.col(run_name_col).alias("run_id"), F.col(run_name_col).alias("run_name"),
                     run_ts.alias("run_ts"), stacked).select("run_id", "run_name", "run_ts", "_m.metric", "_m.value",
                                                             F.lit(None).cast("string").alias("text"))


def log_metrics(metrics: DataFrame, table: str) -> None:
    """Append to the metrics table (created on first use)."""
    metrics.write.mode("append").saveAsTable(table)


def find_run(metrics: DataFrame, run_name: str) -> DataFrame:
    """The rows of runs with this name, latest run first."""
    return metrics.where(F.col("run_name") == F.lit(run_name)).orderBy(F.col("run_ts").desc(), "run_id", "metric")


def best_run(metrics: DataFrame, metric: str = "rmse", run_name: str | None = None) -> DataFrame:
    """The run with the lowest value of ``metric`` (ties by run id); optionally only
    among runs of one name (the reference accepts the name but ignores it)."""
    rows = metrics.where(F.col("metric") == F.lit(metric))
    if run_name is not None:
        rows = rows.where(F.col("run_name") == F.lit(run_name))
    return rows.orderBy(F.col("value").asc_nulls_last(), F.col("run_id")).limit(1)
