"""Catalog reads and writes (S3-S9, S16): tables, namespaces, views.

Writes are full refreshes, as every write of the reference is, and replace a table in one step:
each write makes a new versioned table beside the old one, and when its data are complete a
single catalog statement points the name (a view) at it. Until then, and if the write fails,
readers see the old rows; a query that began on the old version can end on it, since the
version before the present one is kept. So a frame may also read the table that it replaces.
The table format is a parameter (parquet by default).
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Names of versioned tables: time of the write, and a tag against writers of the same moment.
VERSION = r"__v[0-9]{20}_[0-9a-f]{8}"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S3."""
    return spark.table(name)


def versions(spark: SparkSession, name: str) -> list[str]:
    """The stored versions of a table, oldest first, named like ``name``."""
    ns, _, short = name.rpartition(".")
    found = spark.catalog.listTables(ns or None, f"{short}__v*")
    return [f"{ns}.{t}" if ns else t for t in sorted(t.name for t in found) if re.fullmatch(re.escape(short) + VERSION, t, re.I)]


def write_table(df: DataFrame, name: str, fmt: str = "parquet", partition_by=None,
                observe: Mapping[str, Column] | None = None) -> dict:
    """Create or replace a table with the frame's (possibly new) schema, at once.

    ``observe`` names aggregates (counts, nulls, sums) that are taken while the rows are
    written, without a scan of their own; their values are returned. Each row is written, and
    so counted, once: a retried task reports only its successful attempt.
    """
    spark = df.sparkSession
    seen = Observation(f"write-{uuid.uuid4().hex}") if observe else None
    if seen:
        df = df.observe(seen, *[agg.alias(label) for label, agg in observe.items()])
    before = versions(spark, name)
    version = f"{name}__v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    w = df.write.format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    try:
        w.saveAsTable(version)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        # a plain table of an earlier release becomes the first version
        old = f"{name}__v{0:020d}_{uuid.uuid4().hex[:8]}"
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
        before = [old]
    publish_view(spark, f"SELECT * FROM {version}", name)
    for old in before[:-1]:  # the last one may still be read
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return dict(seen.get) if seen else {}


def ensure_namespace(spark: SparkSession, ns: str) -> None:
    """S5."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {ns}")


def list_namespaces(spark: SparkSession) -> DataFrame:
    """S6."""
    return spark.sql("SHOW NAMESPACES")


def list_tables(spark: SparkSession, ns: str) -> DataFrame:
    """Tables and views by their names, without the stored versions behind them and without
    session views, which are in no namespace but are shown in every one."""
    return spark.sql(f"SHOW TABLES IN {ns}").where(~F.col("isTemporary") & ~F.col("tableName").rlike(VERSION + "$"))


def publish_view(spark: SparkSession, source: DataFrame | str, name: str) -> None:
    """Create or replace a view. SQL text over catalog tables becomes a catalog view;
    a DataFrame becomes a session view named with ``_`` for ``.`` (``silver.dim_user`` ->
    ``silver_dim_user``, since session views have no namespace); its plan is inlined into
    every query reading it, so filters on the view still reach the scans."""
    if isinstance(source, str):
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {source}")
    else:
        source.createOrReplaceTempView(name.replace(".", "_"))


def publish_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Materialise a model as a table (CTAS)."""
    write_table(df, name, fmt)


def query(spark: SparkSession, sql: str, args: dict | None = None) -> DataFrame:
    """Ad-hoc SQL over the published tables and views, with named parameters."""
    return spark.sql(sql, args=args) if args else spark.sql(sql)
