"""Analog views: the raw review-data shapes computed from the driver's tables.

Each view exists twice, as a DataFrame function and as SQL text that DuckDB runs for the
oracle; both must give the same rows. Keys are zero-padded to a fixed width so that text
order equals number order (width 12 holds every key up to a very large scale factor).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY_WIDTH = 12
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# user metric columns of the analog: (column, modulus of c_custkey)
USER_COUNTERS = [
    ("useful", 7), ("funny", 5), ("cool", 6), ("fans", 13),
    ("compliment_hot", 3), ("compliment_more", 4), ("compliment_profile", 5),
    ("compliment_cute", 6), ("compliment_list", 7), ("compliment_note", 8),
    ("compliment_plain", 9), ("compliment_cool", 10), ("compliment_funny", 11),
    ("compliment_writer", 12), ("compliment_photos", 14),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fact_table(spark: SparkSession, sf_dir: str, name: str, cols: list[str]) -> DataFrame:
    """A large table, pruned to ``cols``."""
    return table(spark, sf_dir, name).select(*cols)


def padded(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), KEY_WIDTH, "0"))


def an_restaurant(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    # another opening time each day; every seventh restaurant is closed on a day
    hours = F.struct(*[F.when(k % 7 != i, F.concat((k % (i + 5)).cast("string"), F.lit(f":0-{15 + i}:30"))).alias(d)
                       for i, d in enumerate(WEEKDAYS)])
    return p.select(
        padded("b", k).alias("business_id"),
        F.col("p_name").alias("name"),
        F.concat(F.col("p_type"), F.lit(", "), F.col("p_brand")).alias("categories"),
        F.col("p_brand").alias("city"),
        F.col("p_type").alias("state"),
        F.concat(F.col("p_size").cast("string"), F.lit(" "), F.col("p_name")).alias("address"),
        F.lpad((k % 100000).cast("string"), 5, "0").alias("postal_code"),
        (k % 180 - 90).cast("double").alias("latitude"),
        (k % 360 - 180).cast("double").alias("longitude"),
        (F.lit(1.0) + (k % 9).cast("double") / 2).alias("stars"),
        (F.col("p_size").cast("bigint") * 10 + k % 7).alias("review_count"),
        F.when(k % 20 < 3, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("is_open"),
        hours.alias("hours"),
    )


def an_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        padded("u", k).alias("user_id"),
        F.col("c_name").alias("name"),
        (k % 201).cast("bigint").alias("review_count"),
        F.lit("2010-01-01 00:00:00").alias("yelping_since"),
        *[(k % m).cast("bigint").alias(n) for n, m in USER_COUNTERS],
        F.lit("").alias("elite"),
        F.lit("").alias("friends"),
        ((k % 401 + 100).cast("double") / 100).alias("average_stars"),
    )


LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_returnflag", "l_linestatus", "l_shipdate"]


def _review_columns(user_key: Column) -> list[Column]:
    return [
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"),
                    F.col("l_suppkey")).alias("review_id"),
        padded("u", user_key).alias("user_id"),
        padded("b", F.col("l_partkey")).alias("business_id"),
        (F.floor((F.col("l_quantity") - 1) / 10).cast("bigint") + 1).alias("stars"),
        F.col("l_linenumber").cast("bigint").alias("useful"),
        (F.col("l_partkey") % 11).cast("bigint").alias("funny"),
        (F.col("l_suppkey") % 16).cast("bigint").alias("cool"),
        F.concat(F.col("l_returnflag"), F.lit(" "), F.col("l_linestatus")).alias("text"),
        F.date_format(F.col("l_shipdate"), "yyyy-MM-dd HH:mm:ss").alias("date"),
    ]


def an_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews: one per line item; the reviewer is the order's customer."""
    li = fact_table(spark, sf_dir, "lineitem", LINEITEM_COLUMNS)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(*_review_columns(F.col("o_custkey")))


def an_review_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews where each order acts as one reviewer (no join needed). Orders ship over a
    short span, so the latest rows hold reviewers never seen before: this is the analog
    on which the new-user swap of the time split has work to do."""
    li = fact_table(spark, sf_dir, "lineitem", LINEITEM_COLUMNS)
    return li.select(*_review_columns(F.col("l_orderkey")))


def an_photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        padded("b", F.col("user_id")).alias("business_id"),
        F.col("event_id").cast("string").alias("photo_id"),
        F.col("event_type").alias("caption"),
        F.col("event_type").alias("label"),
    )


def an_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text corpus for TF-IDF at scale: documents as items (doc_id, source as name, text)."""
    d = fact_table(spark, sf_dir, "documents", ["doc_id", "source", "text"])
    return d.select(F.col("doc_id").alias("business_id"), F.col("source").alias("name"),
                    F.col("text").alias("categories"))


# ---- the same views as DuckDB SQL (oracle side) -------------------------------------

def _sql_pad(prefix: str, expr: str) -> str:
    return f"('{prefix}' || lpad(CAST({expr} AS VARCHAR), {KEY_WIDTH}, '0'))"


def _sql_review(user_expr: str, source: str) -> str:
    return f"""SELECT
  CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS review_id,
  {_sql_pad('u', user_expr)} AS user_id,
  {_sql_pad('b', 'l_partkey')} AS business_id,
  CAST(floor((l_quantity - 1) / 10) AS BIGINT) + 1 AS stars,
  CAST(l_linenumber AS BIGINT) AS useful,
  CAST(l_partkey % 11 AS BIGINT) AS funny,
  CAST(l_suppkey % 16 AS BIGINT) AS cool,
  l_returnflag || ' ' || l_linestatus AS text,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS date
FROM {source}"""


SQL_VIEWS = {
    "an_restaurant": f"""SELECT
  {_sql_pad('b', 'p_partkey')} AS business_id,
  p_name AS name,
  p_type || ', ' || p_brand AS categories,
  p_brand AS city,
  p_type AS state,
  CAST(p_size AS VARCHAR) || ' ' || p_name AS address,
  lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0') AS postal_code,
  CAST(p_partkey % 180 - 90 AS DOUBLE) AS latitude,
  CAST(p_partkey % 360 - 180 AS DOUBLE) AS longitude,
  1.0 + CAST(p_partkey % 9 AS DOUBLE) / 2 AS stars,
  CAST(p_size AS BIGINT) * 10 + p_partkey % 7 AS review_count,
  CAST(CASE WHEN p_partkey % 20 < 3 THEN 0 ELSE 1 END AS BIGINT) AS is_open,
  CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_partkey % 5 AS VARCHAR) || ':0-15:30' END AS hours_monday,
  CASE WHEN p_partkey % 7 <> 1 THEN CAST(p_partkey % 6 AS VARCHAR) || ':0-16:30' END AS hours_tuesday,
  CASE WHEN p_partkey % 7 <> 2 THEN CAST(p_partkey % 7 AS VARCHAR) || ':0-17:30' END AS hours_wednesday,
  CASE WHEN p_partkey % 7 <> 3 THEN CAST(p_partkey % 8 AS VARCHAR) || ':0-18:30' END AS hours_thursday,
  CASE WHEN p_partkey % 7 <> 4 THEN CAST(p_partkey % 9 AS VARCHAR) || ':0-19:30' END AS hours_friday,
  CASE WHEN p_partkey % 7 <> 5 THEN CAST(p_partkey % 10 AS VARCHAR) || ':0-20:30' END AS hours_saturday,
  CASE WHEN p_partkey % 7 <> 6 THEN CAST(p_partkey % 11 AS VARCHAR) || ':0-21:30' END AS hours_sunday
FROM part""",
    "an_user": "SELECT\n  " + ",\n  ".join(
        [f"{_sql_pad('u', 'c_custkey')} AS user_id", "c_name AS name",
         "CAST(c_custkey % 201 AS BIGINT) AS review_count",
         "'2010-01-01 00:00:00' AS yelping_since"]
        + [f"CAST(c_custkey % {m} AS BIGINT) AS {n}" for n, m in USER_COUNTERS]
        + ["'' AS elite", "'' AS friends",
           "CAST(c_custkey % 401 + 100 AS DOUBLE) / 100 AS average_stars"]) + "\nFROM customer",
    "an_review": _sql_review("o_custkey", "lineitem JOIN orders ON l_orderkey = o_orderkey"),
    "an_review_by_order": _sql_review("l_orderkey", "lineitem"),
    "an_photos": f"""SELECT {_sql_pad('b', 'user_id')} AS business_id, CAST(event_id AS VARCHAR) AS photo_id,
  event_type AS caption, event_type AS label FROM events""",
    "an_corpus": "SELECT doc_id AS business_id, source AS name, text AS categories FROM documents",
}
