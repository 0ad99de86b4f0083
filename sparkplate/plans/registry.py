"""Registered queries over the driver tables, each with its DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame``; it reads whole tables (through the analog
views) so its work grows with them. ``ORACLE`` holds the SQL twin where SQL can express
the operator; queries without one (ALS, random split) get a rows-only check.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkplate.operators import dashboards as A
from sparkplate.operators.gold import analyses_review
from sparkplate.operators.silver import dim_date, dim_restaurant, dim_user, fact_review, review_features
from sparkplate.plans.sqlviews import month_sql, register, round_sql, with_views
from sparkplate.sources import analogs
from sparkplate.functions.numeric import round_half_up
from sparkplate.functions.text import ENGLISH_STOP_WORDS, TOKEN_PATTERN, text_features
from sparkplate.operators import als as M
from sparkplate.operators import bucketed as B
from sparkplate.operators import content as C
from sparkplate.operators import ids as I
from sparkplate.operators import lookup as L
from sparkplate.operators import quality as Q
from sparkplate.operators import rollup as RU
from sparkplate.operators import runs as R
from sparkplate.operators import scoring as S
from sparkplate.operators import split as SP
from sparkplate.operators import topitems as T
from sparkplate.session import cut_lineage
from sparkplate.sources.catalog import ensure_namespace, publish_view, query as sql_query, read_table, write_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _fresh(name: str) -> str:
    return f"sparkplate_check.{name}_{uuid.uuid4().hex}"


def flat_hours(df: DataFrame) -> DataFrame:
    """Replace the ``hours`` struct by one column per day for engine-neutral comparison."""
    cols = []
    for c in df.columns:
        if c == "hours":
            cols += [F.col(f"hours.{d}").alias(f"hours_{d.lower()}") for d in analogs.WEEKDAYS]
        else:
            cols.append(F.col(c))
    return df.select(*cols)


# ---- shared inputs -------------------------------------------------------------------

def dr(spark, d):
    return dim_restaurant(analogs.an_restaurant(spark, d))


def du(spark, d):
    return dim_user(analogs.an_user(spark, d))


def fr(spark, d):
    return fact_review(analogs.an_review(spark, d))


def ar(spark, d):
    return analyses_review(fr(spark, d), dr(spark, d), du(spark, d))


INPUTS = {"dr": dr, "du": du, "fr": fr, "ar": ar}
VIEW_OF = {"dr": "dim_restaurant", "du": "dim_user", "fr": "fact_review", "ar": "analyses_review"}


# ---- silver / gold (P1-P4, J4, M2, S10) ----------------------------------------------

query("dim_user", with_views("SELECT * FROM dim_user", "dim_user"))(lambda s, d: du(s, d))
query("dim_restaurant", with_views("SELECT * FROM dim_restaurant", "dim_restaurant"))(
    lambda s, d: flat_hours(dr(s, d)))
query("fact_review", with_views("SELECT * FROM fact_review", "fact_review"))(lambda s, d: fr(s, d))
query("review_features", with_views("SELECT business_id, user_id, stars, date FROM an_review", "an_review"))(
    lambda s, d: review_features(analogs.an_review(s, d)))
query("analyses_review", with_views("SELECT * FROM analyses_review", "analyses_review"))(
    lambda s, d: flat_hours(ar(s, d)))

DIM_DATE_SQL = """SELECT
  CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT) AS dateInt,
  d AS CalendarDate,
  CAST(year(d) AS BIGINT) AS CalendarYear,
  strftime(d, '%B') AS CalendarMonth,
  CAST(month(d) AS BIGINT) AS MonthOfYear,
  strftime(d, '%A') AS CalendarDay,
  CAST(isodow(d) AS BIGINT) AS DayOfWeek,
  CAST(isodow(d) AS BIGINT) AS DayOfWeekStartMonday,
  CASE WHEN isodow(d) < 6 THEN 'Y' ELSE 'N' END AS IsWeekDay,
  CAST(day(d) AS BIGINT) AS DayOfMonth,
  CASE WHEN d = last_day(d) THEN 'Y' ELSE 'N' END AS IsLastDayOfMonth,
  CAST(dayofyear(d) AS BIGINT) AS DayOfYear,
  CAST(week(d) AS BIGINT) AS WeekOfYearIso,
  CAST(quarter(d) AS BIGINT) AS QuarterOfYear,
  CAST(CASE WHEN month(d) >= 10 THEN year(d) + 1 ELSE year(d) END AS BIGINT) AS FiscalYearOctToSep,
  CAST((month(d) + 2) % 12 + 1 AS BIGINT) AS FiscalMonthOctToSep,
  CAST(CASE WHEN month(d) >= 7 THEN year(d) + 1 ELSE year(d) END AS BIGINT) AS FiscalYearJulToJun,
  CAST((month(d) + 5) % 12 + 1 AS BIGINT) AS FiscalMonthJulToJun
FROM (SELECT CAST(unnest(generate_series(CAST(b AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
      FROM ({span}) span)"""


def dim_date_reviews(s, d):
    """M2 over the span of the review dates (ship dates of the line items)."""
    li = analogs.table(s, d, "lineitem")
    span = li.agg(F.min(F.to_date("l_shipdate")).alias("b"), F.max(F.to_date("l_shipdate")).alias("e")).first()
    return dim_date(s, str(span["b"]), str(span["e"]))


def dim_date_orders(s, d):
    """M2 over the whole order-to-delivery span: first order date to last ship date."""
    b = analogs.table(s, d, "orders").agg(F.min(F.to_date("o_orderdate"))).first()[0]
    e = analogs.table(s, d, "lineitem").agg(F.max(F.to_date("l_shipdate"))).first()[0]
    return dim_date(s, str(b), str(e))


query("dim_date", DIM_DATE_SQL.format(
    span="SELECT CAST(min(l_shipdate) AS DATE) AS b, CAST(max(l_shipdate) AS DATE) AS e FROM lineitem"))(
    dim_date_reviews)
query("dim_date_wide", DIM_DATE_SQL.format(
    span="SELECT (SELECT CAST(min(o_orderdate) AS DATE) FROM orders) AS b, "
         "(SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem) AS e"))(dim_date_orders)


# ---- dashboards A1-A26 ---------------------------------------------------------------

#: Gold columns a chart reads. Both dimension keys are unique (check_unique_user_id and
#: check_unique_restaurant_id are empty), so a dimension that a chart does not read is not joined.
CHART_COLUMNS = {
    "a07_reviews_over_time": ["review_date"], "a08_avg_stars_over_time": ["review_date", "stars"],
    "a09_total_funny": ["funny"], "a10_total_cool": ["cool"], "a11_total_useful": ["useful"],
    "a12_review_stars_distribution": ["stars"], "a15_avg_rating_by_city": ["city", "restaurant_stars"],
    "a16_city_metrics": ["city", "state", "restaurant_id", "restaurant_stars"],
    "a24_top_cities_by_restaurants": ["city", "restaurant_id"], "a25_reviews_trend": ["review_date"],
    "a26_top_categories": ["categories"],
}


def chart_gold(spark, d, columns):
    return analyses_review(fr(spark, d), dr(spark, d), du(spark, d), needed=columns, unique_dims=True)


def _chart(name: str, fn, key: str, sql: str) -> None:
    if key == "ar":
        query(name, with_views(sql, VIEW_OF[key]))(
            lambda s, d, fn=fn, name=name: fn(chart_gold(s, d, CHART_COLUMNS[name])))
    else:
        query(name, with_views(sql, VIEW_OF[key]))(lambda s, d, fn=fn, key=key: fn(INPUTS[key](s, d)))


def _topk(group: str, metric_sql: str, alias: str, table: str, k: int | None, ordered: bool = True) -> str:
    sql = f"SELECT {group}, {metric_sql} AS {alias} FROM {table} GROUP BY {group}"
    if k:
        order = ", ".join([f"{alias} DESC NULLS LAST"] + [f"{g.strip()} ASC NULLS LAST" for g in group.split(",")])
        sql += f" ORDER BY {order} LIMIT {k}"
    return sql


CHART_SQL = {
    "a01_total_restaurants": "SELECT count(DISTINCT restaurant_id) AS total_restaurants FROM dim_restaurant",
    "a02_avg_restaurant_rating": f"SELECT {round_sql('avg(stars)', 2)} AS avg_rating FROM dim_restaurant",
    "a03_total_reviews": "SELECT count(*) AS total_reviews FROM fact_review",
    "a04_star_distribution": _topk("stars", "count(*)", "count", "dim_restaurant", None),
    "a05_top_restaurants_by_reviews": _topk("restaurant_name", "max(review_count)", "review_count",
                                            "dim_restaurant", 20),
    "a06_open_vs_closed": """SELECT is_open, count, CAST(count AS DOUBLE) * 100 / CAST(sum(count) OVER () AS DOUBLE) AS pct
FROM (SELECT is_open, count(*) AS count FROM dim_restaurant GROUP BY is_open)""",
    "a07_reviews_over_time": f"SELECT {month_sql('review_date')} AS month, count(*) AS reviews FROM analyses_review GROUP BY 1",
    "a08_avg_stars_over_time": f"SELECT {month_sql('review_date')} AS month, {round_sql('avg(stars)', 2)} AS avg_stars FROM analyses_review GROUP BY 1",
    "a09_total_funny": "SELECT CAST(sum(funny) AS BIGINT) AS total_funny FROM analyses_review",
    "a10_total_cool": "SELECT CAST(sum(cool) AS BIGINT) AS total_cool FROM analyses_review",
    "a11_total_useful": "SELECT CAST(sum(useful) AS BIGINT) AS total_useful FROM analyses_review",
    "a12_review_stars_distribution": _topk("stars", "count(*)", "count", "analyses_review", None),
    "a13_top_cities": _topk("city", "count(*)", "count", "dim_restaurant", 15),
    "a14_restaurants_by_state": _topk("state", "count(*)", "count", "dim_restaurant", None),
    "a15_avg_rating_by_city": _topk("city", round_sql("avg(restaurant_stars)", 2), "avg_rating",
                                    "analyses_review", 15),
    "a16_city_metrics": f"""SELECT city, state, count(DISTINCT restaurant_id) AS restaurants, count(*) AS reviews,
  {round_sql('avg(restaurant_stars)', 2)} AS avg_rating
FROM analyses_review GROUP BY city, state
ORDER BY reviews DESC NULLS LAST, city ASC NULLS LAST, state ASC NULLS LAST LIMIT 50""",
    "a17_total_users": "SELECT count(*) AS total_users FROM dim_user",
    "a18_avg_reviews_per_user": f"SELECT {round_sql('avg(review_count)', 1)} AS avg_reviews FROM dim_user",
    "a19_top_reviewers": _topk("user_name", "max(review_count)", "reviews", "dim_user", 20),
    "a20_user_rating_distribution": _topk("average_stars", "count(*)", "users", "dim_user", None),
    "a24_top_cities_by_restaurants": _topk("city", "count(DISTINCT restaurant_id)", "restaurants",
                                           "analyses_review", 5),
    "a26_top_categories": _topk("categories", "count(*)", "count", "analyses_review", 10),
}
CHART_SQL["a21_kpi_restaurants"] = CHART_SQL["a01_total_restaurants"]
CHART_SQL["a22_kpi_reviews"] = CHART_SQL["a03_total_reviews"]
CHART_SQL["a23_kpi_users"] = CHART_SQL["a17_total_users"]
CHART_SQL["a25_reviews_trend"] = CHART_SQL["a07_reviews_over_time"]

for _name, (_fn, _key) in A.CHARTS.items():
    _chart(_name, _fn, _key, CHART_SQL[_name])


@query("city_metrics_filtered", with_views(
    f"""SELECT city, state, count(DISTINCT restaurant_id) AS restaurants, count(*) AS reviews,
  {round_sql('avg(restaurant_stars)', 2)} AS avg_rating
FROM analyses_review WHERE stars IN (4, 5) GROUP BY city, state
ORDER BY reviews DESC NULLS LAST, city ASC NULLS LAST, state ASC NULLS LAST LIMIT 50""", "analyses_review"))
def city_metrics_filtered(spark, d):
    """P17 then A16: a dashboard filter on review stars reaches the fact scan."""
    gold = chart_gold(spark, d, ["city", "state", "restaurant_id", "restaurant_stars"])
    return A.a16_city_metrics(A.apply_filters(gold, {"stars": [4, 5]}))


# the star join over bucketed tables, and a chart on it

def bucketed_gold(spark, d):
    ensure_namespace(spark, "sparkplate_check")
    names = _fresh("fact"), _fresh("dim")
    B.store_star(fr(spark, d), dr(spark, d), *names, buckets=16)
    return B.bucketed_gold(spark, *names)


query("gold_bucketed", with_views("SELECT * EXCLUDE (user_name) FROM analyses_review", "analyses_review"))(
    lambda s, d: flat_hours(bucketed_gold(s, d)))
query("gold_bucketed_city_metrics", with_views(CHART_SQL["a16_city_metrics"], "analyses_review"))(
    lambda s, d: A.a16_city_metrics(bucketed_gold(s, d)))

# the same charts from a rollup that scans the fact once

def rollup(spark, d):
    return RU.build_rollup(fr(spark, d), dr(spark, d))


for _name in RU.CHARTS:
    query(f"rollup_{_name}", with_views(CHART_SQL[_name], "analyses_review"))(
        lambda s, d, name=_name: RU.chart(rollup(s, d), name))
query("rollup_city_metrics_filtered", ORACLE["city_metrics_filtered"])(
    lambda s, d: RU.chart(rollup(s, d), "a16_city_metrics", {"stars": [4, 5]}))


# ---- data quality (D1-D3, A32, A33, U3) ----------------------------------------------


query("check_unique_order_line", """SELECT key, count(*) AS n FROM (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS key FROM lineitem)
WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1""")(
    lambda s, d: Q.check_unique(analogs.table(s, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key")), "key"))
query("check_unique_user_id", with_views(
    "SELECT user_id, count(*) AS n FROM dim_user WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1",
    "dim_user"))(lambda s, d: Q.check_unique(du(s, d), "user_id"))
query("check_unique_restaurant_id", with_views(
    "SELECT restaurant_id, count(*) AS n FROM dim_restaurant WHERE restaurant_id IS NOT NULL "
    "GROUP BY restaurant_id HAVING count(*) > 1", "dim_restaurant"))(
    lambda s, d: Q.check_unique(dr(s, d), "restaurant_id"))
query("check_not_null_user_id", with_views("SELECT * FROM dim_user WHERE user_id IS NULL", "dim_user"))(
    lambda s, d: Q.check_not_null(du(s, d), "user_id"))
query("check_not_null_restaurant_id", with_views(
    "SELECT * FROM dim_restaurant WHERE restaurant_id IS NULL", "dim_restaurant"))(
    lambda s, d: flat_hours(Q.check_not_null(dr(s, d), "restaurant_id")))
query("check_not_null_user_name", with_views(
    "SELECT * FROM analyses_review WHERE user_name IS NULL", "analyses_review"))(
    lambda s, d: flat_hours(Q.check_not_null(ar(s, d), "user_name")))

# documents without a label give null keys and unmatched rows in the driver's own data
DOC_LABELS_SQL = "SELECT doc_id, source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)"


def doc_labels(s, d):
    docs = analogs.table(s, d, "documents").select("doc_id", "source")
    labels = analogs.table(s, d, "labels").select("doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id", "left").select("doc_id", "source", "quality", "toxic")


query("check_not_null_quality", f"SELECT * FROM ({DOC_LABELS_SQL}) WHERE quality IS NULL")(
    lambda s, d: Q.check_not_null(doc_labels(s, d), "quality"))
query("check_unique_source", "SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL "
      "GROUP BY source HAVING count(*) > 1")(
    lambda s, d: Q.check_unique(analogs.table(s, d, "documents"), "source"))


def doc_gold(s, d):
    """J4 with unmatched facts: documents as facts; labels as users and (where not toxic) as restaurants."""
    docs, labels = analogs.table(s, d, "documents"), analogs.table(s, d, "labels")
    key = F.col("doc_id").cast("string")
    fact = docs.select(key.alias("review_id"), key.alias("restaurant_id"), key.alias("user_id"),
                       F.col("n_chars").alias("stars"), F.col("source").alias("review_description"))
    rest = labels.where("toxic = 0").select(key.alias("restaurant_id"), F.concat(F.lit("r"), key).alias("restaurant_name"),
                                            F.col("quality").cast("double").alias("stars"))
    return analyses_review(fact, rest, labels.select(key.alias("user_id"), F.concat(F.lit("u"), F.col("quality").cast("string")).alias("user_name")))


DOC_GOLD_SQL = """SELECT f.*, r.restaurant_name, r.stars AS restaurant_stars, u.user_name
FROM (SELECT CAST(doc_id AS VARCHAR) AS review_id, CAST(doc_id AS VARCHAR) AS restaurant_id,
             CAST(doc_id AS VARCHAR) AS user_id, n_chars AS stars, source AS review_description FROM documents) f
LEFT JOIN (SELECT CAST(doc_id AS VARCHAR) AS k, 'r' || doc_id AS restaurant_name, CAST(quality AS DOUBLE) AS stars
           FROM labels WHERE toxic = 0) r ON f.restaurant_id = r.k
LEFT JOIN (SELECT CAST(doc_id AS VARCHAR) AS k, 'u' || quality AS user_name FROM labels) u ON f.user_id = u.k"""
query("gold_unmatched", DOC_GOLD_SQL)(doc_gold)
query("check_not_null_gold", f"SELECT * FROM ({DOC_GOLD_SQL}) WHERE user_name IS NULL")(
    lambda s, d: Q.check_not_null(doc_gold(s, d), "user_name"))

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
                 "pages benchmark labels conversations").split()
query("table_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in DRIVER_TABLES))(
    lambda s, d: Q.table_counts({t: analogs.table(s, d, t) for t in DRIVER_TABLES}))
query("review_row_count", with_views("SELECT count(*) AS row_count FROM fact_review", "fact_review"))(
    lambda s, d: Q.row_count(fr(s, d)))


# ---- ids and transforms (M1, J1-J3, P5, A27) -------------------------------------------


register("restaurant_transform", """SELECT r.*, i.businessid FROM an_restaurant r JOIN (
  SELECT business_id, CAST(row_number() OVER (ORDER BY business_id ASC NULLS FIRST) AS INTEGER) AS businessid
  FROM (SELECT DISTINCT business_id FROM an_restaurant)) i USING (business_id)""", ["an_restaurant"])
register("user_account", """SELECT u.user_id, u.name, u.friends, i.userid,
  lower(replace(u.name, ' ', '')) AS account_name
FROM an_user u JOIN (
  SELECT user_id, CAST(row_number() OVER (ORDER BY user_id ASC NULLS FIRST) AS INTEGER) AS userid
  FROM (SELECT DISTINCT user_id FROM an_user)) i USING (user_id)""", ["an_user"])
register("encoded_ratings", """SELECT r.business_id, r.user_id, r.stars, r.date, u.userid, b.businessid
FROM (SELECT business_id, user_id, stars, date FROM an_review) r
JOIN (SELECT user_id, CAST(row_number() OVER (ORDER BY user_id ASC NULLS FIRST) AS INTEGER) AS userid
      FROM (SELECT DISTINCT user_id FROM an_review)) u USING (user_id)
JOIN (SELECT business_id, CAST(row_number() OVER (ORDER BY business_id ASC NULLS FIRST) AS INTEGER) AS businessid
      FROM (SELECT DISTINCT business_id FROM an_review)) b USING (business_id)""", ["an_review"])


def restaurant_tf(s, d):
    return I.restaurant_transform(analogs.an_restaurant(s, d))


def ratings(s, d):
    """Numbered over the reviewed keys only, as the reference's training script does."""
    return I.encode_ratings(review_features(analogs.an_review(s, d)), own_keys=True)


register("shared_ratings", """SELECT r.business_id, r.user_id, r.stars, r.date, u.userid, b.businessid
FROM (SELECT business_id, user_id, stars, date FROM an_review) r
JOIN user_account u USING (user_id) JOIN restaurant_transform b USING (business_id)""",
         ["an_review", "user_account", "restaurant_transform"])


def shared_ratings(s, d):
    """Numbered by the dimensions: training, look-up and enrichment share the ids."""
    return I.encode_ratings(review_features(analogs.an_review(s, d)),
                            user_ids=I.user_account(analogs.an_user(s, d)), item_ids=restaurant_tf(s, d))


query("encode_ratings_shared", with_views("SELECT * FROM shared_ratings", "shared_ratings"))(shared_ratings)


def label_ratings(s, d):
    """Ids with gaps: all documents are items, their labels the ratings, sources the users."""
    docs = analogs.table(s, d, "documents").select(F.col("doc_id").alias("business_id"), F.col("source").alias("user_id"))
    rated = (analogs.table(s, d, "labels").join(docs, F.col("doc_id") == F.col("business_id"))
             .select("business_id", "user_id", F.col("quality").alias("stars"), F.lit("2024-01-01").alias("date")))
    return I.encode_ratings(rated, user_ids=I.encode_ids(docs, "user_id", "userid"),
                            item_ids=I.encode_ids(docs, "business_id", "businessid"))


query("encode_ratings_gaps", """SELECT d.doc_id AS business_id, d.source AS user_id, l.quality AS stars, '2024-01-01' AS date,
  u.userid, i.businessid
FROM labels l JOIN documents d USING (doc_id)
JOIN (SELECT source, CAST(row_number() OVER (ORDER BY source) AS INTEGER) AS userid FROM (SELECT DISTINCT source FROM documents)) u
  ON u.source = d.source
JOIN (SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) AS INTEGER) AS businessid FROM (SELECT DISTINCT doc_id FROM documents)) i
  ON i.doc_id = d.doc_id""")(label_ratings)


query("restaurant_transform", with_views("SELECT * FROM restaurant_transform", "restaurant_transform"))(
    lambda s, d: flat_hours(restaurant_tf(s, d)))
query("user_account", with_views("SELECT * FROM user_account", "user_account"))(
    lambda s, d: I.user_account(analogs.an_user(s, d)))
query("encode_ratings", with_views("SELECT * FROM encoded_ratings", "encoded_ratings"))(ratings)
query("encode_ids_user", with_views(
    "SELECT user_id, CAST(row_number() OVER (ORDER BY user_id ASC NULLS FIRST) AS INTEGER) AS userid "
    "FROM (SELECT DISTINCT user_id FROM an_review)", "an_review"))(
    lambda s, d: I.encode_ids(analogs.an_review(s, d), "user_id", "userid"))


@query("ids_after_two_loads", """WITH first AS (
  SELECT p_name, CAST(row_number() OVER (ORDER BY p_name) AS INTEGER) AS id
  FROM (SELECT DISTINCT p_name FROM part WHERE p_size < 20)),
rest AS (SELECT p_name, CAST(row_number() OVER (ORDER BY p_name) + (SELECT count(*) FROM first) AS INTEGER) AS id
  FROM (SELECT DISTINCT p_name FROM part WHERE p_name NOT IN (SELECT p_name FROM first)))
SELECT *, true AS old FROM first UNION ALL SELECT *, false FROM rest""")
def ids_after_two_loads(s, d):
    """M1 kept: the names of small parts arrive first, then the whole table; both loads are stored."""
    ensure_namespace(s, "sparkplate_check")
    name, part = _fresh("ids"), analogs.table(s, d, "part").select("p_name", "p_size")
    write_table(I.encode_ids(part.where("p_size < 20"), "p_name", "id"), name)
    first = s.table(name)
    write_table(I.extend_ids(first, part, "p_name", "id"), name)  # replaces the table that it reads
    return read_table(s, name).join(first.select("p_name", F.lit(True).alias("_old")), "p_name", "left").select(
        "p_name", "id", F.coalesce("_old", F.lit(False)).alias("old"))


# ---- look-ups (P10-P12, U4, J8, P15) -------------------------------------------------

query("lookup_account", with_views("""SELECT account_name, name, userid FROM (
  SELECT account_name, name, userid, row_number() OVER (PARTITION BY account_name ORDER BY userid) AS rn
  FROM user_account) WHERE rn = 1""", "user_account"))(
    lambda s, d: L.lookup((acc := I.user_account(analogs.an_user(s, d))), "account_name",
                          acc.select("account_name"), ["name", "userid"], "userid"))
query("lookup_business", with_views("""SELECT businessid, business_id, name FROM (
  SELECT businessid, business_id, name, row_number() OVER (PARTITION BY businessid ORDER BY business_id) AS rn
  FROM restaurant_transform WHERE businessid IN (SELECT businessid FROM shared_ratings)) WHERE rn = 1""",
    "restaurant_transform", "shared_ratings"))(
    lambda s, d: L.lookup(restaurant_tf(s, d), "businessid", shared_ratings(s, d).select("businessid"),
                          ["business_id", "name"], "business_id"))

ITEM_NAME = "small ring"  # a title picked by the user (parameter of P11/M10)
query("read_item", with_views(f"""SELECT * FROM an_restaurant WHERE name = '{ITEM_NAME}'
ORDER BY business_id LIMIT 1""", "an_restaurant"))(
    lambda s, d: flat_hours(L.read_item(analogs.an_restaurant(s, d), ITEM_NAME)))
query("first_per_name", with_views("""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY business_id) AS rn FROM an_restaurant) WHERE rn = 1""",
    "an_restaurant"))(
    lambda s, d: flat_hours(L.first_per(analogs.an_restaurant(s, d), "name", "business_id")))
query("distinct_names", with_views("SELECT DISTINCT name FROM an_restaurant", "an_restaurant"))(
    lambda s, d: L.distinct_values(analogs.an_restaurant(s, d), "name"))
query("with_poster", with_views("""SELECT r.business_id, r.name,
  coalesce('photos/' || p.photo_id || '.jpg', 'fallback.jpg') AS poster
FROM an_restaurant r LEFT JOIN (SELECT business_id, min(photo_id) AS photo_id FROM an_photos GROUP BY business_id) p
USING (business_id)""", "an_restaurant", "an_photos"))(
    lambda s, d: L.with_poster(analogs.an_restaurant(s, d).select("business_id", "name"),
                               analogs.an_photos(s, d)))


# ---- score-based list (M8, M11, P15) -------------------------------------------------

register("weighted", f"""SELECT *, {round_sql("(CAST(review_count AS DOUBLE) / (review_count + m)) * stars"
                                              " + (m / (review_count + m)) * c", 6)} AS score
FROM restaurant_transform, (SELECT avg(stars) AS c, CAST(quantile_cont(review_count, 0.7) AS DOUBLE) AS m
                            FROM restaurant_transform) st
WHERE review_count >= m""", ["restaurant_transform"])


def scored(s, d):
    out = S.weighted_rating(restaurant_tf(s, d))
    return out.withColumn("score", round_half_up(F.col("score"), 6))


query("weighted_rating", with_views(
    "SELECT business_id, businessid, name, stars, review_count, is_open, score FROM weighted", "weighted"))(
    lambda s, d: scored(s, d).select("business_id", "businessid", "name", "stars", "review_count",
                                     "is_open", "score"))
query("top_scored", with_views("""SELECT business_id, name, score FROM weighted
ORDER BY score DESC, review_count DESC, business_id LIMIT 5""", "weighted"))(
    lambda s, d: S.top_scored(scored(s, d)))
query("detail_card", with_views(f"""SELECT business_id, name,
  CASE WHEN is_open = 1 THEN 'Opening' ELSE 'Closed' END AS status,
  {round_sql('score', 2)} AS score_card, {round_sql('score', 3)} AS score_list FROM weighted""", "weighted"))(
    lambda s, d: L.detail_card(scored(s, d)))


# ---- content-based (P9, M9, M10) -----------------------------------------------------


_STOP_SQL = ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS)


def _tfidf_sql(source: str, max_features: int | None = None) -> str:
    """TF-IDF in SQL over ``source(business_id, text_features)``."""
    top = "" if max_features is None else f"""HAVING term IN (SELECT term FROM (
          SELECT unnest(regexp_extract_all(lower(text_features), '{TOKEN_PATTERN}')) AS term FROM {source})
          WHERE term NOT IN ({_STOP_SQL}) GROUP BY term ORDER BY count(*) DESC, term LIMIT {max_features})"""
    return f"""SELECT business_id, term, {round_sql('w / sqrt(sum(w * w) OVER (PARTITION BY business_id))', 6)} AS weight
FROM (
  SELECT t.business_id, t.term, t.tf * (ln((1.0 + (SELECT count(*) FROM {source})) / (v.dfreq + 1)) + 1) AS w
  FROM (SELECT business_id, term, count(*) AS tf FROM (
          SELECT business_id, unnest(regexp_extract_all(lower(text_features), '{TOKEN_PATTERN}')) AS term
          FROM {source}) WHERE term NOT IN ({_STOP_SQL}) GROUP BY business_id, term) t
  JOIN (SELECT term, count(*) AS dfreq FROM (
          SELECT business_id, term FROM (
            SELECT business_id, unnest(regexp_extract_all(lower(text_features), '{TOKEN_PATTERN}')) AS term
            FROM {source}) WHERE term NOT IN ({_STOP_SQL}) GROUP BY business_id, term)
        GROUP BY term
        {top}) v
  USING (term))"""


register("part_text", """SELECT business_id, name, coalesce(categories, '') || ' ' || coalesce(name, '') AS text_features
FROM restaurant_transform""", ["restaurant_transform"])
register("corpus_text", "SELECT business_id, name, coalesce(categories, '') AS text_features FROM an_corpus",
         ["an_corpus"])
register("part_tfidf", _tfidf_sql("part_text"), ["part_text"])
register("corpus_tfidf", _tfidf_sql("corpus_text"), ["corpus_text"])
register("corpus_tfidf_5000", _tfidf_sql("corpus_text", 5000), ["corpus_text"])


def part_items(s, d):
    """The reference's item frame (business_id, name, categories) with its feature text."""
    return text_features(restaurant_tf(s, d).select("business_id", "name", "categories"))


def corpus_items(s, d):
    return text_features(analogs.an_corpus(s, d), ["categories"])


def rounded(df: DataFrame, col: str = "weight") -> DataFrame:
    return df.withColumn(col, round_half_up(F.col(col), 6))


query("text_features", with_views("SELECT * FROM part_text", "part_text"))(
    lambda s, d: part_items(s, d).select("business_id", "name", "text_features"))
query("tfidf_part", with_views("SELECT * FROM part_tfidf", "part_tfidf"))(
    lambda s, d: rounded(C.tfidf(part_items(s, d))))
query("tfidf_documents", with_views("SELECT * FROM corpus_tfidf", "corpus_tfidf"))(
    lambda s, d: rounded(C.tfidf(corpus_items(s, d))))

query("tfidf_documents_5000", with_views("SELECT * FROM corpus_tfidf_5000", "corpus_tfidf_5000"))(
    lambda s, d: rounded(C.tfidf(corpus_items(s, d), max_features=5000)))  # the reference's vocabulary size

PART_TITLES = ["small ring", "red widget"]
DOC_TITLES = ["src3", "src7"]


def _similar_sql(items: str, vec: str, titles: list[str], k: int = 5) -> str:
    tl = ", ".join(f"'{t}'" for t in titles)
    return f"""WITH sel AS (
  SELECT business_id FROM (SELECT business_id, row_number() OVER (PARTITION BY name ORDER BY business_id) AS rn
                           FROM {items} WHERE name IN ({tl})) WHERE rn = 1),
dots AS (
  SELECT c.business_id, max(d) AS score FROM (
    SELECT a.business_id, b.business_id AS sel, sum(a.weight * b.weight) AS d
    FROM {vec} a JOIN {vec} b ON a.term = b.term
    WHERE b.business_id IN (SELECT business_id FROM sel)
    GROUP BY a.business_id, b.business_id) c GROUP BY c.business_id)
SELECT i.business_id, i.name, CASE WHEN dots.score > 0 THEN {round_sql('dots.score', 6)} ELSE 0.0 END AS score
FROM {items} i LEFT JOIN dots USING (business_id)
WHERE i.business_id NOT IN (SELECT business_id FROM sel) AND EXISTS (SELECT 1 FROM sel)
ORDER BY score DESC, i.business_id LIMIT {k}"""


register("part_tfidf_raw", _tfidf_sql("part_text").replace(
    round_sql('w / sqrt(sum(w * w) OVER (PARTITION BY business_id))', 6),
    'w / sqrt(sum(w * w) OVER (PARTITION BY business_id))'), ["part_text"])
register("corpus_tfidf_raw", _tfidf_sql("corpus_text").replace(
    round_sql('w / sqrt(sum(w * w) OVER (PARTITION BY business_id))', 6),
    'w / sqrt(sum(w * w) OVER (PARTITION BY business_id))'), ["corpus_text"])

query("similar_items_part", with_views(_similar_sql("part_text", "part_tfidf_raw", PART_TITLES),
                                       "part_text", "part_tfidf_raw"))(
    lambda s, d: C.similar_indexed(C.index_vectors(items := part_items(s, d)), items, PART_TITLES).rows)
query("similar_items_documents", with_views(_similar_sql("corpus_text", "corpus_tfidf_raw", DOC_TITLES),
                                            "corpus_text", "corpus_tfidf_raw"))(
    lambda s, d: C.similar_indexed(C.index_vectors(items := corpus_items(s, d)), items, DOC_TITLES).rows)
query("similar_items_unknown", with_views(_similar_sql("part_text", "part_tfidf_raw", ["no such title"]),
                                          "part_text", "part_tfidf_raw"))(
    lambda s, d: C.similar_indexed(C.index_vectors(items := part_items(s, d)), items, ["no such title"]).rows)
query("similar_items_scan", with_views(_similar_sql("part_text", "part_tfidf_raw", PART_TITLES),
                                       "part_text", "part_tfidf_raw"))(
    lambda s, d: C.similar_items(cut_lineage(C.tfidf(items := part_items(s, d))), items, PART_TITLES))


# ---- time split (M3) -----------------------------------------------------------------


register("encoded_ratings_by_order", """SELECT r.business_id, r.user_id, r.stars, r.date, u.userid, b.businessid
FROM (SELECT business_id, user_id, stars, date FROM an_review_by_order) r
JOIN (SELECT user_id, CAST(row_number() OVER (ORDER BY user_id ASC NULLS FIRST) AS INTEGER) AS userid
      FROM (SELECT DISTINCT user_id FROM an_review_by_order)) u USING (user_id)
JOIN (SELECT business_id, CAST(row_number() OVER (ORDER BY business_id ASC NULLS FIRST) AS INTEGER) AS businessid
      FROM (SELECT DISTINCT business_id FROM an_review_by_order)) b USING (business_id)""", ["an_review_by_order"])


#: floor(swap * 2^60), written out: the oracle does not share the operator's bound.
_SWAP_BOUND = {0.0: 0, 0.3: 345876451382054092, 1.0: 1152921504606846976}


def _split_sql(src: str, part: str, ratio: str = "0.3", seed: int = 42, swap: float = 0.3) -> str:
    cond = ("(pos > n + k) OR moved" if part == "train"
            else "(pos <= n AND NOT moved) OR (pos > n AND pos <= n + k)")
    return f"""WITH r AS (SELECT DISTINCT business_id, user_id, stars, date, userid, businessid FROM {src}),
ranked AS (SELECT *, row_number() OVER (ORDER BY date DESC NULLS LAST, user_id ASC NULLS FIRST,
                                        business_id ASC NULLS FIRST, stars ASC NULLS FIRST) AS pos FROM r),
params AS (SELECT CAST(floor(count(*) * {ratio}) AS BIGINT) AS n FROM r),
um AS (SELECT userid, max(pos) AS umax FROM ranked GROUP BY userid),
flagged AS (
  SELECT ranked.*, params.n,
    (pos <= params.n AND umax <= params.n AND CAST('0x' || substr(md5(concat_ws('|', '{seed}', user_id, business_id, date,
       CAST(stars AS VARCHAR))), 1, 15) AS BIGINT) < {_SWAP_BOUND[swap]}) AS moved
  FROM ranked JOIN um USING (userid) CROSS JOIN params),
kk AS (SELECT count(*) FILTER (WHERE moved) AS k FROM flagged)
SELECT business_id, user_id, CAST(stars AS INTEGER) AS stars, date, CAST(userid AS INTEGER) AS userid,
       CAST(businessid AS INTEGER) AS businessid
FROM flagged CROSS JOIN kk WHERE {cond}"""


def ratings_by_order(s, d):
    return I.encode_ratings(review_features(analogs.an_review_by_order(s, d)), own_keys=True)


query("time_split_train", with_views(_split_sql("encoded_ratings", "train"), "encoded_ratings"))(
    lambda s, d: SP.time_split(ratings(s, d))[0])
query("time_split_test", with_views(_split_sql("encoded_ratings", "test"), "encoded_ratings"))(
    lambda s, d: SP.time_split(ratings(s, d))[1])
for _part, _i in (("train", 0), ("test", 1)):
    for _name, _swap in ((f"time_split_order_{_part}", 0.3), (f"time_split_no_swap_{_part}", 0.0),
                         (f"time_split_all_swapped_{_part}", 1.0)):
        query(_name, with_views(_split_sql("encoded_ratings_by_order", _part, swap=_swap), "encoded_ratings_by_order"))(
            lambda s, d, i=_i, swap=_swap: SP.time_split(ratings_by_order(s, d), swap=swap)[i])
_RS_HASH = ("CAST('0x' || substr(md5(concat_ws('|', '42', business_id, user_id, CAST(stars AS VARCHAR), date, "
            "CAST(userid AS VARCHAR), CAST(businessid AS VARCHAR))), 1, 15) AS BIGINT)")
# floor(0.8 * 2^60)
query("random_split_train", with_views(f"SELECT * FROM encoded_ratings WHERE {_RS_HASH} < 922337203685477580",
                                       "encoded_ratings"))(
    lambda s, d: SP.random_split(ratings(s, d), (0.8, 0.2), 42)[0])
query("random_split_test", with_views(f"SELECT * FROM encoded_ratings WHERE {_RS_HASH} >= 922337203685477580",
                                      "encoded_ratings"))(
    lambda s, d: SP.random_split(ratings(s, d), (0.8, 0.2), 42)[1])


def _pieces(s, d, weights):
    parts = SP.random_split(cut_lineage(ratings(s, d)), weights, 42)
    out = parts[0].withColumn("piece", F.lit(0))
    for i, p in enumerate(parts[1:], 1):
        out = out.unionByName(p.withColumn("piece", F.lit(i)))
    return out


# floor(0.7 * 2^60) and floor(0.9 * 2^60)
query("random_split_three", with_views(f"""SELECT *, CASE WHEN h < 807045053224792883 THEN 0
  WHEN h < 1037629354146162278 THEN 1 ELSE 2 END AS piece FROM (SELECT *, {_RS_HASH} AS h FROM encoded_ratings)""".replace(
    "SELECT *, CASE", "SELECT * EXCLUDE (h), CASE"), "encoded_ratings"))(lambda s, d: _pieces(s, d, (0.7, 0.2, 0.1)))
query("random_split_ten", with_views(f"""SELECT piece, count(*) AS n FROM (
  SELECT CAST(least(9, {_RS_HASH}::HUGEINT * 10 // 1152921504606846976) AS INTEGER) AS piece FROM encoded_ratings) GROUP BY piece""",
    "encoded_ratings"))(lambda s, d: _pieces(s, d, [1] * 10).groupBy("piece").agg(F.count(F.lit(1)).alias("n")))


# ---- ALS (M4-M7, O5, J7, A31) and runs (S14, M12) ------------------------------------


def _model_and_test(s, d):
    # about a rating per line item, whose number Spark reads off the file footers
    train, test = SP.time_split(shared_ratings(s, d), rows=analogs.table(s, d, "lineitem").count())
    return M.train_als(train), test


# the rows a prediction keeps are those whose user and item were trained on
_TRAINED = f"""WITH tr AS ({_split_sql('shared_ratings', 'train')}),
te AS ({_split_sql('shared_ratings', 'test')})
"""
query("als_predict")(lambda s, d: (lambda mt: M.predict(mt[0], mt[1]))(_model_and_test(s, d)))
query("als_predict_rows", with_views(_TRAINED + """SELECT * FROM te
WHERE userid IN (SELECT userid FROM tr) AND businessid IN (SELECT businessid FROM tr)""", "shared_ratings"))(
    lambda s, d: (lambda mt: M.predict(mt[0], mt[1]).drop("prediction"))(_model_and_test(s, d)))


def _recs(s, d, n=5):
    model, test = _model_and_test(s, d)
    return M.recommend(model, test.select("userid"), n)


query("als_recommend")(lambda s, d: _recs(s, d))
query("als_recommend_counts", with_views(_TRAINED + """SELECT userid, least(5, (SELECT count(DISTINCT businessid) FROM tr)) AS n
FROM (SELECT DISTINCT userid FROM te WHERE userid IN (SELECT userid FROM tr))""", "shared_ratings"))(
    lambda s, d: _recs(s, d).groupBy("userid").agg(F.count(F.lit(1)).alias("n")))


def _asked_recs(s, d):
    """Requests with their own list length: 1 to 8 items, by user id."""
    model, test = _model_and_test(s, d)
    asked = test.select("userid", (F.col("userid") % 8 + 1).alias("res_num"))
    return M.recommend(model, asked, count_col="res_num").groupBy("userid").agg(F.count(F.lit(1)).alias("n"))


query("als_recommend_asked", with_views(_TRAINED + """SELECT userid, CAST(least(userid % 8 + 1, (SELECT count(DISTINCT businessid) FROM tr)) AS BIGINT) AS n
FROM (SELECT DISTINCT userid FROM te WHERE userid IN (SELECT userid FROM tr))""", "shared_ratings"))(_asked_recs)


def _rec_faults(s, d):
    """Rows that break what a recommendation list promises: all counts are zero."""
    recs = cut_lineage(_recs(s, d))
    lists = M.recommend_grouped(recs).select("results", F.transform("results", lambda r: r["rating"]).alias("r"),
                                             F.transform("results", lambda r: r["businessid"]).alias("i"))

    def count(cond):
        return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")
    return lists.agg(count(F.array_min("r") < 0).alias("negative"),
                     count(F.size(F.array_distinct("i")) < F.size("i")).alias("repeated"),
                     count(F.sort_array("r", asc=False) != F.col("r")).alias("unsorted"),
                     count(F.size("i") > 5).alias("too_long"))


query("als_recommend_faults", "SELECT CAST(0 AS BIGINT) AS negative, CAST(0 AS BIGINT) AS repeated, "
      "CAST(0 AS BIGINT) AS unsorted, CAST(0 AS BIGINT) AS too_long")(_rec_faults)
query("als_recommend_named")(lambda s, d: L.enrich_recommendations(_recs(s, d), restaurant_tf(s, d)))
query("als_grouped")(lambda s, d: M.recommend_grouped(_recs(s, d)))
query("als_error_metrics")(
    lambda s, d: (lambda mt: M.error_metrics(M.predict(mt[0], mt[1])))(_model_and_test(s, d)))
query("als_pipeline_predict")(
    lambda s, d: (lambda tr: M.predict(M.train_als_pipeline(tr[0]), tr[1]))(
        SP.random_split(cut_lineage(shared_ratings(s, d)), (0.8, 0.2), 42)))  # read by both pieces


# the same list operators on scores that SQL can compute: each user's reviewed items by mean stars
register("mean_scores", f"""SELECT DISTINCT userid, businessid, {round_sql('avg(stars) OVER (PARTITION BY businessid)', 6)} AS rating
FROM shared_ratings""", ["shared_ratings"])


def mean_scores(s, d):
    r = cut_lineage(shared_ratings(s, d).select("userid", "businessid", "stars"))
    means = cut_lineage(r.groupBy("businessid").agg(round_half_up(F.avg("stars"), 6).alias("rating")))
    return r.select("userid", "businessid").distinct().join(means, "businessid").select("userid", "businessid", "rating")


_TOP_SQL = """SELECT userid, businessid, rating FROM (
  SELECT *, row_number() OVER (PARTITION BY userid ORDER BY rating DESC, businessid) AS rn FROM mean_scores) WHERE rn <= 5"""
query("top_n_means", with_views(_TOP_SQL, "mean_scores"))(lambda s, d: M.top_n(mean_scores(s, d), 5))
query("top_n_means_named", with_views(f"""SELECT t.userid, r.business_id, r.name, t.rating AS score
FROM ({_TOP_SQL}) t JOIN restaurant_transform r USING (businessid)""", "mean_scores", "restaurant_transform"))(
    lambda s, d: L.enrich_recommendations(M.top_n(mean_scores(s, d), 5), restaurant_tf(s, d)))
query("top_n_means_grouped", with_views(f"""SELECT userid,
  CAST(row_number() OVER (PARTITION BY userid ORDER BY rating DESC, businessid DESC) - 1 AS INTEGER) AS pos, businessid, rating
FROM ({_TOP_SQL})""", "mean_scores"))(
    lambda s, d: M.recommend_grouped(M.top_n(mean_scores(s, d), 5)).select("userid", F.posexplode("results").alias("pos", "r"))
    .select("userid", "pos", "r.businessid", "r.rating"))


# the index of the recommender on factors that SQL can compute: eighths, whose products are exact
_USER_FACTORS = ["c_custkey % 7 / 8.0", "(c_custkey % 11 - 5) / 8.0", "(c_custkey % 13 - 6) / 8.0", "1.0"]
_ITEM_FACTORS = ["p_partkey % 29 * (p_partkey % 5) / 8.0", "p_partkey % 29 * (p_partkey % 3 - 1) / 8.0",
                 "(p_size % 9 - 4) / 8.0", "p_partkey % 29 / 8.0"]


def factor_lists(s, d):
    """(users, items) of ``top_items``: customers and parts."""
    def factors(table, key, name, parts):
        lists = F.array(*[F.expr(f"CAST({x} AS DOUBLE)") for x in parts])
        return analogs.table(s, d, table).select(F.col(key).cast("bigint").alias(name), lists.alias("features"))
    return factors("customer", "c_custkey", "user", _USER_FACTORS), factors("part", "p_partkey", "item", _ITEM_FACTORS)


_DOT_SQL = " + ".join(f"CAST({u} AS DOUBLE) * CAST({i} AS DOUBLE)" for u, i in zip(_USER_FACTORS, _ITEM_FACTORS))
query("top_items_factors", f"""SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS INTEGER) AS rank
  FROM (SELECT CAST(c_custkey AS BIGINT) AS "user", CAST(p_partkey AS BIGINT) AS item, {_DOT_SQL} AS score FROM customer, part))
WHERE rank <= 5""")(lambda s, d: T.top_items(*factor_lists(s, d)).rows)


def _baseline_runs(s, d):
    """Three baseline predictors (global, user and item mean) evaluated on all ratings."""
    r = cut_lineage(ratings(s, d).select("userid", "businessid", F.col("stars").cast("double").alias("stars")))
    mean = r.agg(F.avg("stars").alias("prediction")).withColumn("_one", F.lit(1))
    # written once, so each join has exchanges of its own and a hot key can be split
    user_mean = cut_lineage(r.groupBy("userid").agg(F.avg("stars").alias("prediction")))
    item_mean = cut_lineage(r.groupBy("businessid").agg(F.avg("stars").alias("prediction")))
    runs = [
        M.error_metrics(r.withColumn("_one", F.lit(1)).join(F.broadcast(mean), "_one"))  # one row
        .withColumn("run_name", F.lit("global_mean")),
        M.error_metrics(r.join(user_mean, "userid")).withColumn("run_name", F.lit("user_mean")),
        M.error_metrics(r.join(item_mean, "businessid")).withColumn("run_name", F.lit("item_mean")),
    ]
    wide = runs[0].unionByName(runs[1]).unionByName(runs[2])
    long = R.metrics_from_frame(wide)
    return long.withColumn("value", round_half_up(F.col("value"), 6))


register("baseline_runs", f"""SELECT run_name AS run_id, run_name, metric, {round_sql('value', 6)} AS value FROM (
  SELECT run_name, count(*) AS n, avg(e) AS mse, sqrt(avg(e)) AS rmse FROM (
    SELECT 'global_mean' AS run_name, power(stars - (SELECT avg(stars) FROM encoded_ratings), 2) AS e FROM encoded_ratings
    UNION ALL
    SELECT 'user_mean', power(stars - avg(stars) OVER (PARTITION BY userid), 2) FROM encoded_ratings
    UNION ALL
    SELECT 'item_mean', power(stars - avg(stars) OVER (PARTITION BY businessid), 2) FROM encoded_ratings)
  GROUP BY run_name)
UNPIVOT (value FOR metric IN (n, mse, rmse))""", ["encoded_ratings"])

query("baseline_error_metrics", with_views("SELECT run_id, run_name, metric, value FROM baseline_runs",
                                           "baseline_runs"))(
    lambda s, d: _baseline_runs(s, d).select("run_id", "run_name", "metric", "value"))
query("best_run", with_views("""SELECT run_id, run_name, metric, value FROM baseline_runs WHERE metric = 'rmse'
ORDER BY value ASC NULLS LAST, run_id LIMIT 1""", "baseline_runs"))(
    lambda s, d: R.best_run(_baseline_runs(s, d)).select("run_id", "run_name", "metric", "value"))
query("find_run", with_views("SELECT run_id, run_name, metric, value FROM baseline_runs WHERE run_name = 'user_mean'",
                             "baseline_runs"))(
    lambda s, d: R.find_run(_baseline_runs(s, d), "user_mean").select("run_id", "run_name", "metric", "value"))


# ---- ad-hoc SQL over published views (S7, S16) ---------------------------------------


@query("adhoc_sql", with_views("""SELECT city, count(*) AS reviews, CAST(sum(stars) AS BIGINT) AS stars_total
FROM analyses_review WHERE stars >= 3 GROUP BY city""", "analyses_review"))
def adhoc_sql(spark, d):
    """S7 + S16: publish the gold table as a view, then a parameterised SQL query over it."""
    publish_view(spark, ar(spark, d), "gold.analyses_review")
    return sql_query(spark, """SELECT city, count(*) AS reviews, CAST(sum(stars) AS BIGINT) AS stars_total
FROM gold_analyses_review WHERE stars >= :min_stars GROUP BY city""", {"min_stars": 3})


query("als_recommend_shared_ids")(
    lambda s, d: L.enrich_recommendations(_recs(s, d), restaurant_tf(s, d)))


# ---- catalog round trips (S3-S5, S8, S9, S14) -----------------------------------------

@query("catalog_round_trip", "SELECT p_partkey, p_name, p_size * 2 AS doubled FROM part")
def catalog_round_trip(spark, d):
    """Create a namespace and a table, replace it with another schema, read it."""
    ensure_namespace(spark, "sparkplate_check")
    name, part = _fresh("part"), analogs.table(spark, d, "part")
    write_table(part.select("p_partkey"), name)
    write_table(part.select("p_partkey", "p_name", (F.col("p_size") * 2).alias("doubled")), name)
    return read_table(spark, name)


@query("metrics_log", """SELECT 'r1' AS run_id, 'tables' AS run_name, 'part' AS metric, CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM part
UNION ALL SELECT 'r2', 'tables', 'customer', CAST(count(*) AS DOUBLE), NULL FROM customer
UNION ALL SELECT 'r2', 'tables', 'model_path', NULL, 'models/als'""")
def metrics_log(spark, d):
    """Two runs appended to one metrics table, numbers and a text parameter."""
    ensure_namespace(spark, "sparkplate_check")
    name = _fresh("metrics")
    R.log_metrics(R.metrics_rows(spark, "r1", "tables", {"part": analogs.table(spark, d, "part").count()}), name)
    R.log_metrics(R.metrics_rows(spark, "r2", "tables", {"customer": analogs.table(spark, d, "customer").count(),
                                                         "model_path": "models/als"}), name)
    return read_table(spark, name).select("run_id", "run_name", "metric", "value", "text")


# ---- set difference (U1) -------------------------------------------------------------

query("pairs_never_top_rated", with_views("""SELECT user_id, business_id FROM an_review
EXCEPT SELECT user_id, business_id FROM an_review WHERE stars = 5""", "an_review"))(
    lambda s, d: SP.except_distinct(
        (r := analogs.an_review(s, d)).select("user_id", "business_id"),
        r.where(F.col("stars") == 5).select("business_id", "user_id")))
