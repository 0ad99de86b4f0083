"""Silver layer: dimension and fact projections (P1-P4) and the calendar table (M2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkplate.functions.dates import (date_key, date_spine, day_of_week_iso, fiscal_month,
                                        fiscal_year)

# Output columns of the user dimension, in order.
DIM_USER_COLUMNS = [
    ("user_id", "user_id"), ("name", "user_name"), ("average_stars", "average_stars"),
    ("review_count", "review_count"), ("funny", "funny"), ("cool", "cool"), ("fans", "fans"),
    ("friends", "friends"), ("compliment_cool", "compliment_cool"),
    ("compliment_cute", "compliment_cute"), ("compliment_funny", "compliment_funny"),
    ("compliment_hot", "compliment_hot"), ("compliment_list", "compliment_list"),
    ("compliment_more", "compliment_more"), ("compliment_note", "compliment_note"),
    ("compliment_photos", "compliment_photos"), ("compliment_plain", "compliment_plain"),
    ("compliment_profile", "compliment_profile"), ("compliment_writer", "compliment_writer"),
]

# Output columns of the restaurant dimension, in order.
DIM_RESTAURANT_COLUMNS = [
    ("business_id", "restaurant_id"), ("name", "restaurant_name"), ("categories", "categories"),
    ("city", "city"), ("address", "address"), ("is_open", "is_open"), ("latitude", "latitude"),
    ("longitude", "longitude"), ("postal_code", "postal_code"), ("review_count", "review_count"),
    ("stars", "stars"), ("state", "state"), ("hours", "hours"),
]


def dim_user(user: DataFrame) -> DataFrame:
    """19 columns; ``name`` becomes ``user_name``."""
    return user.select(*[F.col(s).alias(t) for s, t in DIM_USER_COLUMNS])


def dim_restaurant(restaurant: DataFrame) -> DataFrame:
    """13 columns; ``business_id`` -> ``restaurant_id``, ``name`` -> ``restaurant_name``."""
    return restaurant.select(*[F.col(s).alias(t) for s, t in DIM_RESTAURANT_COLUMNS])


def fact_review(review: DataFrame) -> DataFrame:
    """9 columns; the review date is kept as text (``CAST(date AS VARCHAR)``)."""
    return review.select(
        "review_id",
        F.col("business_id").alias("restaurant_id"),
        "user_id", "stars", "cool", "funny", "useful",
        F.col("date").cast("string").alias("review_date"),
        F.col("text").alias("review_description"),
    )


def view_sql(restaurant: str, user: str, review: str) -> dict[str, str]:
    """P1-P3 as SQL text over catalog tables, for views that outlive the session."""
    def columns(pairs):
        return ", ".join(f"{s} AS {t}" for s, t in pairs)
    return {
        "dim_user": f"SELECT {columns(DIM_USER_COLUMNS)} FROM {user}",
        "dim_restaurant": f"SELECT {columns(DIM_RESTAURANT_COLUMNS)} FROM {restaurant}",
        "fact_review": "SELECT review_id, business_id AS restaurant_id, user_id, stars, cool, funny, useful, "
                       f"CAST(date AS STRING) AS review_date, text AS review_description FROM {review}",
    }


def review_features(review: DataFrame) -> DataFrame:
    """The feature-store projection used for training."""
    return review.select("business_id", "user_id", "stars", "date")


def dim_date(spark: SparkSession, begin: str = "2010-01-01", end: str = "2037-01-01") -> DataFrame:
    """M2: 18-column calendar, one row per day from ``begin`` to ``end`` inclusive."""
    d = F.col("CalendarDate")
    dow = day_of_week_iso(d)
    return date_spine(spark, begin, end).select(
        date_key(d).alias("dateInt"),
        d,
        F.year(d).cast("bigint").alias("CalendarYear"),
        F.date_format(d, "MMMM").alias("CalendarMonth"),
        F.month(d).cast("bigint").alias("MonthOfYear"),
        F.date_format(d, "EEEE").alias("CalendarDay"),
        dow.alias("DayOfWeek"),
        dow.alias("DayOfWeekStartMonday"),
        F.when(dow < 6, "Y").otherwise("N").alias("IsWeekDay"),
        F.dayofmonth(d).cast("bigint").alias("DayOfMonth"),
        F.when(d == F.last_day(d), "Y").otherwise("N").alias("IsLastDayOfMonth"),
        F.dayofyear(d).cast("bigint").alias("DayOfYear"),
        F.weekofyear(d).cast("bigint").alias("WeekOfYearIso"),
        F.quarter(d).cast("bigint").alias("QuarterOfYear"),
        fiscal_year(d, 10).alias("FiscalYearOctToSep"),
        fiscal_month(d, 10).alias("FiscalMonthOctToSep"),
        fiscal_year(d, 7).alias("FiscalYearJulToJun"),
        fiscal_month(d, 7).alias("FiscalMonthJulToJun"),
    )
