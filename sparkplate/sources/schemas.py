"""Declared schemas of the raw JSON-lines datasets (no inference pass over the input)."""

from pyspark.sql import types as T

from sparkplate.sources.analogs import WEEKDAYS

S, L, D = T.StringType(), T.LongType(), T.DoubleType()


def _struct(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


BUSINESS = _struct([
    ("business_id", S), ("name", S), ("address", S), ("city", S), ("state", S), ("postal_code", S),
    ("latitude", D), ("longitude", D), ("stars", D), ("review_count", L), ("is_open", L),
    ("categories", S), ("hours", _struct([(d, S) for d in WEEKDAYS])),
])

USER = _struct([
    ("user_id", S), ("name", S), ("review_count", L), ("yelping_since", S), ("useful", L),
    ("funny", L), ("cool", L), ("elite", S), ("friends", S), ("fans", L), ("average_stars", D),
    ("compliment_hot", L), ("compliment_more", L), ("compliment_profile", L), ("compliment_cute", L),
    ("compliment_list", L), ("compliment_note", L), ("compliment_plain", L), ("compliment_cool", L),
    ("compliment_funny", L), ("compliment_writer", L), ("compliment_photos", L),
])

REVIEW = _struct([
    ("review_id", S), ("user_id", S), ("business_id", S), ("stars", L), ("useful", L), ("funny", L),
    ("cool", L), ("text", S), ("date", S),
])

CHECKIN = _struct([("business_id", S), ("date", S)])

TIP = _struct([("user_id", S), ("business_id", S), ("text", S), ("date", S), ("compliment_count", L)])

PHOTO = _struct([("business_id", S), ("photo_id", S), ("caption", S), ("label", S)])

REQUEST = _struct([("userid", T.IntegerType()), ("res_num", T.IntegerType()), ("token", S)])

RAW = {"business": BUSINESS, "user": USER, "review": REVIEW, "checkin": CHECKIN, "tip": TIP}
