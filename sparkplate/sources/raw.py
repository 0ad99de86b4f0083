"""Raw readers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkplate.sources.schemas import PHOTO, RAW, REQUEST


def read_raw(spark: SparkSession, path: str, dataset: str, infer: bool = False) -> DataFrame:
    """JSON lines of one raw dataset (business, user, review, checkin, tip).

    The declared schema avoids the extra inference job over the whole input; ``infer=True``
    reproduces the reference (alphabetical fields, union of keys seen).
    """
    reader = spark.read if infer else spark.read.schema(RAW[dataset])
    return reader.json(path)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """An image folder; files that do not decode are dropped."""
    return spark.read.format("image").option("dropInvalid", True).load(path)


def image_info(images: DataFrame) -> DataFrame:
    """Nested-field projection of the image struct."""
    return images.select(F.col("image.origin").alias("origin"), F.col("image.width").alias("width"),
                         F.col("image.height").alias("height"))


def read_photo_index(spark: SparkSession, path: str) -> DataFrame:
    """The photo index (business_id, photo_id, caption, label); an absent file gives an
    empty frame with the same columns."""
    try:
        return spark.read.schema(PHOTO).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], PHOTO)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Recommendation requests (JSON lines), as a table of ``userid, res_num``."""
    return spark.read.schema(REQUEST).json(path).select("userid", "res_num")
