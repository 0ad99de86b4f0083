"""Shared helpers: reading documents, word rules, expression binding, lineage cuts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkplate.session import checkpoint_dir

#: Characters that separate words: space and the ASCII controls tab to carriage return.
WORD_SPACE = " \t\n\x0b\f\r"
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body`` as often as wanted.

    A one-element ``transform`` binds it to a lambda variable, so the optimiser cannot
    copy the expression into inner lambdas, where it would run once per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; null and blank texts have none."""
    parts = F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(WORD_SPACE)), WORD_SPLIT)
    return F.array_remove(parts, "")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared checkpoint folder as Parquet and read it back.

    Like a reliable checkpoint, but columnar and compressed; a lost executor re-reads the
    files instead of recomputing.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
