"""Operator 5, exact dedup against an immutable snapshot, with binary fuse filters.

A snapshot's distinct 64-bit digests are cut by hash into buckets of about ``BUCKET``
digests; each bucket gets one static fuse filter (about 1.2 bytes a digest). An incoming
batch is first grouped by digest on its own, which also turns a group of copies of any
size into one row before it meets a filter. The distinct incoming digests are screened
bucket by bucket. Only digests that pass a filter or repeat within snapshot or batch have
their texts grouped, and that grouping is by the whole normalised text, so bytes decide
and neither a filter's false pass nor a digest collision can join two texts.

Defined cases: null text counts as empty; a null ``doc_id`` counts as larger than any and
stands only for a group without ids; repeated ids are grouped by text like any rows; of rows
that share a group's smallest id (or have no id, where none has) the one read first stays, so a
group keeps exactly one row; extra columns are not read; an empty snapshot, batch or table is fine.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkplate.llm import fuse
from sparkplate.llm.common import documents, materialise

BUCKET = 1_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, sha): 64-bit digest and SHA-256 of the normalised text."""
    norm = docs.select("doc_id", normalised(F.col("text")).alias("norm"))
    return norm.select("doc_id", F.xxhash64("norm").alias("digest"), F.unhex(F.sha2("norm", 256)).alias("sha"))


def _per_digest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.count("*").alias("n"))


def build_filters(snapshot: DataFrame, buckets: int) -> DataFrame:
    """One filter row per bucket of a snapshot's distinct digests."""
    def make(key, pdf: pd.DataFrame) -> pd.DataFrame:
        seed, length, segments, table = fuse.build(pdf["digest"].to_numpy().view(np.uint64))
        return pd.DataFrame({"bucket": [key[0]], "seed": [seed], "length": [length], "segments": [segments], "table": [table]})

    return (snapshot.select("digest", F.pmod("digest", F.lit(buckets)).alias("bucket")).groupBy("bucket")
            .applyInPandas(make, "bucket bigint, seed int, length int, segments int, table binary"))


def screen(batch: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The distinct batch digests that may be in the snapshot."""
    def ask(incoming: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        if stored.empty or incoming.empty:
            return incoming[["digest"]].head(0)
        f = stored.iloc[0]
        keys = incoming["digest"].to_numpy(np.int64).view(np.uint64)
        return incoming.loc[fuse.contains(keys, int(f["seed"]), int(f["length"]), int(f["segments"]), f["table"]), ["digest"]]

    keyed = batch.select("digest", F.pmod("digest", F.lit(buckets)).alias("bucket"))
    return keyed.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(ask, "digest bigint")


def dedup(snapshot: DataFrame, batch: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, sha) of every row of both inputs.

    The smallest id of equal texts stays, over snapshot and batch together.
    """
    old, new = snapshot.select("doc_id", "text"), batch.select("doc_id", "text")
    rows = materialise(digests(old).withColumn("old", F.lit(True))
                       .unionByName(digests(new).withColumn("old", F.lit(False)))
                       .withColumn("row", F.monotonically_increasing_id()), "digests")
    held = materialise(_per_digest(rows.where("old")), "snapshot-digests")
    came = _per_digest(rows.where("NOT old"))
    buckets = max(1, -(-held.count() // BUCKET))
    filters = materialise(build_filters(held, buckets), "filters")
    repeated = (screen(came, filters, buckets)
                .unionByName(held.where("n > 1").select("digest"))
                .unionByName(came.where("n > 1").select("digest")).distinct())
    repeated = materialise(repeated, "repeated")
    named = old.unionByName(new).select("doc_id", normalised(F.col("text")).alias("norm"))
    groups = (named.withColumn("digest", F.xxhash64("norm")).join(repeated, "digest", "left_semi")
              .groupBy("norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
              .where("group_size > 1")
              .select(F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size"))
    groups = materialise(groups, "groups")
    first = (rows.join(groups, "sha").where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
             .groupBy("sha").agg(F.min("row").alias("keep_row")))
    groups = materialise(groups.join(first, "sha"), "kept-rows")
    out = rows.join(groups, "sha", "left")
    single = F.col("group_size").isNull()
    return out.select(
        "doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (single | (F.col("row") == F.col("keep_row"))).alias("kept"), "sha")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older half of the id range is the snapshot, the rest (and null ids) the batch."""
    docs = documents(spark, sf_dir)
    ends = docs.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).first()
    middle = ((ends["a"] or 0) + (ends["b"] or 0)) // 2
    is_old = F.coalesce(F.col("doc_id") <= middle, F.lit(False))
    out = dedup(docs.where(is_old), docs.where(~is_old))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
