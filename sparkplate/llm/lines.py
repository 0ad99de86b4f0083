"""Operator 2, line dedup: lines spread over many distinct sources are boilerplate.

Each line with a word is keyed by 128 bits of hash. One aggregation per key merges
HyperLogLog sketches of the sources (partial sketches are built before the shuffle, so a
line of a third of all rows arrives as one row per task). The estimate settles lines far
from the threshold; lines near it get their exact distinct source count from a second
aggregation over those lines alone. The first document (smallest id) that has a
boilerplate line keeps it, so that copies of one document never wipe out its text; every
other document loses it.

Defined cases: null text is empty and stays null; null source is one source of its own;
a null ``doc_id`` counts as larger than any; lines without a word are always kept;
repeated ids are each cleaned, against the lines of their id; extra columns pass through.
A text whose lines all go becomes empty, its row stays. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkplate.llm.common import documents, let, materialise

#: Distinct sources from which on a line counts as boilerplate.
MIN_SITES = 12
LG_K = 12
#: Sketch estimates off by more than this share of the threshold (over ten standard errors
#: at LG_K = 12, 1.04 / sqrt(2^12) = 1.6 % each) settle a line; the rest is counted.
BAND = 0.2


def _key(line: Column) -> Column:
    """128 bits of a line: two 64-bit hashes of unlike input."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(7), line, F.length(line)).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _has_word(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(" \t\x0b\f\r"))) > 0


def line_sites(docs: DataFrame) -> DataFrame:
    """(a, b, doc_id, site): a row per distinct line of a document."""
    keys = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), _has_word), _key))
    return (docs.select("doc_id", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("site"),
                        F.explode(keys).alias("k"))
            .select("k.a", "k.b", "doc_id", "site"))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(a, b, first_id, sites_estimate, exact_sites): lines of ``min_sites`` sources or more."""
    lines = line_sites(docs)
    sketched = (lines.groupBy("a", "b")
                .agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"),
                     F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
                .where(F.col("n") >= min_sites)
                .select("a", "b", "first_id", F.hll_sketch_estimate("sketch").alias("estimate"))
                .where(F.col("estimate") >= (1 - BAND) * min_sites))
    sketched = materialise(sketched, "line-sketch")
    far = sketched.where(F.col("estimate") > (1 + BAND) * min_sites)
    near = sketched.where(F.col("estimate") <= (1 + BAND) * min_sites)
    # distinct (line, site) pairs are formed before the shuffle, so hot lines stay small
    exact = (lines.join(near.select("a", "b"), ["a", "b"], "left_semi")
             .groupBy("a", "b", "site").agg(F.lit(1).alias("one"))
             .groupBy("a", "b").agg(F.count("*").alias("exact_sites"))
             .where(F.col("exact_sites") >= min_sites))
    settled = near.join(exact, ["a", "b"])
    return far.withColumn("exact_sites", F.lit(None).cast("bigint")).unionByName(settled)


def clean_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with boilerplate lines removed from ``text``, plus ``n_lines``, ``n_removed``.

    The keys to remove are gathered per document (bounded by its own lines) and joined
    back by id; texts are shuffled once at most, and not at all while the keys are small
    enough for a size-checked broadcast.
    """
    marked = materialise(boilerplate(docs, min_sites), "line-marked")
    hits = (line_sites(docs).join(marked.select("a", "b", "first_id"), ["a", "b"])
            .where(~F.col("doc_id").eqNullSafe(F.col("first_id")))
            .groupBy(F.col("doc_id").alias("_id"))
            .agg(F.collect_set(F.struct("a", "b")).alias("_gone")))
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed", "text")]
    joined = docs.join(hits, docs["doc_id"].eqNullSafe(F.col("_id")), "left")
    kept = let(F.col("_gone"), lambda g: F.filter(
        _lines(F.col("text")), lambda x: ~(_has_word(x) & F.array_contains(g, _key(x)))))
    n = F.size(_lines(F.col("text"))).cast("bigint")
    plain = F.col("_gone").isNull()
    out = joined.select(*own, "text", F.when(plain, F.lit(None)).otherwise(kept).alias("_kept"), n.alias("n_lines"))
    return out.select(*own, F.when(F.col("_kept").isNull(), F.col("text"))
                      .otherwise(F.array_join("_kept", "\n")).alias("text"), "n_lines",
                      F.when(F.col("_kept").isNull(), F.lit(0))
                      .otherwise(F.col("n_lines") - F.size("_kept")).cast("bigint").alias("n_removed"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = clean_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_removed",
                      F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("kept_chars"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH l AS (
  SELECT doc_id, source, pos, line, regexp_matches(line, '[^\x20\x09-\x0D]') AS has_word
  FROM (SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
bad AS (
  SELECT line, min(doc_id) AS first_id FROM l WHERE has_word
  GROUP BY line HAVING count(DISTINCT coalesce('s' || source, '')) >= 12),
f AS (
  SELECT l.*, has_word AND bad.line IS NOT NULL AND doc_id <> first_id AS gone FROM l LEFT JOIN bad USING (line))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_removed,
       length(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))::BIGINT AS kept_chars,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""
