"""The corpus pipeline: documents through operators of ``sparkplate.llm``, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame; ``run`` writes each result
as Parquet to the shared checkpoint folder and reads it back as the next stage's input, so
a lost executor never recomputes an earlier stage. All stages but the last return the
columns of ``documents``; where a stage changes ``text``, ``n_chars`` follows it. The last
returns the packed pieces (document, span, sequence, offset).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkplate.llm import lines, ngrams, packing, quality, substrings
from sparkplate.llm.common import documents, materialise


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now; a null text keeps what it had."""
    if "n_chars" not in docs.columns:
        return docs
    kind = dict(docs.dtypes)["n_chars"]
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy rejects go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of many sources go from all but their first document."""
    return _counted(lines.clean_lines(docs).select(*docs.columns))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngrams.keep_one(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 50-byte strings that start in an earlier document go."""
    return _counted(substrings.remove_repeats(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("suffix_dedup", suffix_dedup),
    ("packing", pack),
]

#: Near-copy links and byte-string removal are beyond a SQL twin; tests hold the rows
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
