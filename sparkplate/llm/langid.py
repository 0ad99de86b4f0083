"""Operator 8, language identification by the nearest of several centroids per language.

A text becomes a TF-IDF vector over hashed byte trigrams of its letters (lower case; what is
no letter is a space), of length one. Document frequencies cover every training row. The
centroids are fitted on a bounded sample, at most ``SAMPLE`` distinct texts per language drawn
by a hash of the text and taken in the texts' order, so equal rows in any layout give equal
models: spherical k-means with ``CENTROIDS`` centroids for each. A text gets the language of
the centroid with the highest cosine; ``rejected`` tells that the cosine lies below what
``REJECT`` times the sample's lower cosines reach, i.e. that it is far from every language.

Defined cases: a text that is null or has no letter is ``und`` with score 0; rows without
``lang`` are never trained on; a null ``doc_id`` counts as an empty id; repeated rows are
judged row by row; extra columns pass through ``predict``; without any training row every
prediction is ``und``. Equal scores go to the first language in alphabetical order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkplate.llm.common import documents, materialise

DIMS, SAMPLE, CENTROIDS, ROUNDS, REJECT = 1 << 14, 400, 4, 8, 0.5
_LETTERS = bytes(b if chr(b).isalpha() or b >= 128 else 32 for b in range(128)) + bytes(range(128, 256))


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(dimension, count) of a text's hashed trigrams; None if it has no letter."""
    if not text or not any(map(str.isalpha, text)):
        return None
    raw = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b" "
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    h = ((b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]) * np.uint32(0x9E3779B1) if len(b) > 2 else b
    count = np.bincount(h >> np.uint32(32 - 14), minlength=DIMS)
    at = np.flatnonzero(count)
    return at, count[at]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def document_frequencies(train: DataFrame) -> tuple[int, np.ndarray]:
    """(documents, documents with each dimension) over every row of ``train``.

    Each task adds up its own vector and hands over one row per dimension, so a fixed
    number of small rows per task is all that moves.
    """
    def count(batches):
        n, df = 0, np.zeros(DIMS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = trigrams(text)
                if found:
                    n += 1
                    df[found[0]] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(df[at], n), pa.int64())], ["dim", "df"])

    rows = train.select("text").mapInArrow(count, "dim int, df bigint").groupBy("dim").agg(F.sum("df").alias("df")).collect()
    out, n = np.zeros(DIMS, np.int64), 0
    for r in rows:  # at most DIMS + 1 rows
        if r["dim"] < 0:
            n = r["df"]
        else:
            out[r["dim"]] = r["df"]
    return n, out


def _unit(found, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, count = found
    v = np.log1p(count).astype(np.float32) * idf[at]
    return at, v / np.sqrt(v @ v)


def sample(train: DataFrame, size: int = SAMPLE) -> DataFrame:
    """At most ``size`` distinct texts per language, drawn by a hash of the text.

    A hash draws about twice as many, their order decides. Neither ids nor the layout of the
    files have a part in it. Copies of a text count once, so a group of copies cannot fill it.
    """
    named = train.select("lang", "text", F.xxhash64(F.lit(11), "text").alias("_draw"))
    labels = named.groupBy("lang").agg(F.approx_count_distinct("_draw").alias("_n"))
    some = (named.join(F.broadcast(labels), "lang")  # a row per language
            .where(F.pmod("_draw", F.greatest("_n", F.lit(1))) < 2 * size))
    one = some.groupBy("lang", "_draw").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy("_draw")
    return one.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= size).select("lang", "text")


class Model:
    """idf, languages and centroids (dimensions x centroids), with each centroid's least cosine."""

    def __init__(self, idf: np.ndarray, langs: list[str], centroids: np.ndarray, least: np.ndarray):
        self.idf, self.langs, self.centroids, self.least = idf, langs, centroids, least

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        found = trigrams(text)
        if found is None or not self.langs:
            return "und", 0.0, True
        at, v = _unit(found, self.idf)
        cosine = v @ self.centroids[at]
        best = int(np.argmax(cosine))
        score = min(1.0, max(0.0, float(cosine[best])))
        return self.langs[best], score, bool(cosine[best] < self.least[best])


def fit(train: DataFrame) -> Model:
    """Learn from rows with ``text`` and ``lang``; see the module for what is sampled."""
    n, df = document_frequencies(train)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)

    def cluster(key, pdf: pd.DataFrame) -> pd.DataFrame:
        found = [f for f in map(trigrams, sorted(t for t in pdf["text"] if t is not None)) if f is not None]
        x = np.zeros((len(found), DIMS), np.float32)
        for row, f in zip(x, found):
            at, v = _unit(f, idf)
            row[at] = v
        k = min(CENTROIDS, len(x))
        if not k:
            return pd.DataFrame({"lang": [], "centroid": [], "least": []})
        order = np.argsort(x @ x.mean(axis=0), kind="stable")  # seeds from near to far
        c = x[order[np.linspace(0, len(x) - 1, k).astype(int)]]
        for _ in range(ROUNDS):
            own = np.argmax(x @ c.T, axis=1)
            c = np.stack([x[own == i].sum(axis=0) if (own == i).any() else c[i] for i in range(k)])
            c /= np.linalg.norm(c, axis=1, keepdims=True)
        cosine = (x @ c.T).max(axis=1)
        least = REJECT * float(np.quantile(cosine, 0.05))
        return pd.DataFrame({"lang": key[0], "centroid": [r.astype("<f4").tobytes() for r in c], "least": least})

    rows = sample(train).groupBy("lang").applyInPandas(cluster, "lang string, centroid binary, least double").collect()
    rows.sort(key=lambda r: (r["lang"], r["centroid"]))  # CENTROIDS rows per language
    if not rows:
        return Model(idf, [], np.zeros((DIMS, 0), np.float32), np.zeros(0))
    centroids = np.stack([np.frombuffer(r["centroid"], "<f4") for r in rows], axis=1)
    return Model(idf, [r["lang"] for r in rows], np.ascontiguousarray(centroids), np.array([r["least"] for r in rows]))


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns plus ``lang_pred``, ``score`` and ``rejected``."""
    def judge(batches):
        for batch in batches:
            langs, scores, rejected = zip(*map(model.judge, batch.column(batch.num_columns - 1).to_pylist())) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                [*keep, "lang_pred", "score", "rejected"])

    kept = docs.select(*keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(judge, f"{schema}, lang_pred string, score double, rejected boolean")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    train = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    out = predict(docs, fit(train))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
