"""Operator 13, hard-negative mining by integer inner products, filtered by angular triangles.

Every vector stores its norm and its angles to ``REFERENCES`` fixed directions. For an anchor
and a vector the triangle inequality bounds their angle from both sides, through each
reference; cosine and norms turn that into a score interval, widened against rounding.
Vectors lie in blocks of ``BLOCK`` that are sorted by nearest reference and angle, with ranges
of angles and norms, so whole blocks are tested first, then pairs. Only pairs whose interval
overlaps a window that can still enter a result are scored, in exact integers.

Positives: the ``positives`` best other rows of the anchor's label. Negatives: for each anchor
and positive the ``k`` best rows of other labels with ``low`` to ``high`` percent of the
positive's score. Anchors are asked in blocks of about ``ANCHORS``, the only thing that is sent
to all tasks; references are fitted on the ``SAMPLE`` rows of smallest hash, which shapes
bounds, not results. Each task keeps its best rows per anchor, which are then ranked together.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take
no part; missing components of shorter vectors count as zero, empty vectors as zero vectors
(their scores are zero); a null ``vec_id`` is no anchor and ranks after all ids (the largest
bigint stands for it); repeated rows are rows of their own, each an anchor where its id says
so; an anchor without positives, or without rows in a window, gives no rows there; extra
columns are not read; scores beyond 62 bits raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkplate.llm.common import materialise

REFERENCES = 16
SAMPLE = 2048
BLOCK = 256
ANCHORS = 1024
BIG = 2**63 - 1
#: Rounding of arccos and cos: wider than their error in doubles.
SLACK = 1e-6


def prepared(vectors: DataFrame) -> DataFrame:
    """(id, label, comps): rows that take part, with their final label and integer components."""
    x = F.col("embedding")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    label = F.col("label").cast("bigint")
    return vectors.where(F.col("label").isNotNull() & x.isNotNull() & whole).select(
        F.coalesce(F.col("vec_id").cast("bigint"), F.lit(BIG)).alias("id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * 256).cast("bigint")).alias("comps"))


def references(sample: np.ndarray, k: int = REFERENCES) -> np.ndarray:
    """Unit directions: spherical k-means from far-apart starts."""
    norm = np.linalg.norm(sample, axis=1)
    unit = sample[norm > 0] / norm[norm > 0, None]
    if not len(unit):
        return np.eye(1, sample.shape[1] or 1)
    chosen = [unit[0]]
    near = unit @ unit[0]
    while len(chosen) < min(k, len(unit)):
        chosen.append(unit[np.argmin(near)])
        near = np.maximum(near, unit @ chosen[-1])
    refs = np.array(chosen)
    for _ in range(5):
        owner = np.argmax(unit @ refs.T, axis=1)
        sums = np.array([unit[owner == i].sum(axis=0) for i in range(len(refs))])
        size = np.linalg.norm(sums, axis=1)
        refs[size > 0] = sums[size > 0] / size[size > 0, None]
    return refs


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column as rows of ``dims`` integers, short lists padded by zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    if out.size and (np.maximum.reduce(np.abs(out).astype(float), axis=None)) ** 2 * dims > 2**62:
        raise ValueError("components are too large: a score would not fit into 62 bits")
    return out


def measure(vectors: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms and angles to the references; a zero vector is at right angles to all."""
    norm = np.linalg.norm(vectors.astype(float), axis=1)
    cosine = vectors @ refs.T / np.maximum(norm, 1e-300)[:, None]
    return norm, np.arccos(np.clip(cosine, -1, 1))


def interval(angles: np.ndarray, norms: np.ndarray, low: np.ndarray, high: np.ndarray,
             least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score bounds of anchors (rows) against targets (columns).

    A target has angles ``low`` to ``high`` (targets x references) and norms ``least`` to
    ``most``: a block has ranges, a single vector twice the same values."""
    near = np.zeros((len(angles), len(low)))
    far = np.full((len(angles), len(low)), np.pi)
    for r in range(angles.shape[1]):
        a = angles[:, r, None]
        np.maximum(near, np.maximum(a - high[:, r], low[:, r] - a), out=near)
        np.minimum(far, np.minimum(a + high[:, r], 2 * np.pi - a - low[:, r]), out=far)
    top, bottom = np.cos(np.maximum(near - SLACK, 0)), np.cos(np.minimum(far + SLACK, np.pi))
    upper = norms[:, None] * np.where(top > 0, most, least) * top
    lower = norms[:, None] * np.where(bottom < 0, most, least) * bottom
    return lower - np.abs(lower) * 1e-9 - 1, upper + np.abs(upper) * 1e-9 + 1


def scores(anchors: np.ndarray, block: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Exact inner products of the marked (anchor, row) pairs, in row-major order."""
    rows, cols = np.flatnonzero(pairs.any(axis=1)), np.flatnonzero(pairs.any(axis=0))
    a, b = anchors[rows], block[cols]
    size = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if size < 2**53:  # doubles are exact here, and fast
        got = (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    else:
        got = a @ b.T
    return got[pairs[np.ix_(rows, cols)]]


class Best:
    """The ``k`` best (score, id, row) of each slot, by score, then id, then row."""

    def __init__(self, slots: int, k: int):
        self.k, self.slots = k, slots
        self.held = [np.empty(0, np.int64) for _ in range(4)]  # slot, score, id, row
        self.least = np.full(slots, -np.inf)  # scores below a slot's cannot enter it

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        if not len(slot):
            return
        self.held = [np.concatenate([a, b]) for a, b in zip(self.held, (slot, score, ids, row))]
        slot, score, ids, row = self.held
        order = np.lexsort((row, ids, -score, slot))
        slot = slot[order]
        start = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        rank = np.arange(len(slot)) - np.repeat(start, np.diff(np.r_[start, len(slot)]))
        order, full = order[rank < self.k], rank == self.k - 1
        self.least[slot[full]] = score[np.lexsort((row, ids, -score, self.held[0]))[full]]
        self.held = [x[order] for x in self.held]

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in self.held], ["slot", "score", "id", "row"])


FOUND = "slot bigint, score bigint, id bigint, row bigint"


def build_index(rows: DataFrame, refs: np.ndarray, dims: int, block: int = BLOCK) -> DataFrame:
    """The stored blocks: vectors with norms and angles, sorted by nearest reference and angle."""
    def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            norm, angle = measure(matrix(b.column(3), dims), refs)
            near = np.argmin(angle, axis=1)
            ends = pa.array(np.arange(len(norm) + 1) * len(refs), pa.int32())
            yield pa.RecordBatch.from_arrays([
                *b.columns, pa.array(norm), pa.ListArray.from_arrays(ends, pa.array(angle.ravel())), pa.array(near, pa.int32()),
                pa.array(angle[np.arange(len(norm)), near])], [*b.schema.names, "norm", "angles", "near", "angle"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, block):
                part = b.slice(a, block)
                lists = [pa.array([part.column(c).to_numpy(zero_copy_only=False)], pa.list_(kind))
                         for c, kind in ((0, pa.int64()), (1, pa.int64()), (2, pa.int64()))]
                comps = pa.array([matrix(part.column(3), dims).ravel()], pa.list_(pa.int64()))
                rest = [pa.array([part.column(4).to_numpy()], pa.list_(pa.float64())),
                        pa.array([part.column(5).flatten().to_numpy(zero_copy_only=False)], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*lists, comps, *rest], ["row", "id", "label", "comps", "norm", "angles"])

    measured = rows.select("row", "id", "label", "comps").mapInArrow(
        angles, "row bigint, id bigint, label bigint, comps array<bigint>, norm double, angles array<double>, near int, angle double")
    return measured.repartitionByRange("near", "angle", "row").sortWithinPartitions("near", "angle", "row").mapInArrow(
        pack, "row array<bigint>, id array<bigint>, label array<bigint>, comps array<bigint>, norm array<double>, angles array<double>")


def blocks_of(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple]:
    """(row, id, label, vectors, norms, angles) of each stored block."""
    for b in batches:
        for r in range(b.num_rows):
            row, ids, label, comps, norm, angle = (b.column(c)[r].values.to_numpy() for c in range(6))
            yield row, ids, label, comps.reshape(len(row), dims), norm, angle.reshape(len(row), -1)


def find_positives(index: DataFrame, anchors: dict, dims: int, k: int) -> DataFrame:
    """Each task's ``k`` best other rows of every anchor's label; slot = place of the anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(anchors["row"]), k)
        for row, ids, label, vectors, norm, angle in blocks_of(batches, dims):
            alike = np.isin(anchors["label"], label)
            _, most = interval(anchors["angles"], anchors["norm"], angle.min(axis=0)[None], angle.max(axis=0)[None],
                               norm.min()[None], norm.max()[None])
            active = np.flatnonzero(alike & (most[:, 0] >= best.least))
            if not len(active):
                continue
            _, upper = interval(anchors["angles"][active], anchors["norm"][active], angle, angle, norm, norm)
            pairs = ((anchors["label"][active][:, None] == label) & (anchors["row"][active][:, None] != row)
                     & (upper >= best.least[active][:, None]))
            a, b = np.nonzero(pairs)
            best.add(active[a], scores(anchors["vectors"][active], vectors, pairs), ids[b], row[b])
        yield best.batch()

    return index.mapInArrow(run, FOUND)


def find_negatives(index: DataFrame, anchors: dict, windows: np.ndarray, dims: int, k: int) -> DataFrame:
    """Each task's ``k`` best rows of other labels in every window; ``windows``: rows of (anchor, low, high)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(windows), k)
        owner, low, high = windows.T
        for row, ids, label, vectors, norm, angle in blocks_of(batches, dims):
            need = np.maximum(low, best.least)
            least, most = interval(anchors["angles"], anchors["norm"], angle.min(axis=0)[None], angle.max(axis=0)[None],
                                   norm.min()[None], norm.max()[None])
            live = np.flatnonzero((most[owner, 0] >= need) & (least[owner, 0] <= high))
            active = np.unique(owner[live])
            if not len(active):
                continue
            lower, upper = interval(anchors["angles"][active], anchors["norm"][active], angle, angle, norm, norm)
            other = anchors["label"][active][:, None] != label
            at = np.searchsorted(active, owner[live])
            pairs = np.zeros(other.shape, bool)
            turn = np.arange(len(live)) - np.searchsorted(at, at)  # windows lie sorted by anchor
            for t in range(turn.max() + 1):
                w, a = live[turn == t], at[turn == t]
                pairs[a] |= other[a] & (upper[a] >= need[w][:, None]) & (lower[a] <= high[w][:, None])
            a, b = np.nonzero(pairs)
            got = scores(anchors["vectors"][active], vectors, pairs)
            for t in range(turn.max() + 1):
                window = np.full(len(active), -1)
                window[at[turn == t]] = live[turn == t]
                w = window[a]
                good = (w >= 0) & (got >= low[w]) & (got <= high[w]) & (got >= best.least[w])
                best.add(w[good], got[good], ids[b[good]], row[b[good]])
        yield best.batch()

    return index.mapInArrow(run, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("slot").orderBy(F.col("score").desc(), F.col("id"), F.col("row"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _ask(index: DataFrame, part: list, refs: np.ndarray, dims: int, positives: int, k: int, low: int, high: int) -> DataFrame:
    spark = index.sparkSession
    vectors = np.zeros((len(part), dims), np.int64)
    for i, r in enumerate(part):
        vectors[i, :len(r["comps"])] = r["comps"]
    norm, angles = measure(vectors, refs)
    anchors = {"vectors": vectors, "norm": norm, "angles": angles, "row": np.array([r["row"] for r in part], np.int64),
               "label": np.array([r["label"] for r in part], np.int64)}
    chosen = _ranked(find_positives(index, anchors, dims, positives), positives)
    pairs, windows = [], []
    for r in chosen.orderBy("slot", "rank").toLocalIterator():  # at most `positives` rows for each asked anchor
        least, most = -(-low * r["score"] // 100), high * r["score"] // 100
        if least <= most:
            pairs.append((len(pairs), part[r["slot"]]["id"], r["id"], r["score"]))
            windows.append((r["slot"], least, most))
    names = spark.createDataFrame(pairs, "slot bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
    found = _ranked(find_negatives(index, anchors, np.array(windows, np.int64).reshape(-1, 3), dims, k), k)

    def shown(c):
        return F.when(F.col(c) < BIG, F.col(c))
    return found.join(F.broadcast(names), "slot").select(
        "anchor_id", shown("positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        shown("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def mine(rows: DataFrame, is_anchor, positives: int = 5, k: int = 10, low: int = 30, high: int = 90,
         anchors: int = ANCHORS, block: int = BLOCK) -> DataFrame:
    """Hard negatives of the ``prepared`` rows for which ``is_anchor`` (a column over id, label) holds."""
    spark = rows.sparkSession
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    dims = rows.agg(F.max(F.size("comps"))).first()[0] or 0
    asked = rows.where(is_anchor)
    parts = -(-asked.count() // anchors)
    if not parts:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                         "positive_score bigint, negative_score bigint")
    sample = rows.orderBy(F.xxhash64("comps"), "row").limit(SAMPLE).select("comps").collect()  # SAMPLE rows
    points = np.zeros((len(sample), max(1, dims)))
    for i, r in enumerate(sample):
        points[i, :len(r["comps"])] = r["comps"]
    refs, dims = references(points), max(1, dims)
    index = materialise(build_index(rows, refs, dims, block), "negatives-index")
    out = None
    for p in range(parts):
        # about `anchors` rows reach the driver and the tasks at once
        part = list(asked.where(F.pmod(F.xxhash64("row"), F.lit(parts)) == p).orderBy("id", "row").toLocalIterator())
        if part:
            got = _ask(index, part, refs, dims, positives, k, low, high)
            got = materialise(got, "negatives-found") if parts > 1 else got
            out = got if out is None else out.unionByName(got)
    return out


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose ``vec_id`` is divisible by 100."""
    rows = prepared(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return mine(rows, (F.col("id") % 100 == 0) & (F.col("id") < BIG))


ORACLE_SQL = """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, a.label AS la, b.r AS br, b.vec_id AS id, b.label AS lb,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, id, br) AS k FROM s WHERE la = lb) WHERE k <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.ar, p.br ORDER BY s.score DESC, s.id, s.br) AS INTEGER) AS rank
  FROM p JOIN s ON p.ar = s.ar AND s.la <> s.lb AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
