"""Exact top-n items per user by inner product (M7, O5): boxes of like items, searched by bounds.

Items lie in slices of at most ``WIDE`` blocks of ``BLOCK`` neighbours each. Within a slice their factors, cut at quantiles
of each dimension, are ordered along a Z-order curve. The least and the greatest value of each dimension in a block and its
greatest length bound the score of any user with any of its items (the corner of the box that suits the user's signs, and
Cauchy-Schwarz). Users lie in groups of ``GROUP`` of like direction.

A slice is bounded in bytes and handed to all tasks; users never move to the items, so nothing that is shuffled or written
grows with users x items. In a task each user of a group is scored against the block of greatest bound, which
gives a score that the list will reach at least, then against the other blocks whose bound reaches that score, the most
promising first, while the score rises. Each such offer is one matrix product. A slice leaves at most ``n`` rows a user. If there
are several, the longest items come first, and the later slices start from the scores reached there.

Where no user has factors of both signs in a dimension, as with a non-negative model, items that ``n`` others exceed in every
dimension are left out before: a corner (a direction, stretched until only ``n`` items exceed it) shows many of them at once.

Of items with equal factors only the ``n`` of smallest id can enter a list, so a vector shared by
a large share of the items costs n items. Ties go to the smaller item id. A user or item without
factors, and zero factors, score zero; users of zero factors get the smallest ids without a search.
Bounds are widened for rounding, so results equal a full scan in doubles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.accumulators import Accumulator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkplate.operators.ids import global_row_number
from sparkplate.session import cut_lineage

BLOCK = 512
GROUP = 1024
#: Blocks of a slice at most, and bytes of its factors and ids.
WIDE, SLICE_BYTES = 256, 1 << 24
SLACK = 1e-9
#: Dimensions and cuts of each dimension in a Z-order code of at most 60 bits.
CODE_BITS, MOST_BITS = 60, 8
#: Corners of each sweep over the items, and list places that all corners of one may keep.
CORNERS, PLACES = (64, 256, 1024, 4096), 1 << 16
#: Scores of a task that are held at once.
HELD = 1 << 20
FOUND = "user long, item long, score double, rank int"


@dataclass
class TopItems:
    """``rows``: (user, item, score, rank), each user's list. ``scored``: pairs offered to a matrix product, of ``pairs``;
    ``rounds``: those of the users' first blocks and those of the others."""
    rows: DataFrame
    scored: int
    pairs: int
    rounds: list = field(default_factory=list)

    @property
    def share(self) -> float:
        return self.scored / self.pairs if self.pairs else 0.0


def _length(features: Column) -> Column:
    return F.sqrt(F.aggregate(features, F.lit(0.0), lambda acc, x: acc + x * x))


def _rank(df: DataFrame) -> int:
    return df.agg(F.max(F.size(F.coalesce("features", F.array())))).first()[0] or 0


def _padded(df: DataFrame, key: str, rank: int) -> DataFrame:
    """(key, features, length): doubles, with zeros for what is missing of ``rank`` dimensions.
    A vector that holds a null or NaN has no scores, so its row is left out."""
    unknown = F.coalesce(F.exists("features", lambda x: x.isNull() | F.isnan(x.cast("double"))), F.lit(False))
    values = F.array(*[F.coalesce(F.get("features", F.lit(j)).cast("double"), F.lit(0.0)) for j in range(rank)])
    return df.where(~unknown).select(F.col(key).cast("bigint").alias(key), values.alias("features")).withColumn("length", _length(F.col("features")))


def _coded(df: DataFrame, key: str, rank: int, unit: bool) -> DataFrame:
    """Rows with their place ``code`` on a Z-order curve; ``unit``: by direction."""
    dims = min(rank, CODE_BITS)
    bits = max(1, min(MOST_BITS, CODE_BITS // dims))
    scale = F.when(F.col("length") > 0, F.col("length")).otherwise(1.0) if unit else F.lit(1.0)
    shares = [k / 2 ** bits for k in range(1, 2 ** bits)]
    cuts = df.agg(*[F.percentile_approx(F.col("features")[j] / scale, shares, 1000) for j in range(dims)]).first()
    cuts = [np.array(c or [], float) for c in cuts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("features").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, rank)
            if unit:
                length = b.column("length").to_numpy(zero_copy_only=False)
                x = x / np.where(length > 0, length, 1.0)[:, None]
            cells = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)]
            code = np.zeros(b.num_rows, np.int64)
            for bit in reversed(range(bits)):
                for cell in cells:
                    code = code * 2 + (cell >> bit & 1)
            yield b.append_column("code", pa.array(code))

    return df.select(key, "features", "length").mapInArrow(run, f"{key} long, features array<double>, length double, code long")


def _stretches(batch: pa.RecordBatch, sign: np.ndarray, inverse: np.ndarray, most: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, corners x rows): how far a corner's direction goes until an item exceeds it no more in every
    dimension, or (``most``) in none."""
    x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) * sign
    step = max(1, HELD // len(inverse))
    for first in range(0, len(x), step):
        part = x[first:first + step]
        out = part[:, 0] * inverse[:, :1]
        for j in range(1, part.shape[1]):
            (np.maximum if most else np.minimum)(out, part[:, j] * inverse[:, j:j + 1], out=out)
        yield first, out


def _swept(items: DataFrame, sign: np.ndarray, inverse: np.ndarray, margin: float, n: int) -> DataFrame:
    """``items`` without those that ``n`` others exceed, by more than rounding, in every dimension, as far as the corners show."""
    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((len(inverse), n), -np.inf)
        for b in batches:
            for _, far in _stretches(b, sign, inverse, False):
                some = np.flatnonzero((far > best[:, :1]).any(axis=1))
                if len(some):
                    both = np.concatenate([best[some], far[some]], axis=1)
                    best[some] = np.partition(both, both.shape[1] - n, axis=1)[:, both.shape[1] - n:]
        k, j = np.nonzero(best > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(best[k, j])], ["k", "far"])

    far = items.select("features").mapInArrow(reach, "k int, far double").groupBy("k").agg(
        F.get(F.sort_array(F.collect_list("far"), asc=False), F.lit(n - 1)).alias("far"))  # n values a task
    reached = np.full(len(inverse), -np.inf)
    for k, value in far.where("far IS NOT NULL").agg(F.collect_list(F.struct("k", "far"))).first()[0]:  # a number a corner
        reached[k] = value - margin

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.zeros(b.num_rows, bool)
            for first, most in _stretches(b, sign, inverse, True):
                out[first:first + most.shape[1]] = (most < reached[:, None]).any(axis=0)
            yield b.filter(pa.array(~out))

    return cut_lineage(items.mapInArrow(keep, items.schema))


def undominated(items: DataFrame, users: DataFrame, rank: int, n: int, enough: int) -> DataFrame:
    """The padded items without most of those that cannot enter a list of ``n``, in sweeps until ``enough`` are left; all of them
    where users have factors of both signs. Directions are drawn around the items' mean; which they are has no part in the lists."""
    seen = users.where("length > 0").agg(*[f(F.col("features")[j]) for f in (F.min, F.max) for j in range(rank)]).first()
    if seen[0] is None or any(seen[j] < 0 < seen[rank + j] for j in range(rank)):
        return items
    sign = np.array([-1.0 if seen[j] < 0 else 1.0 for j in range(rank)])
    spread = [f(F.col("features")[j]) for f in (F.avg, F.stddev_pop) for j in range(rank)]
    before = None
    for corners in CORNERS:
        left, longest, *stats = items.agg(F.count(F.lit(1)), F.max("length"), *spread).first()
        if left <= enough or corners * n > PLACES or (before and left > 0.95 * before):
            break
        mean, deviation = np.array(stats, float).reshape(2, rank)
        to = mean * sign + deviation * np.random.default_rng(corners).standard_normal((corners, rank))
        to = np.where(to.max(axis=1, keepdims=True) > 0, np.maximum(to, 1e-3 * to.max(axis=1, keepdims=True)), 1.0)
        items, before = _swept(items, sign, to.min(axis=1, keepdims=True) / to, SLACK * longest, n), left
    return items


def index_items(items: DataFrame, rank: int, n: int, size: int) -> tuple[DataFrame, int]:
    """(slice, ids, factors) of padded items, ``size`` to a slice in the order of the curve, and the number of slices."""
    alike = Window.partitionBy("features").orderBy("item")
    kept = cut_lineage(items.withColumn("_copy", F.row_number().over(alike)).where(F.col("_copy") <= n).drop("_copy"))
    slices = -(-kept.count() // size)
    coded = _coded(kept, "item", rank, False)
    if slices > 1:
        placed = global_row_number(coded, [F.col("length").desc(), F.col("item").asc()], "place")
        coded = placed.withColumn("slice", F.floor((F.col("place") - 1) / size).cast("int"))
    else:
        coded = coded.withColumn("slice", F.lit(0))
    rows = coded.groupBy("slice").agg(F.array_sort(F.collect_list(F.struct("code", "item", "features"))).alias("m"))
    return cut_lineage(rows.select("slice", F.col("m.item").alias("ids"), F.flatten("m.features").alias("factors"))), slices


def _flat(column: pa.Array, row: int) -> np.ndarray:
    return column[row].values.to_numpy(zero_copy_only=False)


@dataclass
class _Slice:
    """The blocks of a slice: rows ``starts`` to ``ends`` of ``ids`` and ``factors``, their boxes and greatest lengths."""
    ids: np.ndarray
    factors: np.ndarray
    block: int

    def __post_init__(self) -> None:
        self.starts = np.arange(0, len(self.ids), self.block)
        self.ends = np.r_[self.starts[1:], len(self.ids)]
        self.low, self.high = (f.reduceat(self.factors, self.starts, axis=0) for f in (np.minimum, np.maximum))
        self.top = np.sqrt(np.maximum.reduceat((self.factors ** 2).sum(axis=1), self.starts))

    def bounds(self, u: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Users x blocks: the greatest score of each user in each block, with room for rounding."""
        most = lengths[:, None] * self.top
        return np.minimum(np.maximum(u, 0) @ self.high.T + np.minimum(u, 0) @ self.low.T, most) + SLACK * (1 + most)

    def lists(self, u: np.ndarray, lengths: np.ndarray, least: np.ndarray, n: int, pairs: list[int]) -> tuple:
        """(row of ``u``, item, score, rank): up to ``n`` items of each user that score ``least`` or more; adds the pairs
        scored to ``pairs``: those of the users' first blocks, and the others. The least score rises with each block; for
        lists longer than a block whenever the scores held are ranked."""
        least, found, held = least.copy(), [], 0
        best = np.full((len(u), n), -np.inf) if n <= self.block else None

        def ranked() -> tuple:
            who, ids, score = (np.concatenate([f[j] for f in found]) for j in range(3))
            live = np.flatnonzero(score >= least[who])
            order = live[np.lexsort((ids[live], -score[live], who[live]))]
            who, ids, score = who[order], ids[order], score[order]
            rank = np.arange(len(who)) - np.searchsorted(who, who) + 1
            least[who[rank == n]] = score[rank == n]
            return tuple(x[rank <= n] for x in (who, ids, score, rank))

        def offer(block: int, who: np.ndarray, kind: int) -> None:
            nonlocal found, held
            at = slice(self.starts[block], self.ends[block])
            got = u[who] @ self.factors[at].T
            pairs[kind] += got.size
            some = np.flatnonzero((got >= least[who][:, None]).any(axis=1))
            if not len(some):
                return
            got, who = got[some], who[some]
            if best is not None:
                few = min(n, got.shape[1])
                both = np.concatenate([best[who], np.partition(got, got.shape[1] - few, axis=1)[:, got.shape[1] - few:]], axis=1)
                best[who] = np.partition(both, both.shape[1] - n, axis=1)[:, both.shape[1] - n:]
                least[who] = np.maximum(least[who], best[who, 0])
            a, c = np.nonzero(got >= least[who][:, None])
            found.append((who[a], self.ids[at][c], got[a, c]))
            held += len(a)
            if held > 2 * HELD:
                found = [ranked()[:3]]
                held = len(found[0][0])

        bound = self.bounds(u, lengths)
        first = bound.argmax(axis=1)
        for block in np.unique(first):
            offer(block, np.flatnonzero(first == block), 0)
        for block in np.argsort(-bound.max(axis=0)):
            who = np.flatnonzero((bound[:, block] >= least) & (first != block))
            if len(who):
                offer(block, who, 1)
        return ranked() if found else ()


def _score(pairs: DataFrame, rank: int, n: int, block: int, seen: list[Accumulator]) -> DataFrame:
    """The lists of each group of users in a slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = None, None
        for b in batches:
            for r in range(b.num_rows):
                if (now := b.column("slice")[r].as_py()) != number:
                    number, held = now, _Slice(_flat(b.column("ids"), r).copy(), _flat(b.column("factors"), r).reshape(-1, rank).copy(), block)
                users, least, lengths = (_flat(b.column(c), r) for c in ("users", "least", "lengths"))
                u, step = _flat(b.column("features"), r).reshape(-1, rank), max(1, HELD // n)
                for lo in range(0, len(users), step):
                    scored = [0, 0]
                    found = held.lists(u[lo:lo + step], lengths[lo:lo + step], least[lo:lo + step], n, scored)
                    for total, k in zip(seen, scored):
                        total.add(k)
                    if found:
                        who, ids, score, place = found
                        yield pa.RecordBatch.from_arrays([pa.array(users[lo:lo + step][who]), pa.array(ids), pa.array(score),
                                                          pa.array(place.astype(np.int32))], ["user", "item", "score", "rank"])

    return pairs.select("users", "least", "lengths", "features", "slice", "ids", "factors").mapInArrow(run, FOUND)


def _best(rows: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("user").orderBy(F.col("score").desc(), F.col("item"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def top_items(users: DataFrame, items: DataFrame, n: int = 5, block: int = BLOCK, group: int = GROUP,
              wide: int = WIDE) -> TopItems:
    """The ``n`` items of greatest inner product for every row of ``users`` (user, features), user unique.

    ``items``: (item, features), item unique; ids are integers."""
    spark, rank = users.sparkSession, max(1, _rank(users), _rank(items))
    items, users = cut_lineage(_padded(items, "item", rank)), cut_lineage(_padded(users, "user", rank))
    n_users, n_items = users.count(), items.count()
    out = TopItems(spark.createDataFrame([], FOUND), 0, n_users * n_items)
    if not (n_users and n_items and n > 0):
        return out
    size = max(block, min(block * wide, SLICE_BYTES // (8 * (rank + 1)) // block * block))
    slices, n_slices = index_items(undominated(items, users, rank, n, size), rank, n, size)
    placed = global_row_number(_coded(users.where("length > 0"), "user", rank, True), [F.col("code").asc(), F.col("user").asc()], "place")
    searched = placed.select(F.floor((F.col("place") - 1) / group).cast("int").alias("g"), "user", "features", "length")
    seen = [spark.sparkContext.accumulator(0) for _ in range(2)]

    def groups(rows: DataFrame) -> DataFrame:
        return cut_lineage(
            rows.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("user", "least", "length", "features"))).alias("m"))
            .select(F.col("m.user").alias("users"), F.col("m.least").alias("least"), F.col("m.length").alias("lengths"),
                    F.flatten("m.features").alias("features")))

    def found(offers: DataFrame, number: int) -> DataFrame:
        one = slices.where(F.col("slice") == number)  # a row of bounded size
        return cut_lineage(_score(offers.crossJoin(F.broadcast(one)), rank, n, block, seen))

    lists = found(groups(searched.withColumn("least", F.lit(float("-inf")))), 0)
    if n_slices > 1:
        full = lists.where(F.col("rank") == n).groupBy("user").agg(F.max("score").alias("least"))
        opened = groups(searched.join(full, "user", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf")))))
        for number in range(1, n_slices):
            lists = lists.unionByName(found(opened, number))
    if n_slices > 1 or users.select("user").distinct().count() < n_users:  # rows of a user that comes twice make one list
        lists = cut_lineage(_best(lists, n))
    zero = users.where("length = 0").select("user", "length")
    if not zero.isEmpty():
        lowest = global_row_number(items.orderBy("item").limit(n).select("item", F.lit(0.0).alias("length")), [F.col("item").asc()], "rank")
        lists = lists.unionByName(cut_lineage(zero.join(F.broadcast(lowest), "length").select(  # n rows
            "user", "item", F.lit(0.0).alias("score"), F.col("rank").cast("int").alias("rank"))))
    out.rows = lists
    out.rounds = [total.value for total in seen]
    out.scored = sum(out.rounds)
    return out
