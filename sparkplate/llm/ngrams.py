"""Operator 6, n-gram Jaccard join with count vectors in R-trees.

A document is its set of distinct 5-word shingles, as 64-bit hashes; documents of one set
form a node. Two nodes link when 100 * intersection >= 80 * union. Every link is found:

* Routing. Linked sets share a shingle among the first n - ceil(4 n / 5) + 1 of each, under
  any common order of shingles. The order puts frequent shingles last: a fixed-size table of
  counts over all documents names the hash cells that stand out. Only (shingle, node) pairs
  of that prefix are shuffled, and only shingles met by two nodes go on.
* Stars. In each such group every node is held against the least node alone, so a group of
  copies yields one pair a member. Pairs must pass the size bound and a
  count-vector bound on vectors as fine as the set is large (four to eight shingles a
  class), then their sets are intersected.
* R-trees. Groups whose members still lie in several components are searched whole: group
  counts (shingles per hash class) are points, packed in a tree of boxes, and two boxes or
  points are tried further only if the sum of coordinate minima can reach the overlap that
  their sizes need. Groups are cut into tiles of ``TILE`` members and joined tile by tile,
  so that no task gathers a whole large group. This happens twice: first every member
  proposes only its best partner in another component, which joins up dense groups with one
  pair a member; then all pairs left between components are verified on their sets.

A pair inside one component is not tried again in this search: it cannot change a component.
Components come from minimum labels over the verified links, and are all that ``keep_one``
needs.

``links`` and ``link_counts`` go on to every link. Both ends of one lie in one component, so
the distinct sets of a component are cut into tiles of bounded members and shingles, and each
pair of tiles is searched in one place, whatever was tried before: pairs that pass the size
and count-vector bounds are verified on the sets, which travel with the tiles. A pair of sets
meets in exactly one pair of tiles, so no link is counted twice. Counts leave a tile summed
per node; only ``links`` writes the pairs out.

Defined cases: null or blank text has no shingles and links with nothing; fewer than five
words are one shingle, the whole sequence; a null ``doc_id`` never names a component unless
all of its members lack an id; repeated ids and rows are documents of their own, and link with
each other if they have shingles; extra
columns are not read by ``components``; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkplate.llm.common import documents, materialise
from sparkplate.llm.components import connected_components

WORDS, GROUPS, CELLS, TILE, FAN = 5, 64, 1 << 16, 2048, 16
LINK_TILE, LINK_ITEMS = 1024, 1 << 18  # members and shingles of a tile of a component
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_U = np.uint64
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _FACTORS[0]
    h = (h ^ (h >> _U(29))) * _FACTORS[1]
    return h ^ (h >> _U(32))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles of a text (A-Z lowered)."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(h) < WORDS:
        h = _mix(np.array([(h * _FACTORS[:len(h)]).sum() + _U(len(h))], np.uint64))
        return h
    n = len(h) - WORDS + 1
    total = h[:n] * _FACTORS[0]
    for i in range(1, WORDS):
        total = total + h[i:i + n] * _FACTORS[i]
    return np.unique(_mix(total))


def node_of(s: np.ndarray) -> int | None:
    """64-bit signed name of a shingle set."""
    return xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s)) - (1 << 63) if len(s) else None


def count_vector(s: np.ndarray) -> bytes:
    """Counts over GROUPS classes; two bytes each, where 65535 stands for 65535 or more."""
    return np.minimum(np.bincount((s & _U(GROUPS - 1)).astype(np.int64), minlength=GROUPS), 65535).astype("<u2").tobytes()


def fine_vector(s: np.ndarray) -> bytes:
    """Counts over a power of two of classes, at least GROUPS and about a sixth of the set; one
    byte each, where 255 stands for 255 or more."""
    classes = max(GROUPS, 1 << max(0, (len(s) // 4).bit_length() - 1))
    return np.minimum(np.bincount((s & _U(classes - 1)).astype(np.int64), minlength=classes), 255).astype("u1").tobytes()


def fine_overlap(a: bytes, b: bytes) -> int:
    """An upper bound of the overlap of two sets, from their fine vectors folded to one length."""
    x, y = (np.frombuffer(v, "u1").astype(np.int64) for v in (a, b))
    x, y = (np.where(v == 255, 1 << 30, v) for v in (x, y))
    classes = min(len(x), len(y))
    return int(np.minimum(x.reshape(-1, classes).sum(axis=0), y.reshape(-1, classes).sum(axis=0)).sum())


def _texts(batch: pa.RecordBatch, column: str = "text"):
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def _features(docs: DataFrame) -> DataFrame:
    """(doc_id, dig, n, node, vec, fine) of every document, and a row per task with its ``cells``,
    the counts of its shingles by the leading bits of their hash."""
    names = ["doc_id", "dig", "n", "node", "vec", "fine", "cells"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def measure(batches):
        cells = np.zeros(CELLS, np.int64)
        for batch in batches:
            sets = [shingles(t) for t in _texts(batch)]
            if sets:
                cells += np.bincount((np.concatenate(sets) >> _U(48)).astype(np.int64), minlength=CELLS)
            own = [[len(s) for s in sets], [node_of(s) for s in sets], [count_vector(s) for s in sets],
                   [fine_vector(s) for s in sets], [None] * len(sets)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(c, t) for c, t in zip(own, types[2:]))], names)
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([None] * 6 + [cells.tobytes()], types)], names)

    return docs.mapInArrow(measure, "doc_id bigint, dig bigint, n int, node bigint, vec binary, fine binary, cells binary")


def frequent_cells(features: DataFrame) -> np.ndarray:
    """Hash cells whose count over all documents stands out, as a table of CELLS booleans.

    A cell of ordinary shingles holds the mean, give or take its square root; eight times
    that and 64 more mark a cell with a frequent shingle in it. Only the order of shingles
    depends on it, never a result.
    """
    def spell(batches):
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                cells = np.frombuffer(raw, np.int64)
                at = np.flatnonzero(cells)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(cells[at], pa.int64())], ["cell", "n"])

    rows = (features.where("cells IS NOT NULL").select("cells").mapInArrow(spell, "cell int, n bigint")
            .groupBy("cell").agg(F.sum("n").alias("n")).collect())
    n = np.zeros(CELLS, np.int64)
    for r in rows:  # at most CELLS rows
        n[r["cell"]] = r["n"]
    return n > n.mean() + 8 * np.sqrt(n.mean()) + 64


def _prefixes(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(key, node, n): the routing prefix of every node."""
    packed = np.packbits(frequent).tobytes()

    def route(batches):
        often = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        seen: set[int] = set()
        for batch in batches:
            keys, nodes, sizes = [], [], []
            for text in _texts(batch):
                s = shingles(text)
                node = node_of(s)
                if node is None or node in seen:
                    continue
                seen.add(node)
                n = len(s)
                k = n - (4 * n + 4) // 5 + 1
                late = often[(s >> _U(48)).astype(np.int64)]
                rare = s[~late][:k]
                keys.append(np.concatenate([rare, s[late][:k - len(rare)]]).view(np.int64))
                nodes.append(np.full(k, node, np.int64))
                sizes.append(np.full(k, n, np.int32))
            if len(seen) > 500_000:
                seen.clear()
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (keys, nodes, sizes)], ["key", "node", "n"])

    return docs.select("text").mapInArrow(route, "key bigint, node bigint, n int")


# --- count-vector bounds and trees -----------------------------------------------------

def can_link(n_a, n_b, overlap) -> np.ndarray:
    """Whether sets of these sizes can link when they share at most ``overlap``."""
    return (5 * np.minimum(n_a, n_b) >= 4 * np.maximum(n_a, n_b)) & (9 * overlap >= 4 * (n_a + n_b))


def pair_bound(vec: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of coordinate minima per pair, in slices of bounded memory."""
    out = np.empty(len(a), np.int64)
    for i in range(0, len(a), 1 << 16):
        s = slice(i, i + (1 << 16))
        out[s] = np.minimum(vec[a[s]], vec[b[s]]).sum(axis=1, dtype=np.int64)
    return out


class CountTree:
    """A packed R-tree over count vectors: an order of the points and levels of boxes.

    Points are ordered by halving along the coordinate of widest spread; each level groups
    FAN neighbours of the one below. A box keeps the greatest count per coordinate and the
    range of sizes, which is all that the overlap bound needs.
    """

    def __init__(self, vec: np.ndarray, n: np.ndarray):
        self.order = self._arrange(vec, n)
        vec, n = vec[self.order], n[self.order]
        self.levels = [(vec, n, n)]
        while len(self.levels[-1][0]) > 1:
            top, low, high = self.levels[-1]
            cuts = np.arange(0, len(top), FAN)
            self.levels.append((np.maximum.reduceat(top, cuts), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)))

    @staticmethod
    def _arrange(vec: np.ndarray, n: np.ndarray) -> np.ndarray:
        points = np.concatenate([n[:, None], vec.astype(np.int64)], axis=1)
        done, todo = [], [np.arange(len(n))]
        while todo:
            part = todo.pop()
            if len(part) <= FAN:
                done.append(part)
                continue
            p = points[part]
            axis = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
            half = len(part) // (2 * FAN) * FAN or FAN
            split = np.argpartition(p[:, axis], half)
            todo += [part[split[half:]], part[split[:half]]]
        return np.concatenate(done)


def tree_join(one: CountTree, two: CountTree) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (in the input order) of point pairs whose bounds allow a link."""
    depth = max(len(one.levels), len(two.levels)) - 1
    a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
    found_a, found_b = [], []
    stack = [(depth, a, b)]
    while stack:
        level, a, b = stack.pop()
        if len(a) > 1 << 16:  # wide fronts go in parts, to bound memory
            half = len(a) // 2
            stack += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
            continue
        la, lb = min(level, len(one.levels) - 1), min(level, len(two.levels) - 1)
        top_a, low_a, high_a = (x[a] for x in one.levels[la])
        top_b, low_b, high_b = (x[b] for x in two.levels[lb])
        most = np.minimum(top_a, top_b).sum(axis=1, dtype=np.int64)
        fits = (5 * high_a >= 4 * low_b) & (5 * high_b >= 4 * low_a) & (9 * most >= 4 * (low_a + low_b))
        a, b = a[fits], b[fits]
        if not len(a):
            continue
        if level == 0:
            found_a.append(one.order[a])
            found_b.append(two.order[b])
            continue
        for own, other, tree, here in ((0, 1, one, la), (1, 0, two, lb)):
            if here == level:  # this side goes down a level
                count = len(tree.levels[level - 1][0])
                kids = (a, b)[own][:, None] * FAN + np.arange(FAN)
                near = np.repeat((a, b)[other], FAN).reshape(kids.shape)
                ok = kids < count
                a, b = (kids[ok], near[ok]) if own == 0 else (near[ok], kids[ok])
        stack.append((level - 1, a, b))
    none = np.zeros(0, np.int64)
    return np.concatenate(found_a or [none]), np.concatenate(found_b or [none])


def _vectors(column) -> np.ndarray:
    """Count vectors as rows; a clipped count stands for any, so that bounds stay bounds."""
    vec = np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, GROUPS)
    clipped = vec == 65535
    return np.where(clipped, np.uint32(1 << 30), vec.astype(np.uint32)) if clipped.any() else vec


def _tile_pairs(tile, side, comp, n, vec):
    """Numbers (a, b, overlap bound) of the row pairs of a tile, or of two, that lie in
    different components and may link; without ``comp``, of all that may link, each once."""
    order = np.lexsort((side, tile))
    cuts = np.flatnonzero(np.concatenate([[True], tile[order][1:] != tile[order][:-1]]))
    ends = np.concatenate([cuts[1:], [len(order)]])
    found = []
    small = (ends - cuts <= 2 * FAN) & (side[order[cuts]] == 2)
    for size in np.unique((ends - cuts)[small]).tolist():  # little groups of one size at once
        i, j = np.triu_indices(size, 1)
        for at in np.array_split(cuts[small & (ends - cuts == size)], max(1, small.sum() * len(i) >> 20)):
            found.append((order[at[:, None] + i].ravel(), order[at[:, None] + j].ravel()))
    for a, b in zip(cuts[~small], ends[~small]):
        part = order[a:b]
        left, right = part[side[part] != 1], part[side[part] != 0]
        if len(left) and len(right):
            one = CountTree(vec[left], n[left])
            two = one if side[part[0]] == 2 else CountTree(vec[right], n[right])
            x, y = tree_join(one, two)
            if comp is None and one is two:
                x, y = x[x < y], y[x < y]
            found.append((left[x], right[y]))
    for a, b in found:
        new = (True if comp is None else comp[a] != comp[b]) & (5 * np.minimum(n[a], n[b]) >= 4 * np.maximum(n[a], n[b]))
        a, b = a[new], b[new]
        most = pair_bound(vec, a, b)
        ok = can_link(n[a], n[b], most)
        yield a[ok], b[ok], most[ok]


def _search_tiles(rows: DataFrame, best: bool) -> DataFrame:
    """(a, b): bounded pairs in different components, from rows (tile, side, node, comp, n, vec);
    with ``best`` the one of highest bound for each node, else all.

    ``side`` 0 and 1 are the two tiles of a pair, 2 marks a tile joined with itself.
    """
    def search(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        t = pa.Table.from_batches(batches)
        tile, side, node, comp, n = (t.column(c).to_numpy() for c in ("tile", "side", "node", "comp", "n"))
        n, vec = n.astype(np.int64), np.concatenate([_vectors(c) for c in t.column("vec").chunks])
        for a, b, most in _tile_pairs(tile, side, comp, n, vec):
            if best:
                score = most / (n[a] + n[b] - most)
                own, mate, score = np.concatenate([node[a], node[b]]), np.concatenate([node[b], node[a]]), np.concatenate([score, score])
                order = np.lexsort((mate, -score, own))
                order = order[np.concatenate([[True], own[order][1:] != own[order][:-1]])[:len(order)]]
                pairs, score = np.stack([own[order], mate[order]], axis=1), score[order]
            else:
                pairs = np.unique(np.sort(np.stack([node[a], node[b]], axis=1), axis=1), axis=0)
                score = np.zeros(len(pairs))
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(score)], ["a", "b", "score"])

    pairs = rows.repartition("tile").mapInArrow(search, "a bigint, b bigint, score double")
    if best:
        pairs = pairs.groupBy("a").agg(F.max_by("b", F.struct("score", "b")).alias("b"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _open_tiles(routed: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """The members of groups that still hold several components, cut into pairs of tiles."""
    same = Window.partitionBy("key")
    placed = (routed.select("key", "node", "n").distinct().join(labels, "node", "left")
              .select("key", "node", "n", F.coalesce("comp", "node").alias("comp")))
    groups = (placed.withColumn("least", F.min("comp").over(same)).withColumn("most", F.max("comp").over(same))
              .withColumn("size", F.count("*").over(same)).withColumn("low", F.min("n").over(same))
              .withColumn("high", F.max("n").over(same)).where("least < most")
              .where("size > 2 OR 5 * low >= 4 * high"))
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    mine = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda j: F.struct(
        F.least(j, F.col("mine")).alias("i"), F.greatest(j, F.col("mine")).alias("j")))
    return (groups.withColumn("tiles", tiles).withColumn("mine", mine)
            .select("key", "node", "comp", "mine", F.explode(meets).alias("t"))
            .select(F.xxhash64("key", "t.i", "t.j").alias("tile"), "node", "comp",
                    F.when(F.col("t.i") == F.col("t.j"), 2).when(F.col("mine") == F.col("t.i"), 0).otherwise(1).alias("side"))
            .join(nodes.select("node", "n", "vec"), "node")
            .select("tile", "side", "node", "comp", "n", "vec"))


def _bounded(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and fine vectors allow a link."""
    def keep(batches):
        for batch in batches:
            a, b, n_a, n_b, one, two = (c.to_pylist() for c in batch.columns)
            ok = [i for i in range(len(a)) if can_link(n_a[i], n_b[i], fine_overlap(one[i], two[i]))]
            yield pa.RecordBatch.from_arrays([c.take(pa.array(ok, pa.int64())) for c in batch.columns[:2]], ["a", "b"])

    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("fine").alias("fine_a"))
    two = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("fine").alias("fine_b"))
    return (pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "fine_a", "fine_b")
            .mapInArrow(keep, "a bigint, b bigint"))


# --- verification ----------------------------------------------------------------------

def _sets(docs: DataFrame, heads: DataFrame) -> DataFrame:
    """(node, items): shingle sets of the documents ``heads`` (doc_id, dig, node); texts travel compressed."""
    def shrink(batches):
        small = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            raw = [small.compress((t or "").encode()) for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(raw, pa.binary())], ["doc_id", "dig", "raw"])

    def spell(batches):
        big = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                sets = [shingles(big.decompress(r).decode()) for r in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "items"])

    texts = docs.mapInArrow(shrink, "doc_id bigint, dig bigint, raw binary")
    # a null id joins as its own value; two rows of one id and text are one head
    same = texts["doc_id"].eqNullSafe(heads["doc_id"]) & (texts["dig"] == heads["dig"])
    return (texts.join(heads, same).select("node", "raw").mapInArrow(spell, "node bigint, items array<bigint>")
            .dropDuplicates(["node"]))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    one = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.select("a", "b").join(two, "b").join(one, "a")
            .withColumn("both", both).where(100 * F.col("both") >= 80 * (F.size("x") + F.size("y") - F.col("both")))
            .select("a", "b"))


# --- all links of a component ----------------------------------------------------------

def _whole_tiles(batches):
    """Tables of whole tiles, from batches sorted by ``tile``."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        tile = batch.column(0).to_numpy()
        cut = int(np.searchsorted(tile, tile[-1]))
        if held and (cut or held[-1].column(0)[-1].as_py() != tile[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def overlaps(codes: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact overlap of the sets numbered ``a`` and ``b``; set i is ``codes[ends[i]:ends[i + 1]]``,
    numbers from 0, and none is empty."""
    out = np.zeros(len(a), np.int64)
    if not len(a):
        return out
    mark = np.zeros(codes.max() + 1, np.uint8)
    order = np.lexsort((b, a))
    cuts = np.flatnonzero(np.concatenate([[True], a[order][1:] != a[order][:-1], [True]]))
    for low, high in zip(cuts[:-1], cuts[1:]):
        mine = order[low:high]
        own, mates = a[mine[0]], b[mine]
        mark[codes[ends[own]:ends[own + 1]]] = 1
        first, last = mates[0], mates[-1] + 1
        if last - first <= 2 * len(mates):  # mostly neighbours: one pass over the stretch
            seen = mark[codes[ends[first]:ends[last]]]
            out[mine] = np.add.reduceat(seen, ends[first:last] - ends[first], dtype=np.int64)[mates - first]
        else:
            for i in range(0, len(mates), 256):
                size = ends[mates[i:i + 256] + 1] - ends[mates[i:i + 256]]
                at = np.cumsum(size) - size
                place = np.repeat(ends[mates[i:i + 256]] - at, size) + np.arange(size.sum())
                out[mine[i:i + 256]] = np.add.reduceat(mark[codes[place]], at, dtype=np.int64)
        mark[codes[ends[own]:ends[own + 1]]] = 0
    return out


def _link_tiles(nodes: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """(tile, side, node, n, copies, vec, items): the components in pairs of tiles, as ``_open_tiles``."""
    sizes = (labels.join(nodes.select("node", "n"), "node").groupBy("comp")
             .agg(F.count("*").alias("size"), F.sum("n").alias("all")))
    tiles = F.greatest(F.ceil(F.col("size") / LINK_TILE), F.ceil(F.col("all") / LINK_ITEMS)).cast("int")
    placed = (labels.join(sizes.select("comp", tiles.alias("tiles")), "comp")
              .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")))
    meets = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda j: F.struct(
        F.least(j, F.col("mine")).alias("i"), F.greatest(j, F.col("mine")).alias("j")))
    full = (placed.join(nodes.select("node", "n", "copies", "vec"), "node").join(sets, "node")
            .select("comp", "node", "n", "copies", "vec", "items", "mine", F.explode(meets).alias("t")))
    # named by its three parts: two tiles of one hash would lend each other their members
    return full.select(F.struct("comp", "t.i", "t.j").alias("tile"),
                       F.when(F.col("t.i") == F.col("t.j"), 2).when(F.col("mine") == F.col("t.i"), 0).otherwise(1).alias("side"),
                       "node", "n", "copies", "vec", "items")


def _search_links(rows: DataFrame, count: bool) -> DataFrame:
    """Every link between the distinct sets of ``_link_tiles``: pairs (a, b), a < b; with
    ``count`` (node, others), for each node the documents that it links with."""
    names = ["node", "others"] if count else ["a", "b"]

    def search(batches):
        for t in _whole_tiles(batches):
            side, node, n, copies = (t.column(c).to_numpy() for c in ("side", "node", "n", "copies"))
            n, vec = n.astype(np.int64), np.concatenate([_vectors(c) for c in t.column("vec").chunks])
            parts = [t.column(c).to_numpy() for c in ("comp", "i", "j")]
            new = np.zeros(len(n), bool)
            for p in parts:
                new[1:] |= p[1:] != p[:-1]
            codes = np.unique(np.concatenate([c.flatten().to_numpy() for c in t.column("items").chunks]), return_inverse=True)[1]
            ends = np.concatenate([[0], np.cumsum(n)])
            total = np.zeros(len(n), np.int64)
            for a, b, _ in _tile_pairs(np.cumsum(new), side, None, n, vec):
                both = overlaps(codes, ends, a, b)
                ok = 100 * both >= 80 * (n[a] + n[b] - both)
                a, b = a[ok], b[ok]
                if count:
                    np.add.at(total, a, copies[b])
                    np.add.at(total, b, copies[a])
                elif len(a):
                    x, y = node[a], node[b]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names)
            if total.any():
                yield pa.RecordBatch.from_arrays([pa.array(node[total > 0]), pa.array(total[total > 0])], names)

    own = rows.select(F.xxhash64("tile").alias("place"), "tile.*", "side", "node", "n", "copies", "vec", "items")
    # whole tiles, in order; batches are cut where the hash of a tile changes
    own = own.repartition("place").sortWithinPartitions("place", "comp", "i", "j")
    found = own.mapInArrow(search, f"{names[0]} bigint, {names[1]} bigint")
    return found.groupBy("node").agg(F.sum("others").alias("others")) if count else found


# --- the join --------------------------------------------------------------------------

def _joined(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(table, nodes, labels, sets): every document with its node, the distinct nodes, the
    components of those with a link and their sets."""
    own = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("dig"), "text")
    features = materialise(_features(own), "features")
    table = features.where("cells IS NULL").drop("cells")
    nodes = materialise(table.where("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("_order"), "doc_id", "dig")).alias("head"),
        F.first("n").alias("n"), F.first("vec").alias("vec"), F.first("fine").alias("fine"), F.count("*").alias("copies"))
        .select("node", "n", "vec", "fine", "copies", "head.doc_id", "head.dig"), "nodes")

    same = Window.partitionBy("key")
    routed = (_prefixes(own, frequent_cells(features))
              .withColumn("pivot", F.min(F.struct("node", "n")).over(same)).withColumn("last", F.max("node").over(same))
              .where(F.col("pivot.node") < F.col("last"))
              .select("key", "node", "n", F.col("pivot.node").alias("pivot"), F.col("pivot.n").alias("pivot_n")))
    routed = materialise(routed, "routed")
    near = (5 * F.least("n", "pivot_n") >= 4 * F.greatest("n", "pivot_n")) & (F.col("node") != F.col("pivot"))
    stars = routed.where(near).select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    stars = materialise(_bounded(stars, nodes), "stars")
    links, tried = None, None
    known, sets = None, None
    for step in ("stars", "best", "all"):
        if step == "stars":
            pairs = stars
        else:
            pairs = _search_tiles(_open_tiles(routed, labels, nodes), step == "best").join(tried, ["a", "b"], "left_anti")
            pairs = materialise(_bounded(pairs, nodes), "pairs")
        heads = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        if known is not None:
            heads = heads.join(known, "node", "left_anti")
        heads = materialise(heads, "heads")
        more = materialise(_sets(own, nodes.select("doc_id", "dig", "node").join(heads, "node")), "sets")
        known, sets = (heads, more) if known is None else (known.union(heads), sets.union(more))
        found = materialise(_verified(pairs, sets), "links")
        links = found if links is None else links.unionByName(found)
        tried = pairs if tried is None else tried.unionByName(pairs)
        labels = connected_components(links)
    return table, nodes, labels, sets


def _named(table: DataFrame, labels: DataFrame, *more: str) -> DataFrame:
    table = table.join(labels, "node", "left").select("doc_id", "dig", "n", "node", F.coalesce("comp", "node").alias("root"), *more)
    least = materialise(table.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id")), "roots")
    return (table.join(least, "root", "left")
            .select("doc_id", "dig", "n", "node", "root", F.when(F.col("root").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id"), *more))


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, dig, n, node, root, component_id) of every document.

    ``dig`` is the 64-bit digest of the text, ``root`` the least node of the component
    (null without shingles).
    """
    table, _, labels, _ = _joined(docs)
    return _named(table, labels)


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``components``, and every link (a, b) between two distinct nodes, a < b.
    Documents of one node link with each other too; they are not written out as pairs."""
    table, nodes, labels, sets = _joined(docs)
    return _named(table, labels), materialise(_search_links(_link_tiles(nodes, labels, sets), False), "all-links")


def link_counts(docs: DataFrame) -> DataFrame:
    """The rows of ``components`` with ``n_links``, the number of other documents that each
    document links with."""
    table, nodes, labels, sets = _joined(docs)
    others = _search_links(_link_tiles(nodes, labels, sets), True)
    known = materialise(nodes.select("node", "copies").join(labels, "node", "left").join(others, "node", "left")
                        .select("node", "comp", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "counts")
    return _named(table, known, "n_links").withColumn("n_links", F.coalesce("n_links", F.lit(0)))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component (the smallest id), and every document without shingles."""
    found = components(docs)
    chosen = (found.where("root IS NOT NULL AND doc_id <=> component_id").groupBy("root", "doc_id").agg(F.min("dig").alias("dig"))
              .select("doc_id", "dig").unionByName(found.where("root IS NULL").select("doc_id", "dig")).distinct())
    chosen = materialise(chosen, "chosen").select(F.col("doc_id").alias("_id"), F.col("dig").alias("_d"))
    named = docs.withColumn("_dig", F.xxhash64(F.coalesce("text", F.lit(""))))
    kept = named.join(chosen, named["doc_id"].eqNullSafe(F.col("_id")) & (F.col("_dig") == F.col("_d")), "left_semi")
    return kept.dropDuplicates(["doc_id", "_dig"]).select(*docs.columns)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_counts(documents(spark, sf_dir)).select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id", "n_links")
