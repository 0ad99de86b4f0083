"""Operator 11, sharding by balanced label propagation.

Linked documents share a key (here: equal texts). Labels are shards. They start evenly dealt;
in every round each key looks at the shards of its members and proposes the fullest ones, as
many as its members need; members outside ask to move there. Moves are granted under quotas, from
the number of requests by (from, to): no shard takes in more than its room and what leaves it,
so none ever holds more linked documents than its capacity. It ends when nothing moves or after
``rounds``. Documents without links cut none, so they fill the shards to their
exact sizes (law ``rows``: counts at most one apart). A group larger than a shard is spread over
as few shards as quotas allow.

Every round joins and groups written tables; a key's members meet only as counts per (key,
shard), summed in each task first, so a key may hold any share of the rows. The driver sees
counts per shard, pair of shards and slice.

Defined cases: a null text has no bytes and equals an empty one; null and repeated ``doc_id``
are documents of their own, repeated rows included; fewer documents than shards leave shards
empty; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkplate.llm.common import documents, materialise
from sparkplate.operators.ids import global_row_number

#: A key is small when a shard holds so many of its size.
SMALL = 16


def even_sizes(n: int, shards: int) -> np.ndarray:
    """Counts at most one apart."""
    return np.array([n // shards + (s < n % shards) for s in range(shards)], np.int64)


def _walk(left: np.ndarray) -> tuple[list[int], list[int]]:
    """A cycle of the positive entries of ``left`` (f, t), or else none; and the nodes in order of leaving."""
    colour, leaving = [0] * len(left), []
    for root in range(len(left)):
        if colour[root]:
            continue
        path, ways = [root], [iter(np.flatnonzero(left[root]).tolist())]
        colour[root] = 1
        while path:
            t = next(ways[-1], None)
            if t is None:
                colour[path[-1]] = 2
                leaving.append(path.pop())
                ways.pop()
            elif colour[t] == 1:
                return path[path.index(t):], leaving
            elif not colour[t]:
                colour[t] = 1
                path.append(t)
                ways.append(iter(np.flatnonzero(left[t]).tolist()))
    return [], leaving


def granted(requests: np.ndarray, room: np.ndarray) -> np.ndarray:
    """How many of the requested moves (from, to) are granted, so that no shard outgrows its room.

    Swaps between two shards leave both as they are, and so do moves along a longer cycle. What
    is left has no cycle (beyond ``8 * shards`` cycles the rest waits for the next round); from
    its ends backwards, moves fill the room of a shard and make room in the shards they leave.
    """
    moves = np.minimum(requests, requests.T)
    left, room = requests - moves, room.copy()
    cycle, leaving = _walk(left)
    for _ in range(8 * len(left)):
        if not cycle:
            break
        ends = cycle, cycle[1:] + cycle[:1]
        n = left[ends].min()
        left[ends] -= n
        moves[ends] += n
        cycle, leaving = _walk(left)
    for t in leaving:
        for f in np.argsort(-left[:, t], kind="stable"):
            n = min(left[f, t], room[t])
            if n <= 0:
                break
            moves[f, t] += n
            room[t] -= n
            room[f] += n
    return moves


def _pick(key: Column, salt: Column | int) -> Column:
    return F.xxhash64(key, salt if isinstance(salt, Column) else F.lit(salt))


def proposals(held: DataFrame, capacity: np.ndarray, load: np.ndarray, step: int) -> DataFrame:
    """(key, size, targets): the shards a key proposes to its members.

    ``held``: (key, shard, n). Fullest first, ties by a hash that differs from round to round;
    one shard for a small key, for a large one as many as have space for all its members."""
    space = F.array(*[F.lit(int(x)) for x in capacity - load])
    entry = F.struct((-F.col("n")).alias("less"), _pick(F.col("key"), step + F.col("shard") * 1000).alias("tie"), F.col("shard").alias("shard"))
    keys = held.groupBy("key").agg(F.sum("n").alias("size"), F.array_sort(F.collect_list(entry)).alias("order"))
    start = F.struct(F.lit(0).cast("bigint").alias("space"), F.lit(0).alias("n"))
    need = F.aggregate("order", start, lambda acc, e: F.when(acc["space"] >= F.col("size"), acc).otherwise(F.struct(
        (acc["space"] + F.get(space, e["shard"]) - e["less"]).alias("space"), (acc["n"] + 1).alias("n"))))["n"]
    small = F.col("size") * SMALL <= int(max(capacity))
    return keys.select("key", "size", F.transform(F.slice("order", 1, F.when(small, 1).otherwise(need)), lambda e: e["shard"]).alias("targets"))


def propagate(members: DataFrame, labels: DataFrame, capacity: np.ndarray, rounds: int = 12) -> DataFrame:
    """(node, shard) after label propagation.

    ``members``: (node, key), nodes that share a key are linked; ``labels``: (node, shard), within
    ``capacity`` (nodes each shard can hold)."""
    spark, shards = members.sparkSession, len(capacity)
    spread = _pick(F.col("node"), 7)
    for step in range(rounds):
        placed = materialise(members.join(labels, "node"), "shard-placed")
        held = placed.groupBy("key", "shard").agg(F.count("*").alias("n"))
        load = np.zeros(shards, np.int64)
        for r in labels.groupBy("shard").count().toLocalIterator():  # one row a shard
            load[r["shard"]] = r["count"]
        wish = materialise(proposals(held, capacity, load, step), "shard-wish")
        # a member of a key that is already where the key wants it asks to stay with the key's whole weight
        asked = placed.join(wish, "key").select(
            "node", "key", "shard", "size",
            F.when(F.array_contains("targets", F.col("shard")), F.col("shard"))
            .otherwise(F.get("targets", F.pmod(_pick(F.col("node"), step), F.size("targets")).cast("int"))).alias("target"))
        best = asked.groupBy("node", "shard").agg(F.max_by(F.struct("target", "key", "size"), F.struct("size", "key")).alias("b"))
        # members of a key that leave one shard for another stand together; those of a large key are scattered
        together = F.when(F.col("b.size") * SMALL <= int(max(capacity)), _pick(F.col("b.key"), 3)).otherwise(spread)
        moves = materialise(best.where("b.target <> shard").select(
            "node", F.col("shard").alias("source"), F.col("b.target").alias("target"), together.alias("place")), "shard-moves")
        requests = np.zeros((shards, shards), np.int64)
        for r in moves.groupBy("source", "target").count().toLocalIterator():  # one row a pair of shards
            requests[r["source"], r["target"]] = r["count"]
        allowed = granted(requests, capacity - load)
        if not allowed.sum():
            break
        # the first moves of each pair in one numbering of all moves by pair
        first = (np.cumsum(requests) - requests.ravel()).reshape(requests.shape)
        flow = spark.createDataFrame([(int(f), int(t), int(first[f, t]), int(first[f, t] + allowed[f, t])) for f, t in np.argwhere(allowed)],
                                     "source int, target int, first bigint, last bigint")
        order = [F.col(c) for c in ("source", "target", "place", "node")]
        going = global_row_number(moves, order, "number").join(F.broadcast(flow), ["source", "target"]).where(
            "number > first AND number <= last").select("node", "target")
        labels = materialise(labels.join(going, "node", "left").select(
            "node", F.coalesce("target", "shard").alias("shard")), "shard-labels")
    return labels


def _interleaved(number: Column, n: int) -> Column:
    """A permutation of 0 .. n - 1 that scatters neighbours."""
    stride = next(s for s in range(int(n * 0.618) | 1, 2 * n + 3) if np.gcd(s, n) == 1) if n else 1
    return F.pmod(number.cast("decimal(38,0)") * F.lit(stride).cast("decimal(38,0)"), F.lit(max(1, n)).cast("decimal(38,0)")).cast("bigint")


def shard_rows(docs: DataFrame, shards: int = 40, rounds: int = 12) -> DataFrame:
    """(doc_id, size, text_crc32, group_size, shard, slot): counts at most one apart, equal texts together."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = materialise(docs.select(
        F.monotonically_increasing_id().alias("node"), "doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.md5(text)).alias("key")), "shard-rows")
    n = rows.count()
    sizes = even_sizes(n, shards)
    groups = materialise(rows.groupBy("key").agg(F.count("*").alias("group_size")).where("group_size > 1"), "shard-groups")
    linked = rows.select("node", "key").join(groups.select("key"), "key", "left_semi")
    numbered = materialise(global_row_number(linked, [F.col("node")], "number"), "shard-linked")
    n_linked = numbered.count()
    start = numbered.select("node", F.pmod(F.col("number") - 1, F.lit(shards)).cast("int").alias("shard"))
    labels = propagate(numbered.select("node", "key"), start, sizes, rounds) if n_linked else start

    load = np.zeros(shards, np.int64)
    for r in labels.groupBy("shard").count().toLocalIterator():  # one row a shard
        load[r["shard"]] = r["count"]
    free = rows.select("node").join(labels.select("node"), "node", "left_anti")
    free = global_row_number(free, [F.col("node")], "number").select("node", _interleaved(F.col("number") - 1, n - n_linked).alias("place"))
    ends = F.array(*[F.lit(int(e)) for e in np.cumsum(sizes - load)])
    filled = free.select("node", F.size(F.filter(ends, lambda e: e <= F.col("place"))).alias("shard"))
    placed = rows.join(labels.unionByName(filled), "node").join(groups, "key", "left")
    ordered = global_row_number(placed, [F.col("shard"), F.xxhash64("node"), F.col("node")], "number")
    before = F.array(*[F.lit(int(e)) for e in np.cumsum(sizes) - sizes])
    return ordered.select("doc_id", "size", "text_crc32", F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
                          "shard", (F.col("number") - 1 - F.get(before, F.col("shard"))).alias("slot"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards under the law ``rows``."""
    out = shard_rows(documents(spark, sf_dir))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "group_size")
