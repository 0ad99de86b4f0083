"""Sharding by balanced label propagation: its law, its groups and its quotas."""

import collections
import zlib

import numpy as np
import pytest

from llm_fixtures import ODD, SMALL, frame, none, odd  # noqa: F401
from sparkplate.llm import sharding


def check(rows, texts, shards):
    """rows of shard_rows against the texts they came from: law, slots, sizes and groups."""
    assert len(rows) == len(texts)
    counts = collections.Counter(r["shard"] for r in rows)
    assert all(0 <= s < shards for s in counts)
    held = [counts[s] for s in range(shards)]
    assert max(held) - min(held) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    raw = [(t or "").encode() for t in texts]
    same = collections.Counter(raw)
    assert collections.Counter((r["size"], r["text_crc32"], r["group_size"]) for r in rows) == collections.Counter(
        (len(t) + 16, zlib.crc32(t), same[t]) for t in raw)


def spread(rows):
    """Shards of each group of equal texts, by checksum."""
    where = collections.defaultdict(set)
    for r in rows:
        where[r["text_crc32"], r["size"]].add(r["shard"])
    return where


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_odd_rows(spark, odd, shards):
    rows = sharding.shard_rows(odd, shards).collect()
    check(rows, [r[1] for r in ODD], shards)
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ODD)


def test_empty_table(none):
    df = sharding.shard_rows(none)
    assert df.columns == ["doc_id", "size", "text_crc32", "group_size", "shard", "slot"]
    assert df.count() == 0


def test_small_groups_stay_whole(spark):
    texts = [f"group {i // 4}" for i in range(400)] + [f"single {i}" for i in range(800)]
    rows = sharding.shard_rows(frame(spark, [(i, t, "x", "s") for i, t in enumerate(texts)]), 10).collect()
    check(rows, texts, 10)
    assert all(len(s) == 1 for s in spread(rows).values())


def test_all_documents_linked(spark):
    """No free document can make room: moves are swaps, and the law still holds."""
    texts = [f"group {i // 2}" for i in range(600)]
    rows = sharding.shard_rows(frame(spark, [(i, t, "x", "s") for i, t in enumerate(texts)]), 7).collect()
    check(rows, texts, 7)
    cut = sum(len(s) > 1 for s in spread(rows).values())
    assert cut <= 60, cut  # dealt evenly, about 250 of the 300 pairs would be cut


def test_hot_group_is_spread_over_few_shards(spark):
    texts = ["hot"] * 400 + [f"pair {i // 2}" for i in range(200)] + [f"single {i}" for i in range(600)]
    rows = sharding.shard_rows(frame(spark, [(None if i % 3 else 5, t, "x", "s") for i, t in enumerate(texts)]), 12).collect()
    check(rows, texts, 12)
    where = spread(rows)
    assert len(where[zlib.crc32(b"hot"), 3 + 16]) <= 6  # 400 rows need 4 shards of 100
    assert sum(len(s) > 1 for s in where.values()) <= 10


def test_members_with_several_keys(spark):
    """The general interface: nodes linked through any keys."""
    members = spark.createDataFrame([(i, k) for i in range(120) for k in (f"a{i // 6}", f"b{i // 12}")], "node bigint, key string")
    start = spark.createDataFrame([(i, i % 5) for i in range(120)], "node bigint, shard int")
    rows = sharding.propagate(members, start, np.full(5, 40)).collect()
    assert sorted(r["node"] for r in rows) == list(range(120))
    assert max(collections.Counter(r["shard"] for r in rows).values()) <= 40
    keys = collections.defaultdict(set)
    for r in rows:
        keys[r["node"] // 6].add(r["shard"])
    assert sum(len(s) == 1 for s in keys.values()) >= 15


@pytest.mark.parametrize("seed", range(20))
def test_granted_moves_fit(seed):
    rng = np.random.default_rng(seed)
    shards = int(rng.integers(2, 9))
    requests = rng.integers(0, 30, (shards, shards)) * rng.integers(0, 2, (shards, shards))
    np.fill_diagonal(requests, 0)
    room = rng.integers(0, 60, shards) * rng.integers(0, 2, shards)
    moves = sharding.granted(requests, room)
    assert (moves >= 0).all() and (moves <= requests).all()
    rest = room - moves.sum(axis=0) + moves.sum(axis=1)
    assert (rest >= 0).all()
    assert not ((requests - moves)[:, rest > 0]).any()  # no request into a shard with room is refused


def test_granted_swaps_and_cycles_need_no_room():
    ring = np.zeros((4, 4), np.int64)
    ring[[0, 1, 2, 3], [1, 2, 3, 0]] = [5, 7, 5, 9]
    assert sharding.granted(ring, np.zeros(4, np.int64)).sum() == 20
    assert (sharding.granted(np.ones((3, 3), np.int64) - np.eye(3, dtype=np.int64), np.zeros(3, np.int64)).sum()) == 6


def test_query_over_the_small_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    df = sharding.op11_sharding(spark, SMALL)
    assert df.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = df.collect()
    check(rows, [r["text"] for r in docs.collect()], 40)
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}
    assert all(len(s) == 1 for s in spread(rows).values())
