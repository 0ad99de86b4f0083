"""Operators that bring documents together: line dedup, exact dedup, n-gram join, byte strings."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from llm_fixtures import ODD, SMALL, frame, none, odd, small  # noqa: F401
from sparkplate.llm import exact, fuse, lines, ngrams, substrings
from sparkplate.llm.components import connected_components

PAIRS = [(r[0], r[1]) for r in ODD]


def key(x):
    return repr(x)


# --- line dedup ------------------------------------------------------------------------

@pytest.mark.parametrize("sites", [1, 2, 3])
def test_lines_odd_rows(spark, odd, sites):
    got = lines.clean_lines(odd, sites)
    assert [c for c in got.columns if c not in ("n_lines", "n_removed")] == [c for c in odd.columns if c != "text"] + ["text"]
    want = brute.clean_lines([(r[0], r[1], r[3]) for r in ODD], sites)
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=key) == sorted(
        ((r[0], t) for r, t in zip(ODD, want)), key=key)


def test_lines_near_and_far_from_threshold(spark):
    rows = [(i, f"spread {n} line\nown {i} {n}", "x", f"s{i}") for n in (3, 9, 10, 11, 14, 40) for i in range(100 * n, 100 * n + n)]
    got = lines.clean_lines(frame(spark, rows), 10).collect()
    want = brute.clean_lines([(r[0], r[1], r[3]) for r in rows], 10)
    assert sorted((r["doc_id"], r["text"]) for r in got) == sorted((r[0], t) for r, t in zip(rows, want))


def test_lines_empty_table(none):
    assert lines.clean_lines(none).count() == 0


# --- exact dedup -----------------------------------------------------------------------

def grouped(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out, taken = [], set()
    for (doc, _), t in zip(rows, norm):
        ids = [d for (d, _), u in zip(rows, norm) if u == t]
        keep = min((d for d in ids if d is not None), default=None) if len(ids) > 1 else doc
        stays = doc == keep and t not in taken  # one row of each group
        taken |= {t} if stays else set()
        out.append((doc, keep, len(ids), stays, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=key)


@pytest.mark.parametrize("middle", [-1, 6, 100])
def test_exact_odd_rows(spark, odd, middle):
    old = F.coalesce(F.col("doc_id") <= middle, F.lit(False))
    got = exact.dedup(odd.where(old), odd.where(~old)).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["sha"]).hex()) for r in got), key=key) == grouped(PAIRS)


def test_exact_keeps_one_row_of_repeated_ids(spark):
    rows = [(1, "a b"), (1, "a  b"), (2, "a b"), (None, "c"), (None, "c"), (None, "d"), (3, "e"), (3, "f")]
    docs = frame(spark, [(*r, "x", "s") for r in rows]).repartition(3)
    for old in (F.lit(False), F.coalesce(F.col("doc_id") < 2, F.lit(False))):
        got = exact.dedup(docs.where(old), docs.where(~old)).collect()
        assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["sha"]).hex()) for r in got), key=key) == grouped(rows)
        assert sum(r["kept"] for r in got) == 5


def test_exact_empty_table(none):
    assert exact.dedup(none, none).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 60000])
def test_fuse_filter(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64)
    built = fuse.build(keys)
    assert fuse.contains(keys, *built).all()
    others = np.random.default_rng(n + 1).integers(0, 1 << 63, 50000).astype(np.uint64)
    assert fuse.contains(others, *built).mean() < 0.01
    assert n < 10000 or len(built[3]) < 1.4 * n


# --- n-gram join -----------------------------------------------------------------------

def near_copies(seed=3, groups=12, size=9):
    """Chains and stars of near copies, near misses, shared passages and short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5)))
    passage = " ".join(word() for _ in range(40))
    rows = []
    for g in range(groups):
        base = [word() for _ in range(rng.choice([6, 12, 60, 150, 400]))]
        for _ in range(size):
            rows.append((len(rows), " ".join(base) + (" " + passage if rng.random() < 0.3 else ""), "en", "s"))
            for _ in range(rng.randint(0, max(1, len(base) // 60))):  # edits add up along a chain
                base[rng.randrange(len(base))] = word()
    rng.shuffle(rows)
    return [(i, t, lang, s) for i, (_, t, lang, s) in enumerate(rows)]


def test_ngrams_odd_rows(spark, odd):
    got = ngrams.components(odd).collect()
    want = brute.component_ids(PAIRS)
    assert sorted(((r["doc_id"], r["n"], r["component_id"]) for r in got), key=key) == sorted(
        ((d, n, c) for (d, _), (n, c) in zip(PAIRS, want)), key=key)
    kept = ngrams.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=key) == sorted([1, 2, 3, 4, 6, 7, None, 8, 9, 10, 11, 12, 13, 14], key=key)


@pytest.mark.parametrize("seed,tile", [(3, 2048), (4, 5)])
def test_ngrams_finds_every_link(spark, monkeypatch, seed, tile):
    monkeypatch.setattr(ngrams, "TILE", tile)
    rows = near_copies(seed)
    got = {r["doc_id"]: (r["n"], r["component_id"]) for r in ngrams.components(frame(spark, rows)).collect()}
    want = brute.component_ids([r[:2] for r in rows])
    assert [got[r[0]] for r in rows] == want
    assert len({c for _, c in want}) not in (1, len(rows))


def linked(rows):
    """(row, row) numbers of every two documents whose shingle sets link."""
    sets = [brute.shingles(t) for _, t in rows]
    return [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]


@pytest.mark.parametrize("seed,tile,items", [(3, 1024, 1 << 18), (4, 5, 1 << 18), (5, 1024, 300)])
def test_ngrams_links_inside_components(spark, monkeypatch, seed, tile, items):
    monkeypatch.setattr(ngrams, "LINK_TILE", tile)
    monkeypatch.setattr(ngrams, "LINK_ITEMS", items)
    rows = near_copies(seed, groups=6, size=14)
    base = [f"w{i}" for i in range(100)]
    near = [" ".join([*base[:10 * i], f"other{i}", *base[10 * i + 1:]]) for i in range(10)]  # one word changed in each
    rows += [(len(rows) + i, *r[1:]) for i, r in enumerate(rows[:7] + [(0, t, "en", "s") for t in near])]
    want = linked([r[:2] for r in rows])
    got = {r["doc_id"]: r for r in ngrams.link_counts(frame(spark, rows)).collect()}
    assert [got[i]["n_links"] for i in range(len(rows))] == [sum(i in p for p in want) for i in range(len(rows))]
    assert [got[r[0]]["component_id"] for r in rows] == [c for _, c in brute.component_ids([r[:2] for r in rows])]
    members, pairs = ngrams.links(frame(spark, rows))
    node = {r["doc_id"]: r["node"] for r in members.collect()}
    pairs = [(r["a"], r["b"]) for r in pairs.collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {tuple(sorted((node[i], node[j]))) for i, j in want if node[i] != node[j]}
    assert len(pairs) > len({x for p in pairs for x in p})  # more than a spanning subset of them


def test_ngrams_links_odd_rows(spark, odd):
    want = linked(PAIRS)
    got = [(r["doc_id"], r["n_links"]) for r in ngrams.link_counts(odd).collect()]
    assert sorted(got, key=key) == sorted(((d, sum(i in p for p in want)) for i, (d, _) in enumerate(PAIRS)), key=key)


def test_ngrams_empty_table(none):
    assert ngrams.components(none).count() == 0
    assert ngrams.link_counts(none).count() == 0


def test_count_tree_loses_no_pair():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 6, (8, ngrams.GROUPS))
    vec = np.concatenate([np.maximum(0, b + rng.integers(-1, 2, (60, ngrams.GROUPS))) for b in base]).astype(np.uint16)
    n = vec.sum(axis=1).astype(np.int64)
    tree = ngrams.CountTree(vec, n)
    assert sorted(tree.order.tolist()) == list(range(len(n)))
    i, j = np.triu_indices(len(n), 1)
    ok = ngrams.can_link(n[i], n[j], ngrams.pair_bound(vec, i, j))
    a, b = ngrams.tree_join(tree, tree)
    assert {(x, y) for x, y in zip(i[ok].tolist(), j[ok].tolist())} == {(x, y) for x, y in zip(a.tolist(), b.tolist()) if x < y}


def test_clipped_counts_stay_bounds():
    s = np.arange(100_000, dtype=np.uint64) * np.uint64(ngrams.GROUPS)  # all in one class
    vec = ngrams._vectors(ngrams.pa.array([ngrams.count_vector(x) for x in (s, s[1:], s[:50])], ngrams.pa.binary()))
    n = np.array([100_000, 99_999, 50])
    a, b, most = next(ngrams._tile_pairs(np.zeros(3, int), np.full(3, 2), None, n, vec))
    assert (a.tolist(), b.tolist()) == ([0], [1]) and most[0] >= 99_999
    one = ngrams.CountTree(vec, n)
    assert {(0, 1), (1, 0)} <= set(zip(*(x.tolist() for x in ngrams.tree_join(one, one))))


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (103, 100), (200, 200)]
    got = {r["node"]: r["comp"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 104)}, 200: 200}


# --- repeated byte strings -------------------------------------------------------------

def repeats(seed=1):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("ab é") for _ in range(n))
    shared = [text(n) for n in (30, 49, 50, 51, 90, 300)]
    rows = [(i, text(rng.randint(0, 60)) + rng.choice(shared) + text(5) + rng.choice(shared) + text(rng.randint(0, 60)), "en", "s") for i in range(60)]
    return rows + [(100 + i, rows[i][1], "en", "s") for i in range(5)] + [(200, "a" * 500, "en", "s"), (201, "a" * 120, "en", "s"), (201, "b" + "a" * 60, "en", "s")]


@pytest.mark.parametrize("hot,segment", [(4096, 1 << 19), (3, 1 << 19), (4096, 130)])
@pytest.mark.parametrize("odd_rows", [True, False])
def test_repeats_match_brute_force(spark, monkeypatch, hot, segment, odd_rows):
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "SEGMENT", segment)
    monkeypatch.setattr(substrings, "SLICE", 7 if hot == 3 else 1 << 14)
    rows = ODD if odd_rows else repeats()
    df = frame(spark, rows)
    got = substrings._cut(df, ["doc_id"]).collect()
    want = brute.cut_repeats([r[:2] for r in rows])
    assert sorted(((r["doc_id"], bytes(r["_kept"]), r["_removed"], r["_spans"]) for r in got), key=key) == sorted(
        ((r[0], *w) for r, w in zip(rows, want)), key=key)
    out = substrings.remove_repeats(df)
    assert out.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=key) == sorted(
        ((r[0], None if r[1] is None else w[0].decode("utf-8", "ignore")) for r, w in zip(rows, want)), key=key)


def test_repeats_of_a_hot_passage_are_marked_within_blocks(spark, monkeypatch):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = text(600)
    rows = [(i, text(80) + passage, "en", "s") for i in range(200)]
    monkeypatch.setattr(substrings, "HOT", 3)
    swept, sweep = [], substrings._across_blocks
    monkeypatch.setattr(substrings, "_across_blocks", lambda s: (swept.append(sweep(s).count()), sweep(s))[1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # eight tasks hold the blocks
    try:
        rows_out = substrings._cut(frame(spark, rows), ["doc_id"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = {r["doc_id"]: (bytes(r["_kept"]), r["_removed"], r["_spans"]) for r in rows_out}
    assert got == {r[0]: w for r, w in zip(rows, brute.cut_repeats([r[:2] for r in rows]))}
    assert swept[0] < 550, swept  # strings of the passage, each in up to eight tasks


def test_repeats_empty_table(none):
    assert substrings.remove_repeats(none).count() == 0


def test_repeats_compare_bytes_of_equal_hashes():
    raws = [bytes(range(60)), bytes(range(1, 61)), bytes(range(100, 160)), bytes(range(60))]
    data, h, row, place, at = substrings._strings(raws)
    ids = row.copy()
    want = {(r, p) for r, p in zip(row.tolist(), place.tolist()) if r == 3 or (r == 1 and p < 10)}
    for names in (h, np.zeros_like(h)):  # as they are, and all alike
        marked, rest = substrings._marked(data, names, at, ids)
        assert set(zip(row[marked].tolist(), place[marked].tolist())) == want
        assert sorted([*marked.tolist(), *rest.tolist()]) == list(range(len(h)))


def test_repeats_stream_whole_blocks(monkeypatch):
    monkeypatch.setattr(substrings, "SLICE", 5)
    keys = np.repeat([1, 2, 3, 4], [3, 9, 1, 4])
    table = substrings.pa.table({"key": keys, "block": np.zeros(len(keys), np.int32)})
    parts = [t.column("key").to_pylist() for t in substrings._whole_blocks(table.to_batches(max_chunksize=2))]
    assert sum(parts, []) == keys.tolist()
    assert not any(set(a) & set(b) for i, a in enumerate(parts) for b in parts[i + 1:])
