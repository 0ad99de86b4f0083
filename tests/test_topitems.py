"""Top items by the norm-ordered index against a full scan."""

import numpy as np
import pytest

from sparkplate.operators import als as M
from sparkplate.operators import topitems as T
from sparkplate.plans import registry as G
from sparkplate.plans.checks import plan_text
from sparkplate.session import cut_lineage

from conftest import SMALL

USERS, ITEMS = "user bigint, features array<double>", "item bigint, features array<double>"


def scan(users, items, n):
    out = []
    for u, x in users:
        scored = sorted((-sum(a * b for a, b in zip(x or [], y or [])), i) for i, y in items)
        out += [(u, i, -s + 0.0, r + 1) for r, (s, i) in enumerate(scored[:n])]
    return sorted(out)


def check(spark, users, items, n, **how):
    found = T.top_items(spark.createDataFrame(users, USERS), spark.createDataFrame(items, ITEMS), n, **how)
    assert sorted((*r[:2], r[2] + 0.0, r[3]) for r in found.rows.collect()) == scan(users, items, n)
    assert 0 <= found.scored <= found.pairs
    return found


def made(seed, n, spread):
    """Factors in eighths (products are exact), lengths from short to long."""
    rng = np.random.default_rng(seed)
    size = rng.uniform(0, 1, n) ** spread * 100
    return [(i, [float(v) for v in np.round(rng.normal(size=4) * size[i]) / 8]) for i in range(n)]


@pytest.mark.parametrize("n,block,group", [(1, 8, 16), (5, 32, 10_000), (40, 16, 7), (500, 64, 64)])
def test_equal_to_a_full_scan(spark, n, block, group):
    check(spark, made(1, 90, 1), made(2, 300, 3), n, block=block, group=group)


def test_long_and_short_items_prune(spark):
    found = check(spark, made(3, 100, 1), made(4, 2000, 4), 5, block=32)
    assert found.share < 0.4 and len(found.rounds) >= 2


def test_ties_and_equal_items(spark):
    """All items alike: every score ties, ids decide, and nothing may be cut off early."""
    check(spark, made(5, 20, 1), [(i, [1.0, 0.5, 0.0, -1.0]) for i in range(100, 0, -1)], 7, block=8)
    check(spark, [(1, [-1.0]), (2, [0.0]), (3, None), (4, [])], [(i, [float(i % 3)]) for i in range(50)], 6, block=4)


def test_missing_factors_and_empty_tables(spark):
    items = [(1, [1.0, 2.0]), (2, None), (3, []), (4, [-1.0]), (5, [0.0, 0.0, 3.0])]
    check(spark, [(1, [1.0, 1.0]), (2, None), (3, [0.0, -2.0, 1.0])], items, 3, block=2)
    check(spark, [], items, 3)
    check(spark, [(1, [1.0])], [], 3)
    check(spark, [(1, [1.0])], items, 0)


def test_plan_has_no_cross_join(spark):
    users, items = G.factor_lists(spark, SMALL)
    text = plan_text(T.top_items(users, items).rows)
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_recommend_equals_the_library(spark):
    """Lists of the index against the block-by-block scoring of MLlib, scores in floats."""
    ratings = G.shared_ratings(spark, SMALL)
    model = M.train_als(ratings)
    asked = ratings.select("userid").distinct()
    mine = {(r.userid, r.businessid): r.rating for r in M.recommend(model, asked, 5).collect()}
    theirs = {(r.userid, x.businessid): x.rating for r in model.recommendForUserSubset(asked, 5).collect() for x in r.recommendations}
    assert len(mine) == len(theirs)
    low = {}
    for (u, _), s in theirs.items():
        low[u] = min(s, low.get(u, s))
    for (u, i), s in mine.items():
        assert s == pytest.approx(theirs[u, i], abs=1e-5) if (u, i) in theirs else s == pytest.approx(low[u], abs=1e-5)


def test_items_of_one_length_prune(spark):
    """Lengths tell these items apart in nothing; their directions do."""
    turn = [k * 2 * np.pi / 3000 for k in range(3000)]
    items = [(i, [float(np.round(64 * np.cos(t))) / 8, float(np.round(64 * np.sin(t))) / 8]) for i, t in enumerate(turn)]
    users = [(i, [float(np.round(40 * np.cos(t))) / 8, float(np.round(40 * np.sin(t))) / 8]) for i, t in enumerate(turn[::30])]
    assert check(spark, users, items, 5, block=32, group=16, wide=16).share < 0.4


def test_copies_of_one_vector_cost_n_items(spark):
    items = [(i, [4.0, 1.0]) for i in range(1500, 0, -1)] + made(6, 64, 1)
    items[-64:] = [(i + 2000, x[:2]) for i, x in items[-64:]]
    found = check(spark, [(u, [1.0, u / 8]) for u in range(40)] + [(50, [0.0, 0.0])], items, 5, block=16)
    assert found.scored <= 41 * (5 + 64)


def test_vectors_with_nulls_have_no_scores(spark):
    users, items = [(1, [1.0, 2.0]), (2, [3.0, 1.0])], [(i, [i / 8, 1.0]) for i in range(40)]
    odd = spark.createDataFrame(items + [(50, [None, 99.0]), (51, [99.0, float("nan")])], ITEMS)
    rows = T.top_items(spark.createDataFrame([*users, (3, [None, 1.0])], USERS), odd, 3, block=8).rows.collect()
    assert sorted(map(tuple, rows)) == scan(users, items, 3)


def half(seed, n, signs):
    """Factors in eighths of the given sign in each dimension, some of them zero."""
    rng = np.random.default_rng(seed)
    return [(i, [float(s * v) / 8 for s, v in zip(signs, np.maximum(rng.integers(-3, 40, 4), 0))]) for i in range(n)]


def test_rows_written_do_not_grow_with_the_blocks(spark, monkeypatch):
    """each block that a user reached was sent the user, and wrote up to n rows or more of its own."""
    written, write = [], T.cut_lineage
    monkeypatch.setattr(T, "cut_lineage", lambda df: written.append(write(df)) or written[-1])
    users = half(7, 60, (1, 1, 1, 1))
    check(spark, users, half(8, 1500, (1, 1, 1, 1)), 4, block=4)
    assert sum(df.count() for df in written if {"user", "item"} <= {*df.columns}) <= 4 * len(users)


@pytest.mark.parametrize("n,block,wide,signs", [(3, 8, 2, (1, 1, 1, 1)), (1, 4, 3, (1, -1, -1, 1)), (40, 16, 1, (1, 1, 1, 1))])
def test_several_slices_equal_a_full_scan(spark, n, block, wide, signs):
    items = half(11, 200, (1, -1, 1, 1))
    items += [(1000 - i, x) for i, x in items[:30]] + [(2000, [0.0] * 4)]
    check(spark, half(9, 40, signs) + [(90, [0.0]), (91, [0.0, signs[1] / 8])], items, n, block=block, wide=wide, group=16)


def test_lists_longer_than_a_block_are_ranked_in_parts(spark, monkeypatch):
    monkeypatch.setattr(T, "HELD", 300)
    check(spark, half(17, 20, (1, 1, 1, 1)), half(18, 400, (1, 1, 1, 1)), 30, block=8, wide=20)
    check(spark, [(1, [0.0]), (2, None)], half(18, 40, (1, 1, 1, 1)), 3, block=8, wide=2)


@pytest.mark.parametrize("wide", [2, 64])
def test_rows_of_a_user_that_comes_twice_make_one_list(spark, wide):
    users, items = half(19, 12, (1, 1, 1, 1)), half(20, 120, (1, 1, 1, 1))
    users, items = users + users[:4] + [(5, [4.0, 0.0, 0.5, 1.0])], items + items[::3]
    got = T.top_items(spark.createDataFrame(users, USERS), spark.createDataFrame(items, ITEMS), 5, block=8, wide=wide).rows
    want = []
    for u in {u for u, _ in users}:
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for v, x in users if v == u for i, y in items)
        want += [(u, i, -s, r + 1) for r, (s, i) in enumerate(scored[:5])]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_slices_of_users_of_both_signs(spark):
    found = check(spark, made(12, 40, 1), made(13, 300, 1), 5, block=8, wide=4)
    assert found.scored < found.pairs


def test_dominated_items_are_left_out_for_users_of_one_sign(spark):
    items, one, both = (cut_lineage(T._padded(spark.createDataFrame(rows, "id bigint, features array<double>"), "id", 4))
                        for rows in (half(14, 3000, (1, 1, 1, 1)), half(15, 30, (1, 0, 1, 1)), half(16, 30, (1, 1, 1, 1)) + [(99, [1.0, -1.0])]))
    items = items.withColumnRenamed("id", "item")
    kept = {r.item for r in T.undominated(items, one, 4, 2, 16).collect()}
    rows = [(r.item, r.features) for r in items.collect()]
    beaten = {i for i, x in rows if sum(all(a > b for a, b in zip(y, x)) for _, y in rows) >= 2}
    assert {i for i, _ in rows} - beaten <= kept and len(kept) < 1500
    assert T.undominated(items, both, 4, 2, 16).count() == 3000
    assert T.undominated(items, one, 4, 2, 3000).count() == 3000
