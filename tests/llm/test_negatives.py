"""Hard-negative mining against a plain scan, and its bounds."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkplate.llm import negatives
from sparkplate.llm.negatives import BIG

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, id double, score string, comps int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", 0.5, "s", 1) for r in rows], SCHEMA)


def scan(rows, every=100, positives=5, k=10, low=30, high=90):
    part = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i is not None and i % 7 == 0:
            label = math.fmod(label + 1, 10)
        part.append((BIG if i is None else i, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for n, (a, la, x) in enumerate(part):
        if a == BIG or a % every:
            continue
        found = sorted((-sum(p * q for p, q in zip(x, y)), i, m, lb) for m, (i, lb, y) in enumerate(part) if m != n)
        for s, p, _, lb in [f for f in found if f[3] == la][:positives]:
            window = [f for f in found if f[3] != la and -low * s <= -100 * f[0] <= -high * s]
            out += [(a, None if p == BIG else p, r + 1, None if f[1] == BIG else f[1], -s, -f[0])
                    for r, f in enumerate(window[:k])]
    return sorted(out, key=repr)


def got(df):
    assert df.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
                         ("positive_score", "bigint"), ("negative_score", "bigint")]
    return sorted(map(tuple, df.collect()), key=repr)


def run(spark, rows, every=100, **how):
    return got(negatives.mine(negatives.prepared(frame(spark, rows)), (F.col("id") % every == 0) & (F.col("id") < BIG), **how))


def clusters(seed, n, dims=12, labels=4, scale=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = centres[label] * rng.uniform(0.2, 1) + rng.normal(size=dims) * 0.6
        rows.append((i, [float(x) for x in (v * scale).astype(np.float32)], label))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters(spark, seed):
    rows = clusters(seed, 600)
    assert run(spark, rows, 20) == scan(rows, 20)


@pytest.mark.parametrize("block,anchors", [(7, 1024), (256, 5)])
def test_blocks_change_nothing(spark, block, anchors):
    rows = clusters(3, 400)
    assert run(spark, rows, 25, block=block, anchors=anchors) == scan(rows, 25)


def test_ties_and_copies(spark):
    """A third of all rows hold one vector; repeated rows and ids; all scores tie."""
    rows = clusters(4, 200)
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(150)] + [(i, rows[3][1], 1) for i in (0, 0, 50, 50, 700)]
    assert run(spark, rows, 50) == scan(rows, 50)


ODD = [(0, [1.0, 0.5], 0), (100, [0.5, 1.0], 0), (200, None, 0), (300, [1.0, None], 0), (400, [float("nan"), 1.0], 0),
       (500, [float("inf"), 1.0], 0), (600, [1.0, 1.0], None), (700, [], 0), (800, [0.0, 0.0], 0), (900, [1.0, 2.0, 3.0], 0),
       (None, [1.0, 1.0], 0), (None, [0.4, 0.4], 1), (1, [0.4, 0.3], 1), (2, [0.4, 0.3], 1), (3, [-1.0, -1.0], 1), (7, [0.3, 0.3], 9),
       (-100, [0.9, 0.1], 0), (4, [0.0, 0.0], 2), (5, [1e-9, -1e-9], 2), (6, [0.6], 3)]


def padded(rows):
    return [(i, v if v is None else v + [0.0] * (3 - len(v)), x) for i, v, x in rows]


def test_odd_rows(spark):
    assert run(spark, ODD) == scan(padded(ODD))
    assert run(spark, ODD + ODD) == scan(padded(ODD + ODD))


def test_empty_and_anchorless_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []
    assert run(spark, [(0, [], 0), (1, [], 0), (2, [], 1)]) == scan([(0, [0.0], 0), (1, [0.0], 0), (2, [0.0], 1)])


def test_large_components(spark):
    rows = [(i, v, x) for i, v, x in clusters(5, 120, dims=3, scale=2e6)]
    assert run(spark, rows, 20) == scan(rows, 20)
    with pytest.raises(Exception, match="62 bits"):
        run(spark, [(0, [1e18], 0), (1, [1e18], 0)])


@pytest.mark.parametrize("scale", [1e-3, 1, 1e4])
def test_intervals_hold_every_score(scale):
    rng = np.random.default_rng(6)
    x = np.floor(rng.normal(size=(300, 8)) * 256 * scale).astype(np.int64)
    x[:40] = x[0]  # copies: angles of zero
    x[40] = 0
    x[41] = -x[42]
    refs = negatives.references(x[:200].astype(float), 6)
    norm, angle = negatives.measure(x, refs)
    true = x @ x.T
    low, high = negatives.interval(angle, norm, angle, angle, norm, norm)
    assert (low <= true).all() and (true <= high).all()
    low, high = negatives.interval(angle, norm, angle.min(axis=0)[None], angle.max(axis=0)[None], norm.min()[None], norm.max()[None])
    assert (low[:, 0] <= true.min(axis=1)).all() and (true.max(axis=1) <= high[:, 0]).all()


def test_bounds_leave_pairs_out():
    """Tight clusters: intervals against a far cluster are narrow enough to rule its rows out."""
    rng = np.random.default_rng(7)
    centres = np.eye(6) * 500
    x = np.concatenate([np.floor(c + rng.normal(size=(50, 6)) * 5).astype(np.int64) for c in centres])
    refs = negatives.references(x.astype(float), 6)
    norm, angle = negatives.measure(x, refs)
    _, high = negatives.interval(angle, norm, angle, angle, norm, norm)
    assert (high < 0.3 * 250_000).mean() > 0.5
