"""Selection by histogram: the n-th row, its predicate, and what is written for it."""

import random

import pytest
from pyspark.sql import functions as F

from sparkplate.operators import select as S
from sparkplate.operators import split as SP
from sparkplate.operators.ids import encode_ratings
from sparkplate.session import checkpoint_dir

ORDER = SP.LATEST


def rows(n, seed=1, days=9):
    """Distinct rows with hot days, equal dates, null dates, users and items."""
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        day = None if rng.random() < 0.05 else f"2021-03-{1 + min(rng.randrange(days), rng.randrange(days)):02d} {rng.choice(['08', '21'])}:00:00"
        out.add((day, rng.choice([None, "u1", "u2", "u3"]), rng.choice([None, "b1", "b2"]) if rng.random() < 0.2 else f"b{rng.randrange(40)}",
                 rng.randrange(1, 6)))
    return list(out)


def expected(data):
    def key(r):
        date, user, item, stars = r
        return (date is None, [-ord(c) for c in date or ""], user is not None, user or "", item is not None, item or "", stars)
    return sorted(data, key=key)


def frame(spark, data):
    return spark.createDataFrame(data, "date string, user_id string, business_id string, stars int").repartition(3)


@pytest.mark.parametrize("small", [0, 100_000])
def test_first_rows_are_those_of_the_sorted_list(spark, monkeypatch, small):
    monkeypatch.setattr(S, "SMALL_EDGE", small)
    data = rows(300)
    want = expected(data)
    front = S.Front(frame(spark, data), ORDER)
    assert front.total == 300
    for n in (0, 1, 2, 37, 150, 151, 280, 299, 300, 999):
        got = front.df.where(front.first(n)).collect()
        assert {tuple(r) for r in got} == set(want[:n]), n


def test_empty_and_null_only_tables(spark):
    assert S.Front(frame(spark, []), ORDER).total == 0
    data = [(None, None, None, i) for i in range(20)]
    front = S.Front(frame(spark, data), ORDER)
    assert {r.stars for r in front.df.where(front.first(7)).collect()} == set(range(7))


def test_predicate_needs_no_join(spark):
    front = S.Front(frame(spark, rows(200)), ORDER)
    plan = front.df.where(front.first(50))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_time_split_writes_the_ratings_once(spark):
    """Of what a split writes, one set of files has all ratings; the rest is a row per day or new user."""
    import glob

    data = [(f"b{i % 50}", f"u{i % 70}", i % 5 + 1, f"2021-{i % 12 + 1:02d}-{i % 28 + 1:02d} 00:00:00") for i in range(4000)]
    ratings = encode_ratings(spark.createDataFrame(data, "business_id string, user_id string, stars int, date string"), own_keys=True)
    n = ratings.distinct().count()
    folder = checkpoint_dir(spark).replace("file:", "")
    before = set(glob.glob(f"{folder}/cut-*"))
    train, test = SP.time_split(ratings)
    assert train.count() + test.count() == n
    sizes = [spark.read.parquet(p).count() for p in set(glob.glob(f"{folder}/cut-*")) - before]
    assert sum(s >= n for s in sizes) == 1


def test_null_users_can_be_new(spark):
    data = [(f"b{i}", None if i >= 90 else "u1", 3, f"2021-01-{1 + i // 5:02d}", None if i >= 90 else 1, i) for i in range(100)]
    ratings = spark.createDataFrame(data, "business_id string, user_id string, stars int, date string, userid int, businessid int")
    train, test = SP.time_split(ratings, ratio=0.2, swap=1)
    assert test.count() == 20 and train.count() == 80
    assert train.where(F.col("userid").isNull()).count() == 10
