"""The block index of similar items against the plain scan of all vectors."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkplate.operators import content as C


def items_of(spark, texts):
    rows = [(f"b{i:04d}", f"n{i % 40}", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "business_id string, name string, text_features string").repartition(3)


def topics(seed, n, kinds=6):
    """Texts over topics of their own words with a few common ones; some empty, some null, some equal."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        own = [f"w{i % kinds}x{j}" for j in range(30)]
        out.append(rng.choice([None, "", "the and"]) if i % 29 == 7 else " ".join(
            [f"head{i % kinds}"] * 6 + rng.choices(own, k=rng.randint(1, 20)) + rng.choices(["common", "words", "here"], k=3)))
    return out + out[:10]


@pytest.mark.parametrize("titles,k", [(["n3"], 5), (["n1", "n2", "n39", "unknown"], 12), (["unknown"], 5), ([], 5), (["n0"], 500), (["n7"], 0)])
def test_same_rows_as_the_scan(spark, titles, k):
    items = items_of(spark, topics(1, 300))
    found = C.similar_indexed(C.index_vectors(items, block=16), items, titles, k, seeds=2)
    want = C.similar_items(C.tfidf(items), items, titles, k)
    assert found.rows.columns == want.columns
    assert [tuple(r) for r in found.rows.collect()] == [tuple(r) for r in want.collect()]


def test_blocks_of_other_topics_are_not_read(spark):
    items = items_of(spark, topics(2, 600))
    index = C.index_vectors(items, block=20)
    found = C.similar_indexed(index, items, ["n5"], 5, seeds=2)
    assert index.blocks >= 25 and found.read < index.blocks / 2
    assert found.rows.count() == 5


def test_equal_texts_tie_by_id(spark):
    items = items_of(spark, ["alpha beta gamma"] * 90 + ["alpha delta"] * 10)
    found = C.similar_indexed(C.index_vectors(items, block=8), items, ["n0"], 7, seeds=1)
    want = C.similar_items(C.tfidf(items), items, ["n0"], 7)
    assert [tuple(r) for r in found.rows.collect()] == [tuple(r) for r in want.collect()]


def test_bounds_hold_every_weight_and_empty_corpus(spark):
    items = items_of(spark, topics(3, 200))
    index = C.index_vectors(items, block=16)
    pairs = index.vectors.select("block", F.inline("vector")).join(index.bounds, ["term", "block"], "left")
    assert pairs.where("top IS NULL OR weight > top").count() == 0
    none = items.where("false")
    assert C.similar_indexed(C.index_vectors(none), none, ["n1"]).rows.count() == 0


def test_no_window_over_documents(spark):
    items = items_of(spark, topics(4, 50))
    assert "Window" not in C.tfidf(items)._jdf.queryExecution().optimizedPlan().toString()


def shuffled_pairs(plan):
    return [line for line in plan.splitlines() if "Join" in line or "Aggregate [business_id" in line]


def test_pairs_are_neither_joined_nor_grouped_by_document(spark):
    """F8: each pair of document and term was shuffled by term, for its idf, and again by document."""
    items = items_of(spark, topics(5, 50))
    for features in (None, 9):
        assert not shuffled_pairs(C.tfidf(items, max_features=features)._jdf.queryExecution().optimizedPlan().toString())
    index = C.index_vectors(items, block=16)
    assert not shuffled_pairs(index.bounds._jdf.queryExecution().optimizedPlan().toString())


def by_hand(rows, features=None):
    """(id, term): weight of the rows (id, counts), all of different ids."""
    total, df = Counter(), Counter()
    for _, counts in rows:
        total.update(counts)
        df.update(counts.keys())
    vocab = set(sorted(total, key=lambda t: (-total[t], t))[:features])
    out = {}
    for key, counts in rows:
        w = {t: n * (math.log((1 + len(rows)) / (1 + df[t])) + 1) for t, n in counts.items() if t in vocab}
        out |= {(key, t): x / math.sqrt(sum(y * y for y in w.values())) for t, x in w.items()}
    return out


@pytest.mark.parametrize("pairs,features", [(40, None), (40, 25), (10**6, 25), (40, 10**6)])
def test_weights_by_hand_over_several_groups(spark, monkeypatch, pairs, features):
    monkeypatch.setattr(C, "GROUP_PAIRS", pairs)
    texts = topics(6, 60)
    items = items_of(spark, texts)
    stop = set(C.ENGLISH_STOP_WORDS)
    rows = [(f"b{i:04d}", Counter(w for w in (t or "").split() if w not in stop)) for i, t in enumerate(texts)]
    want = by_hand(rows, features)
    got = C.tfidf(items, max_features=features).collect()
    assert len(got) == len(want) and {(r.business_id, r.term) for r in got} == set(want)
    assert all(math.isclose(r.weight, want[r.business_id, r.term]) for r in got)


@pytest.mark.parametrize("pairs", [1, 300])
def test_index_of_several_groups(spark, monkeypatch, pairs):
    items = items_of(spark, topics(7, 200))
    want = [tuple(r) for r in C.similar_items(C.tfidf(items), items, ["n3", "n8"], 30).collect()]
    monkeypatch.setattr(C, "GROUP_PAIRS", pairs)
    index = C.index_vectors(items, block=16)
    assert [tuple(r) for r in C.similar_indexed(index, items, ["n3", "n8"], 30, seeds=1).rows.collect()] == want
    assert index.vectors.agg(F.count_distinct("block")).first()[0] == index.blocks
    pairs = index.vectors.select("block", F.inline("vector")).groupBy("term", "block").agg(F.max("weight").alias("weight"))
    assert pairs.join(index.bounds, ["term", "block"], "full").where("NOT top <=> weight").count() == 0


def test_bounds_hold_rows_that_come_twice(spark):
    """Rows of equal id and text are one document, whose terms come twice: a bound holds their sum."""
    items = items_of(spark, topics(8, 40))
    items = items.unionAll(items).withColumn("business_id", F.when(F.col("business_id") > "b0005", F.col("business_id")))
    index = C.index_vectors(items, block=16)
    sums = index.vectors.select("block", "business_id", F.inline("vector")).groupBy("block", "business_id", "term").agg(F.sum("weight").alias("weight"))
    top = sums.groupBy("block", "term").agg(F.max("weight").alias("weight"))
    assert top.join(index.bounds, ["term", "block"], "full").where("NOT abs(top - weight) < 1e-9 OR top IS NULL OR weight IS NULL").count() == 0


def test_counted_terms(spark):
    items = spark.createDataFrame([("b1", "Pizza pizza, a the éclair x_1 PIZZA x_1 é"), ("b2", None), ("b3", "the a")], "business_id string, text_features string")
    assert sorted(map(tuple, C.term_counts(items, "business_id", "text_features").collect())) == [("b1", "pizza", 3), ("b1", "x_1", 2), ("b1", "éclair", 1)]
    assert C.term_counts(items, "business_id", "text_features").schema["tf"].dataType.simpleString() == "bigint"
    assert {r.business_id: (r.terms, r.tfs, r._head) for r in C._count_rows(items, "business_id", "text_features", C.ENGLISH_STOP_WORDS).collect()}["b1"] == ("pizza x_1 éclair", [3, 2, 1], "pizza")
