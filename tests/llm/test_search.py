"""Ranked lexical search against a plain scan, and what its blocks skip."""

import collections
import math
import random
import re

import numpy as np
import pytest

from llm_fixtures import ODD, frame, none, odd  # noqa: F401
from sparkplate.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans(search.UPPER, search.LOWER)
BIG = search.BIG


def words(text):
    return TERM.findall((text or "").translate(FOLD))


def scan(docs, items, k=10):
    """docs of (doc_id, text), items of (item_id, text) -> sorted (item_id, rank, doc_id, score)."""
    counted = [(d, collections.Counter(words(t))) for d, t in docs]
    lengths = [sum(c.values()) for _, c in counted]
    n, length = sum(x > 0 for x in lengths), sum(lengths)
    df = collections.Counter(t for _, c in counted for t in c)
    asked = collections.defaultdict(set)
    for i, t in items:
        asked[i] |= set(words(t))
    out = []
    for item, query in asked.items():
        found = []
        for (doc, c), size in zip(counted, lengths):
            score = 0
            for t in query & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                m = 100 - 90 + (90 * size * n) // length
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, BIG if doc is None else doc))
        out += [(item, r + 1, None if d == BIG else d, -s) for r, (s, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def got(df):
    assert df.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted(map(tuple, df.collect()), key=repr)


def items_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "item_id bigint, text string, doc_id string, rank int")


ASKED = [(1, "The quick brown FOX"), (2, None), (3, ""), (4, "É é ñandú 漢字 x12"), (None, "lazy dog again"), (5, "w1 w2 w699 nothing"),
         (6, "one two"), (6, "three line"), (7, "missing everywhere"), (8, "a b c a b c"), (8, "a b c a b c")]


@pytest.mark.parametrize("k", [1, 3, 10, 100])
def test_odd_rows(spark, odd, k):
    want = scan([(r[0], r[1]) for r in ODD], ASKED, k)
    assert got(search.search(odd, items_frame(spark, ASKED), k, shard=5, block=2)) == want


def test_empty_tables(spark, none, odd):
    assert got(search.search(none, items_frame(spark, ASKED))) == []
    assert got(search.search(odd, items_frame(spark, []))) == []
    assert got(search.search(odd, items_frame(spark, [(1, " -- ")]))) == []


def corpus(seed, n, vocabulary=300, copies=0):
    rng = random.Random(seed)
    some = [f"t{i}" for i in range(vocabulary)]
    weight = [1 / (i + 1) for i in range(vocabulary)]
    rows = [(i, " ".join(rng.choices(some, weight, k=rng.randint(1, 60)))) for i in range(n)]
    rows += [(10 * n + i, rows[0][1]) for i in range(copies)]
    return rows, [(j, " ".join(rng.sample(some, rng.randint(1, 15)))) for j in range(25)] + [(99, rows[0][1])]


@pytest.mark.parametrize("seed,copies", [(1, 0), (2, 400), (3, 40)])
def test_blocks_and_shards_change_nothing(spark, seed, copies):
    docs, items = corpus(seed, 700, copies=copies)
    table = frame(spark, [(*r, "x", "s") for r in docs]).repartition(3)
    want = scan(docs, items)
    for shard, block in ((8192, 8), (100, 16), (64, 1000)):
        assert got(search.search(table, items_frame(spark, items), shard=shard, block=block)) == want


def test_items_in_blocks(spark):
    docs, items = corpus(4, 200)
    table = frame(spark, [(*r, "x", "s") for r in docs])
    assert got(search.search(table, items_frame(spark, items), item_terms=40)) == scan(docs, items)


def shard_of(docs, items, block, limit=search.SUMMARY):
    queries = [sorted(set(words(t))) for _, t in items]
    voc = sorted({t for q in queries for t in q})
    number = {t: i for i, t in enumerate(voc)}
    queries = [np.array([number[t] for t in q]) for q in queries]
    asked = [np.unique(np.concatenate([q for q in queries if t in q])) for t in range(len(voc))]
    counted = [{number[t]: c for t, c in collections.Counter(words(x)).items() if t in number} for _, x in docs]
    ptr = np.r_[0, np.cumsum([len(c) for c in counted])]
    term = np.array([t for c in counted for t in c], np.int64)
    df = np.bincount(term, minlength=len(voc))
    impact = search.weights(len(docs), df)[term] * np.array([v for c in counted for v in c.values()], np.int64)
    keep = np.diff(ptr) > 0
    doc = np.array([d for d, _ in docs])[keep]
    ptr = np.r_[0, np.cumsum(np.diff(ptr)[keep])]
    return search.build_shard(doc, ptr, term, impact, asked, block, limit), queries, asked, ptr, term, impact


def test_summaries_are_maxima_and_blocks_partition_lists():
    docs, items = corpus(5, 500)
    x, _, asked, ptr, term, impact = shard_of(docs, items, 16)
    seen = collections.Counter()
    for b, t in enumerate(x["block_term"]):
        members = x["block_doc"][x["block_ptr"][b]:x["block_ptr"][b + 1]]
        assert x["block_least"][b] == x["doc"][members].min()
        seen.update((t, d) for d in members)
        top = collections.Counter()
        for d in members:
            for e in range(ptr[d], ptr[d + 1]):
                top[term[e]] = max(top[term[e]], impact[e])
        a, z = x["sum_ptr"][b], x["sum_ptr"][b + 1]
        if z > a:
            assert x["summary"][a:z].tolist() == [top[c] for c in asked[t]]
    owner = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    assert seen == collections.Counter(zip(term.tolist(), owner.tolist()))


def test_blocks_are_skipped():
    """Two topics that share one common word: a topic's item scores few documents of the other."""
    rng = random.Random(6)
    topic = [[f"{c}{i}" for i in range(40)] for c in "ab"]
    docs = [(i, "common " + " ".join(rng.sample(topic[i % 2], 12))) for i in range(2000)]
    items = [(0, "common " + " ".join(topic[0][:10])), (1, "common " + " ".join(topic[1][:10]))]
    x, queries, asked, *_ = shard_of(docs, items, 32)
    best = [(np.empty(0, np.int64),) * 2 for _ in items]
    scored = search.search_shard(x, queries, asked, best, np.zeros(2, np.int64), 10)
    assert scored < 0.75 * 2 * len(docs)


def test_summary_limit_changes_nothing():
    docs, items = corpus(7, 400)
    found = []
    for limit in (0, 50, search.SUMMARY):
        x, queries, asked, *_ = shard_of(docs, items, 8, limit)
        best = [(np.empty(0, np.int64),) * 2 for _ in items]
        search.search_shard(x, queries, asked, best, np.zeros(len(items), np.int64), 10)
        found.append([(a.tolist(), b.tolist()) for a, b in best])
    assert found[0] == found[1] == found[2]
