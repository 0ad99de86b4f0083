"""Operator 12, ranked lexical search over posting lists that are blocked geometrically.

Documents are dealt into shards of ``SHARD``. In a shard every asked term has its posting
list; a list of more than ``BLOCK`` documents is clustered by document similarity (each
document goes to the most similar of the list's pivots, by a projection of its impact
vector), and each cluster is a block with a summary: the coordinatewise maximum of its
documents' impacts. A summary keeps the coordinates that an item can ask together with the
list's own term; no other coordinate can enter a bound. The sum of a summary over an item's
terms bounds the score of every document in the block, so a block is skipped only when that
sum is below the item's tenth best score so far (or equal, with later ids only). All else is
scored exactly, in 64-bit integers, and results equal a full scan.

Statistics (documents, lengths, document frequencies) come from all documents. Items are
asked in blocks of about ``ITEM_TERMS`` terms, the only thing broadcast. ``SHARD``, ``BLOCK``,
``SUMMARY`` (largest summary of a list; a larger one is not kept and its list always scored)
and ``SEEDS`` (shards that are searched first for starting thresholds) are bounds on memory or
time, none on results.

Defined cases: null and term-less texts count in no statistic and match nothing; a null
``doc_id`` ranks after all ids and is returned as null (the largest bigint stands for it);
repeated rows are documents of their own; rows of one ``item_id`` are one item that asks the
terms of all of them, a null ``item_id`` is an id; items without terms and empty tables give no
rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkplate.llm.common import documents, materialise

SHARD = 4096
BLOCK = 128
SUMMARY = 4_000_000
ITEM_TERMS = 100_000
SEEDS = 8
BIG = 2**63 - 1

#: Letters, digits and everything beyond ASCII make up terms; only A-Z is lower-cased.
TERM_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: Column) -> Column:
    """The distinct terms of a text."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_distinct(F.array_remove(F.split(low, TERM_BREAK), ""))


# --- forward rows and statistics ---------------------------------------------------------

def forward(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc, n, terms, tfs): a document's length and its counts of the vocabulary's terms."""
    number = {t.encode(): i for i, t in enumerate(vocabulary)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = number.get
        for batch in batches:
            sizes, lists, tfs, ends = [], [], [], [0]
            for text in pc.cast(batch.column(1), pa.binary()):
                found = (text.as_py() or b"").translate(_FOLD).split()
                held = Counter(map(get, found))
                held.pop(None, None)
                sizes.append(len(found))
                lists.extend(held)
                tfs.extend(held.values())
                ends.append(len(lists))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(lists, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32()))], ["doc", "n", "terms", "tfs"])

    keyed = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(BIG)).alias("doc"), F.col("text"))
    return keyed.mapInArrow(count, "doc bigint, n bigint, terms array<int>, tfs array<int>")


def weights(n_docs: int, frequency: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)


# --- one shard ---------------------------------------------------------------------------

def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start .. start + size of every entry, one after the other."""
    if not len(sizes):
        return np.empty(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)


def _cluster(vectors: np.ndarray, block: int) -> np.ndarray:
    """A block number for every document of a list: nearest of evenly spaced pivots, large clusters cut."""
    n = len(vectors)
    pivots = vectors[np.linspace(0, n - 1, -(-n // block)).astype(int)]
    nearest = np.argmax(vectors @ pivots.T, axis=1)
    order = np.argsort(nearest, kind="stable")
    sizes = np.bincount(nearest, minlength=len(pivots))
    within = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    piece = nearest[order] * (n // block + 2) + within // (2 * block)
    out = np.empty(n, np.int64)
    out[order] = np.unique(piece, return_inverse=True)[1]
    return out


def build_shard(doc: np.ndarray, ptr: np.ndarray, term: np.ndarray, impact: np.ndarray, asked: list[np.ndarray],
                block: int = BLOCK, limit: int = SUMMARY) -> dict:
    """The index of a shard; ``asked[t]``: the terms that some item asks together with ``t``, sorted."""
    sizes = np.diff(ptr)
    owner = np.repeat(np.arange(len(doc)), sizes)
    axes = np.random.default_rng(12).standard_normal((len(asked), 24)).astype(np.float32)
    vectors = np.stack([np.add.reduceat(axis[term] * impact.astype(np.float32), ptr[:-1]) for axis in axes.T], axis=1)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-20)
    place = np.full(len(asked), -1)  # a term's coordinate in the summaries of the present list
    order = np.argsort(term, kind="stable")
    present, first, held = np.unique(term[order], return_index=True, return_counts=True)
    list_docs, list_ptr, list_term, least, summary, sum_ptr, sum_width = [], [0], [], [], [], [0], []
    for t, a, m in zip(present, first, held):
        members = owner[order[a:a + m]]
        width = len(asked[t])
        parts = 0
        if m > block:
            piece = _cluster(vectors[members], block)
            parts = int(piece.max()) + 1
        if parts * width > limit:
            parts = 0
        if not parts:  # short: no summary, always scored
            list_docs.append(members)
            list_ptr.append(list_ptr[-1] + m)
            list_term.append(t)
            least.append(doc[members].min())
            sum_ptr.append(sum_ptr[-1])
            continue
        place[asked[t]] = np.arange(width)
        at = _ragged(ptr[members], sizes[members])
        where = place[term[at]]
        good = np.flatnonzero(where >= 0)
        top = np.zeros(parts * width, np.int64)
        np.maximum.at(top, np.repeat(piece * width, sizes[members])[good] + where[good], impact[at[good]])
        place[asked[t]] = -1
        by = np.argsort(piece, kind="stable")
        list_docs.append(members[by])
        ends = np.cumsum(np.bincount(piece, minlength=parts))
        list_ptr.extend(list_ptr[-1] + ends)
        list_term.extend([t] * parts)
        least.extend(np.minimum.reduceat(doc[members[by]], np.r_[0, ends[:-1]]))
        summary.append(top)
        sum_ptr.extend(sum_ptr[-1] + width * np.arange(1, parts + 1))
    return {"doc": doc, "ptr": ptr.astype(np.int64), "term": term.astype(np.int32), "impact": impact,
            "block_term": np.array(list_term, np.int32), "block_ptr": np.array(list_ptr, np.int64),
            "block_doc": np.concatenate(list_docs or [np.empty(0, np.int64)]).astype(np.int32),
            "block_least": np.array(least, np.int64),
            "sum_ptr": np.array(sum_ptr, np.int64), "summary": np.concatenate(summary or [np.empty(0, np.int64)])}


def _merge(best: tuple[np.ndarray, np.ndarray], score: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    score, doc = np.concatenate([best[0], score]), np.concatenate([best[1], doc])
    first = np.lexsort((doc, -score))[:k]
    return score[first], doc[first]


def search_shard(x: dict, items: list[np.ndarray], asked: list[np.ndarray], best: list, floor: np.ndarray, k: int) -> int:
    """Bring every item's ``best`` (scores, ids) up to date with a shard; gives the number of documents scored.

    ``floor``: scores that the item's results are known to reach, below which nothing counts."""
    sizes = np.diff(x["ptr"])
    wanted, score_of, scored = np.zeros(len(asked), bool), np.zeros(len(x["doc"]), np.int64), 0
    lists = np.searchsorted(x["block_term"], np.arange(len(asked) + 1))
    for i, item in enumerate(items):
        wanted[item] = True
        done = np.zeros(len(x["doc"]), bool)

        def score(blocks: np.ndarray) -> None:
            nonlocal scored
            if not len(blocks):
                return
            a = x["block_ptr"][blocks]
            new = np.unique(x["block_doc"][_ragged(a, x["block_ptr"][blocks + 1] - a)])
            new = new[~done[new]]
            if not len(new):
                return
            done[new] = True
            scored += len(new)
            at = _ragged(x["ptr"][new], sizes[new])
            part = np.where(wanted[x["term"][at]], x["impact"][at], 0)
            total = np.add.reduceat(part, np.cumsum(sizes[new]) - sizes[new])
            good = (total > 0) & (total >= floor[i])
            best[i] = _merge(best[i], total[good], x["doc"][new][good], k)

        plain, some, bounds = [], [], []
        for t in item:
            a, b = lists[t], lists[t + 1]
            if a == b:
                continue
            if x["sum_ptr"][a] == x["sum_ptr"][a + 1]:
                plain.append(a)
                continue
            table = x["summary"][x["sum_ptr"][a]:x["sum_ptr"][b]].reshape(b - a, -1)
            some.append(np.arange(a, b))
            bounds.append(table[:, np.searchsorted(asked[t], item)].sum(axis=1))
        score(np.array(plain, np.int64))
        if some:
            some, bounds = np.concatenate(some), np.concatenate(bounds)
            order = np.argsort(-bounds, kind="stable")
            for a, b in ((0, 2), (2, 8), (8, 32), (32, len(order))):
                part = order[a:b]
                low = max(int(floor[i]), 1)
                keep = bounds[part] >= low
                if len(best[i][0]) == k:
                    last, last_doc = best[i][0][-1], best[i][1][-1]
                    keep &= (bounds[part] > last) | ((bounds[part] == last) & (x["block_least"][some[part]] < last_doc))
                score(some[part[keep]])
        wanted[item] = False
    return scored


# --- the index and its search ------------------------------------------------------------

def pack(x: dict) -> bytes:
    """A shard's arrays, compressed: executors move and hold packed shards, a task opens one at a time."""
    batch = pa.RecordBatch.from_arrays([pa.array([v], pa.list_(pa.from_numpy_dtype(v.dtype))) for v in x.values()], list(x))
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def unpack(packed: pa.Scalar) -> dict:
    batch = pa.ipc.open_stream(packed.as_buffer()).read_next_batch()
    return {name: batch.column(i)[0].values.to_numpy() for i, name in enumerate(batch.schema.names)}


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and sizes of a list column."""
    return column.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(column).to_numpy(zero_copy_only=False)


def build_index(rows: DataFrame, weight: np.ndarray, n_docs: int, length: int, asked: list[np.ndarray],
                shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """One row per shard of ``forward`` rows that hold asked terms."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, shard - waiting)
                held.append(part)
                waiting += part.num_rows
                batch = batch.slice(part.num_rows)
                if waiting == shard:
                    yield one(held)
                    held, waiting = [], 0
        if held:
            yield one(held)

    def one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        doc, n = (table[c].to_numpy() for c in ("doc", "n"))
        term, sizes = _flat(table["terms"].combine_chunks())
        tf = _flat(table["tfs"].combine_chunks())[0].astype(np.int64)
        m = np.repeat(10 + 90 * n * n_docs // length, sizes)
        impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
        x = build_shard(doc, np.r_[0, np.cumsum(sizes)], term, impact, asked, block)
        return pa.RecordBatch.from_arrays([pa.array([int(doc.min() % 1_000_003)], pa.int32()), pa.array([pack(x)], pa.binary())],
                                          ["pick", "shard"])

    return rows.where("size(terms) > 0").mapInArrow(build, "pick int, shard binary")


def search_index(index: DataFrame, items: list[np.ndarray], asked: list[np.ndarray], k: int, floor: np.ndarray) -> DataFrame:
    """(item, doc, score): each task's best ``k`` documents of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in items]
        for batch in batches:
            for packed in batch.column(0):
                search_shard(unpack(packed), items, asked, best, floor, k)
        number = np.repeat(np.arange(len(items)), [len(b[0]) for b in best])
        yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32())] + [
            pa.array(np.concatenate([b[c] for b in best] or [np.empty(0, np.int64)]), pa.int64()) for c in (1, 0)],
            ["item", "doc", "score"])

    return index.select("shard").mapInArrow(run, "item int, doc bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _ask(docs: DataFrame, asked_items: list, k: int, shard: int, block: int) -> DataFrame:
    """Results of one block of items: rows of (item_id, terms)."""
    spark = docs.sparkSession
    vocabulary = sorted({t for row in asked_items for t in row["terms"]})
    number = {t: i for i, t in enumerate(vocabulary)}
    items = [np.array(sorted(number[t] for t in row["terms"]), np.int64) for row in asked_items]
    holders = [[] for _ in vocabulary]
    for i, item in enumerate(items):
        for t in item:
            holders[t].append(i)
    same: dict[tuple, np.ndarray] = {}  # terms that the same items ask share one array
    for held_by in map(tuple, holders):
        if held_by not in same:
            same[held_by] = np.unique(np.concatenate([items[i] for i in held_by]))
    asked = [same[tuple(held_by)] for held_by in holders]

    rows = materialise(forward(docs, vocabulary), "search-forward")
    total = rows.where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()
    n_docs, length = total["docs"], total["length"] or 1
    held = rows.select(F.explode("terms").alias("term")).groupBy("term").count()
    frequency = np.zeros(len(vocabulary), np.int64)
    for row in held.toLocalIterator():  # one row for each asked term
        frequency[row["term"]] = row["count"]
    index = materialise(build_index(rows, weights(n_docs, frequency), n_docs, length, asked, shard, block), "search-index")
    count = index.count()
    first = F.col("pick") % max(1, count // SEEDS) == 0
    floor = np.zeros(len(items), np.int64)
    if count > 2 * SEEDS:  # a few shards give thresholds for the rest
        seeds = materialise(_best(search_index(index.where(first), items, asked, k, floor), k).drop("rank"), "search-seeds")
        for row in seeds.groupBy("item").agg(F.min("score").alias("least"), F.count("*").alias("n")).toLocalIterator():
            if row["n"] == k:  # one row for each item
                floor[row["item"]] = row["least"]
        found = seeds.unionByName(search_index(index.where(~first), items, asked, k, floor))
    else:
        found = search_index(index, items, asked, k, floor)
    names = spark.createDataFrame([(i, row["item_id"]) for i, row in enumerate(asked_items)], "item int, item_id bigint")
    return _best(found, k).join(F.broadcast(names), "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"),
        F.when(F.col("doc") < BIG, F.col("doc")).alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, shard: int = SHARD, block: int = BLOCK,
           item_terms: int = ITEM_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    wanted = materialise(items.select(F.col("item_id").cast("bigint").alias("item_id"), F.explode(terms(F.col("text"))).alias("term"))
                         .distinct().groupBy("item_id").agg(F.collect_list("term").alias("terms")), "search-items")
    pairs = wanted.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-pairs // item_terms))
    out = None
    for b in range(blocks):
        # about item_terms terms reach the driver and the tasks at once
        part = list(wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toLocalIterator())
        if part:
            got = _ask(docs, part, k, shard, block)
            got = materialise(got, "search-found") if blocks > 1 else got
            out = got if out is None else out.unionByName(got)
    return out if out is not None else spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item against all documents."""
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (SELECT r, doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
lengths AS (SELECT r, count(*) AS n FROM words GROUP BY r),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY r, doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), whole),
part AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))) AS s
         FROM tf JOIN w USING (term) JOIN lengths USING (r), whole),
scores AS (SELECT item_id, r, doc_id, CAST(sum(s) AS BIGINT) AS score FROM part JOIN asked USING (term) GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
