"""Operator 7, byte-level BPE by Spark higher-order functions, and its decoding.

Encoding a word folds ranked merges over its array of byte ids: in each step the adjacent
pair of lowest rank is looked up for every position in the constant rank map and merged,
until no pair has a rank. The rank map is one constant array, a perfectly hashed table over
pairs of ids, so a look-up takes the same short time wherever the pair is (a map literal
would be searched from its start). The tables reach the plan as a one-row scalar subquery,
which keeps their values out of plan texts and in compact form.

The words of a corpus are counted in full; the most frequent, at most ``HEAD`` of them
(a fixed bound, some megabytes), are folded once by Spark and shipped to the tasks. Spark
splits the texts; a task takes the ids of each word from the head, and folds a word outside
it once, by the same merges in the same order, and keeps its ids (``Known``). So no text,
word or id is shuffled after the count, and a word costs one look-up. Decoding looks every
id up in a constant table of byte strings and concatenates them.

Defined cases: null or empty text has no ids; repeated rows and ids are encoded row by row;
extra columns pass through ``encode``; an empty table has an empty head and no rows.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sparkplate.llm.common import documents, let, materialise

HEAD = 1 << 18
#: Characters of the longest word that is kept, in the head or by a task; longer ones are folded where they stand.
KEPT = 64
#: Words that a task looks up together.
WORDS = 1 << 20
#: Ranks lie below this; a look-up that finds no merge gives a value from here on.
NONE = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def java_pattern(pattern: str) -> str:
    """The split pattern with Unicode white space, as the library reads it."""
    return "(?U)" + pattern


# --- perfectly hashed tables -----------------------------------------------------------

def _displace(bucket: np.ndarray, base: np.ndarray, step: np.ndarray, buckets: int, slots: int) -> np.ndarray:
    """A number per bucket such that ``base + number * step`` (modulo slots) differs for all keys."""
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=buckets)
    starts = np.cumsum(sizes) - sizes
    pairs = list(zip(base[order].tolist(), step[order].tolist()))
    taken, out, mask = bytearray(slots), [0] * buckets, slots - 1
    for b in np.argsort(-sizes, kind="stable").tolist():
        n = int(sizes[b])
        if not n:
            break
        keys = pairs[starts[b]:starts[b] + n]
        for number in range(1 << 22):
            places = {(k + number * s) & mask for k, s in keys}
            if len(places) == n and not any(taken[x] for x in places):
                break
        else:
            raise RuntimeError("two keys hash alike")
        for x in places:
            taken[x] = 1
        out[b] = number
    return np.array(out, np.int64)


def _sizes(n: int) -> tuple[int, int]:
    """(buckets, slots), powers of two: about four keys a bucket, slots at most half full."""
    bits = max(4, int(2 * n).bit_length())
    return 1 << (bits - 3), 1 << bits


#: Factors that spread a pair of ids; with ids below 2^20 the sum stays below 2^63.
_LEFT, _RIGHT = 0x1E3779B97F5, 0x2C9277B5AB3


@functools.lru_cache(maxsize=4)
def _rank_table(path: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """(displacements, slots); a slot is (left id, right id) * 2^20 + rank of the merge."""
    ranks = read_ranks(path)
    pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items()
             for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    left, right, rank = np.array(pairs, np.int64).T
    mixed = left * _LEFT + right * _RIGHT
    buckets, slots = _sizes(len(mixed))
    bucket, base, step = (mixed >> 39) & (buckets - 1), (mixed >> 20) & (slots - 1), (mixed & (NONE - 1)) | 1
    number = _displace(bucket, base, step, buckets, slots)
    table = np.full(slots, 1 << 61, np.int64)
    table[(base + number[bucket] * step) & (slots - 1)] = (left << 40) + (right << 20) + rank
    return tuple(number.tolist()), tuple(table.tolist())


def _merge_rank(t: Column, slots: tuple[int, int], a: Column, b: Column) -> Column:
    """Rank of the merge of two ids (bigint), NONE or more if there is none.

    The slot's key part cancels out against the pair, which leaves the rank.
    """
    mixed = a * F.lit(_LEFT) + b * F.lit(_RIGHT)
    bucket = F.shiftright(mixed, 39).bitwiseAND(F.lit(slots[0] - 1)).cast("int")
    step = mixed.bitwiseAND(F.lit(NONE - 1)).bitwiseOR(F.lit(1))
    slot = (F.shiftright(mixed, 20) + F.get(t["moves"], bucket) * step).bitwiseAND(F.lit(slots[1] - 1)).cast("int")
    return F.get(t["merges"], slot).bitwiseXOR(F.shiftleft(a, 40) + F.shiftleft(b, 20))


# --- folding ---------------------------------------------------------------------------

def _fold(word: Column, t: Column, slots: tuple[int, int]) -> Column:
    """Ids of one word: merge the lowest-ranked pair until none is left."""
    def ranks(ids: Column) -> Column:
        return F.transform(F.slice(ids, 1, F.size(ids) - 1),
                           lambda a, i: _merge_rank(t, slots, a, F.get(ids, i + 1)))

    def many(ids: Column, rank: Column, low: Column) -> Column:
        """Every occurrence of the pair from the left, none overlapping: of adjoining
        places (a pair of equal ids) every second one counts."""
        places = F.filter(F.transform(rank, lambda r, i: F.when(r == low, i).otherwise(F.lit(-1))), lambda i: i >= 0)
        chosen = let(places, lambda at: let(F.transform(at, lambda p, j: p - j), lambda d: F.filter(
            at, lambda p, j: ((j - F.array_position(d, p - j) + 1) % 2) == 0)))
        return let(chosen, lambda c: F.filter(F.transform(ids, lambda x, i: F.when(F.array_contains(c, i), low)
                   .when(F.array_contains(c, i - 1), F.lit(-1).cast("bigint")).otherwise(x)), lambda x: x >= 0))

    def pair(ids: Column) -> Column:
        return F.struct(ids.alias("ids"), ranks(ids).alias("rank"))

    def spliced(ids: Column, rank: Column, low: Column, p: Column) -> Column:
        """The pair at ``p`` merged: only the two pairs next to it have new ranks."""
        beside = F.array_compact(F.array(_merge_rank(t, slots, F.get(ids, p - 2), low),
                                         _merge_rank(t, slots, low, F.get(ids, p + 1))))
        return F.struct(F.concat(F.slice(ids, 1, p - 1), F.array(low), F.slice(ids, p + 2, F.size(ids))).alias("ids"),
                        F.concat(F.slice(rank, 1, F.greatest(p - 2, F.lit(0))), beside,
                                 F.slice(rank, p + 2, F.size(rank))).alias("rank"))

    def merged(ids: Column, rank: Column, low: Column) -> Column:
        return let(F.array_position(rank, low).cast("int"), lambda p: F.when(
            F.array_contains(F.slice(rank, p + 1, F.size(rank)), low),
            let(many(ids, rank, low), pair)).otherwise(spliced(ids, rank, low, p)))

    def step(state: Column, _: Column) -> Column:
        done = F.struct(state["ids"].alias("ids"), F.array().cast("array<bigint>").alias("rank"))
        return let(F.array_min(state["rank"]), lambda low: F.when(low.isNull(), state).when(low >= NONE, done).otherwise(
            merged(state["ids"], state["rank"], low)))

    # one character per byte
    chars = F.split(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), "")
    start = F.transform(chars, lambda c: F.get(t["bytes"], F.ascii(c)))
    return let(start, lambda ids: F.aggregate(
        F.slice(ids, 2, F.size(ids)), pair(ids), step, lambda s: s["ids"]))


def fold_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: always merge the lowest-ranked pair, the leftmost of equal ones.

    A pair is named by its place and end, which only grow. The heap keeps long words at
    ``n log n`` steps; a word that is a token is its own id, as in the library.
    """
    n = len(word)
    if word in ranks:
        return [ranks[word]]
    end, before = [*range(1, n + 1)], [*range(-1, n)]  # of the piece that starts here; end 0: merged away
    pairs = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(pairs)
    while pairs:
        _, i, stop = heapq.heappop(pairs)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle], before[stop] = stop, 0, i
        if stop < n and (r := ranks.get(word[i:end[stop]])) is not None:
            heapq.heappush(pairs, (r, i, end[stop]))
        if i and (r := ranks.get(word[before[i]:stop])) is not None:
            heapq.heappush(pairs, (r, before[i], stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i:end[i]]])
        i = end[i]
    return ids


class Known(dict):
    """A task's words and their ids, joined by commas: the head, and the words met outside it.

    ``most`` bounds the words kept; beyond it those outside the head are forgotten, which
    costs time only.
    """

    @classmethod
    def of(cls, name: str, ranks: dict[bytes, int], head: bytes) -> Known:
        """The worker's table of this name: Spark reuses Python workers, so later tasks find
        the words of earlier ones."""
        kept = sys.__dict__.setdefault("_sparkplate_words", {})
        if name not in kept:
            kept.clear()
            kept[name] = cls(ranks, head)
        return kept[name]

    def __init__(self, ranks: dict[bytes, int], head: bytes, most: int = 400_000):
        self.ranks, self.head, self.most = ranks, head, most
        self.begin()

    def begin(self) -> None:
        self.clear()
        if self.head:
            self.update(zip(*(c.to_numpy() for c in pa.ipc.open_stream(self.head).read_all().columns)))
        self.limit = len(self) + self.most

    def __missing__(self, word: str) -> str:
        ids = ",".join(map(str, fold_bytes(word.encode(), self.ranks)))
        if len(word) <= KEPT:
            if len(self) >= self.limit:
                self.begin()
            self[word] = ids
        return ids

    def told(self, words: pa.ListArray) -> Iterator[pa.Array]:
        """Ids of each list of words, joined by commas; the lists are taken in runs of about
        ``WORDS`` words, and each distinct word of a run is looked up once."""
        starts = words.offsets.to_numpy()
        a = 0
        while a < len(words):
            b = max(a + 1, int(np.searchsorted(starts, starts[a] + WORDS, "right")) - 1)
            coded = words.values[starts[a]:starts[b]].dictionary_encode()
            ids = pa.array([self[w] for w in coded.dictionary.to_numpy(zero_copy_only=False)], pa.string())
            yield pc.binary_join(pa.ListArray.from_arrays(starts[a:b + 1] - starts[a], ids.take(coded.indices)), ",")
            a = b


class Encoder:
    """Encoding and decoding by one rank file, with an optional head of ready words.

    The tables of merges and pieces are one-row frames in the shared folder. ``bind`` puts
    them beside a frame's columns as scalar subqueries; the expressions use each of them once,
    so the optimiser takes the subquery into the expression and no row carries a table.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.pattern = java_pattern(pattern)
        moves, merges = _rank_table(path)
        self.slots = (len(moves), len(merges))
        self.ranks = ranks = read_ranks(path)
        pieces = [""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token.hex()
        self.tables = materialise(spark.createDataFrame(
            [(list(moves), list(merges), [ranks[bytes([b])] for b in range(256)], pieces)],
            "moves array<bigint>, merges array<bigint>, bytes array<bigint>, pieces array<string>"), "bpe-tables")
        self.head = b""

    def bind(self, df: DataFrame) -> DataFrame:
        tables = [self.tables.select(F.struct("moves", "merges", "bytes")).scalar().alias("_merges"),
                  self.tables.select("pieces").scalar().alias("_pieces")]
        return df.select(*[c for c in df.columns if c not in ("_merges", "_pieces")], *tables)

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({self.pattern})"))

    def word_ids(self, word: Column) -> Column:
        """Ids of one word of a bound frame, joined by commas."""
        return let(F.col("_merges"), lambda t: F.array_join(_fold(word, t, self.slots), ","))

    def learn(self, docs: DataFrame, head: int = HEAD) -> None:
        """Count all words of ``docs``, fold the most frequent ones and keep them as a table.

        The cut is a count such that at most ``head`` words reach it, read off the
        histogram of counts, so only the head's words, of bounded length, come to the driver.
        """
        counts = materialise(docs.select(F.explode(self.words(F.col("text"))).alias("word"))
                             .groupBy("word").agg(F.count("*").alias("n")), "words").where(F.length("word") <= KEPT)
        seen, least = 0, None
        for row in counts.groupBy("n").agg(F.count("*").alias("c")).orderBy(F.desc("n")).limit(head).toLocalIterator():
            seen += row["c"]
            if seen > head:
                break
            least = row["n"]
        if least is None:
            return
        chosen = counts.where(F.col("n") >= least).select("word").repartition("word")
        found = self.bind(chosen).select("word", self.word_ids(F.col("word")).alias("ids")).toArrow()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, found.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(found)
        self.head = sink.getvalue().to_pybytes()

    def told(self, df: DataFrame, *own: str) -> DataFrame:
        """The columns ``own`` of ``df`` and ``_told``, the ids of the whole ``text``, joined by commas."""
        ranks, head = self.ranks, self.head
        name = hashlib.sha256(repr(sorted(ranks.items())).encode() + head).hexdigest()
        split = df.select(*own, self.words(F.col("text")).alias("_told"))

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Known.of(name, ranks, head)
            for b in batches:
                at = 0
                for ids in known.told(b.column(len(own))):
                    rows = b.slice(at, len(ids))
                    yield pa.RecordBatch.from_arrays([*rows.columns[:-1], ids], [*own, "_told"])
                    at += len(ids)

        return split.mapInArrow(look_up, StructType([*split.schema.fields[:-1], StructField("_told", StringType())]))

    def decoded(self, ids: Column) -> Column:
        """Bytes of an array of ids of a bound frame: their binary pieces one after the other."""
        return let(F.col("_pieces"), lambda p: F.unhex(
            F.array_join(F.transform(ids, lambda i: F.get(p, i)), "")))


def ids_of(ids_text: Column) -> Column:
    return F.when(ids_text == "", F.array().cast("array<int>")).otherwise(F.split(ids_text, ",").cast("array<int>"))


def encode(docs: DataFrame, encoder: Encoder) -> DataFrame:
    """``docs`` plus ``ids``, the token ids of ``text``."""
    own = [c for c in docs.columns if c not in ("ids", "_told")]
    return encoder.told(docs, *own).select(*own, ids_of(F.col("_told")).alias("ids"))


def decode(encoded: DataFrame, encoder: Encoder) -> DataFrame:
    """``encoded`` plus ``bytes``, what the array ``ids`` stands for."""
    own = [c for c in encoded.columns if c != "bytes"]
    return encoder.bind(encoded.select(*own)).select(*own, encoder.decoded(F.col("ids")).alias("bytes"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    docs = documents(spark, sf_dir).select("doc_id", "text")
    encoder = Encoder(spark, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    encoder.learn(docs)
    told = encoder.told(docs, "doc_id").withColumnRenamed("_told", "told")
    back = decode(told.select("doc_id", "told", ids_of(F.col("told")).alias("ids")), encoder)
    return back.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2("told", 256).alias("ids_sha256"),
                       F.sha2("bytes", 256).alias("decoded_sha256"))
