"""Operator 4, packing: documents cut into pieces and packed into windows by differencing.

One pass encodes every text, appends the end id and cuts it into full windows and a
remainder of pieces no longer than ``max_piece``. Pieces are dealt by a hash of their row
and start into batches of about ``batch`` pieces, so a batch never grows with the input
and one long document spreads over many. Within a batch Karmarkar-Karp multiway
differencing packs: every piece starts as a partial partition of k windows, the two
partials with the largest spread are merged largest window on smallest, and the last one
left has near-equal windows. k starts at the least possible count and rises while a window
exceeds the capacity; nothing is dropped.

Defined cases: null or empty text is the end id alone; repeated rows and ids are packed
row by row; a null ``doc_id`` is kept; extra columns are not read; an empty table gives no
pieces.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkplate.llm.common import documents, materialise
from sparkplate.llm.tokens import WordEncoder, texts, vocabulary

CAPACITY, END_ID, MAX_PIECE, BATCH = 4096, 2, 1024, 2048
SPANS = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def cut_points(n: int, capacity: int, max_piece: int) -> list[int]:
    """Starts of a document's pieces: full windows first, then even pieces of the rest."""
    full, rest = divmod(n, capacity)
    starts = [i * capacity for i in range(full)]
    parts = -(-rest // max_piece)
    return starts + [full * capacity + rest * i // parts for i in range(parts)]


def pieces(docs: DataFrame, vocab: str, capacity: int = CAPACITY, end_id: int = END_ID,
           max_piece: int = MAX_PIECE) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) of every piece."""
    def cut(batches):
        encoder, end = WordEncoder.of(vocab), np.array([end_id], "<u4").tobytes()
        rows = []

        def flush():
            cols = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                              ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        for doc_id, text in texts(batches):
            ids = encoder.ids(text) + end
            n = len(ids) // 4
            starts = cut_points(n, capacity, max_piece)
            for a, b in zip(starts, [*starts[1:], n]):
                rows.append((doc_id, a, b - a, zlib.crc32(ids[4 * a:4 * b]), n))
            if len(rows) > 20_000:
                yield flush()
                rows.clear()
        if rows:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(cut, SPANS)


def difference(sizes: list[int], k: int) -> tuple[np.ndarray, list[list[int]]]:
    """Karmarkar-Karp over ``k`` windows: (window sums, piece numbers per window).

    A partial partition is its window sums in falling order with a tree node each; windows
    that are still empty are not stored.
    """
    left, right = [], []  # inner nodes, numbered from len(sizes) on
    heap = [(-int(s), i, np.array([s], np.int64), np.array([i], np.int64)) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    count, base = len(sizes), len(sizes)
    while len(heap) > 1:
        _, _, a, na = heapq.heappop(heap)
        _, _, b, nb = heapq.heappop(heap)
        # largest on smallest: b's largest windows go to a's empty ones; where both are
        # full, a's smallest from the end take b's rest in rising order
        over = max(0, len(a) + len(b) - k)
        own, met = slice(len(a) - over, len(a)), slice(len(b) - over, len(b))
        joint = base + len(left) + np.arange(over)
        left.extend(na[own].tolist())
        right.extend(nb[met][::-1].tolist())
        sums = np.concatenate([a[:len(a) - over], a[own] + b[met][::-1], b[:len(b) - over]])
        nodes = np.concatenate([na[:len(a) - over], joint, nb[:len(b) - over]])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        spread = int(sums[0]) - (int(sums[-1]) if len(sums) == k else 0)
        heapq.heappush(heap, (-spread, count, sums, nodes))
        count += 1
    _, _, sums, nodes = heap[0]
    members = []
    for node in nodes.tolist():
        stack, got = [node], []
        while stack:
            x = stack.pop()
            if x < base:
                got.append(x)
            else:
                stack += [left[x - base], right[x - base]]
        members.append(got)
    return sums, members


def fill(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``; the count rises until every window fits."""
    if not sizes:
        return []
    total = sum(sizes)
    k = -(-total // capacity)
    while True:
        sums, members = difference(sizes, k)
        if sums[0] <= capacity:
            return members
        k = max(k + 1, min(len(sizes), -(-total // max(1, 2 * capacity - int(sums[0])))))


def pack(spans: DataFrame, capacity: int = CAPACITY, batch: int = BATCH) -> DataFrame:
    """Give every piece its ``sequence_id`` and ``offset``."""
    spans = materialise(spans.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    batches = max(1, round(spans.count() / batch))

    def arrange(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_row", ignore_index=True)
        small = np.flatnonzero(pdf["length"].to_numpy() < capacity)
        windows = [[i] for i in np.flatnonzero(pdf["length"].to_numpy() >= capacity).tolist()]
        for members in fill(pdf["length"].to_numpy()[small].tolist(), capacity):
            windows.append(sorted(small[members].tolist()))
        sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        lengths = pdf["length"].to_numpy()
        for w, members in enumerate(windows):
            sequence[members] = w
            offset[members] = np.cumsum(lengths[members]) - lengths[members]
        pdf["sequence_id"] = pdf["_batch"].to_numpy() * (1 << 24) + sequence
        pdf["offset"] = offset
        return pdf.drop(columns=["_row", "_batch"])

    dealt = spans.withColumn("_batch", F.pmod(F.xxhash64("_row", "start"), F.lit(batches)).cast("bigint"))
    return dealt.groupBy("_batch").applyInPandas(arrange, f"{SPANS}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str) -> DataFrame:
    return pack(pieces(docs, vocabulary(path)))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
