"""Operator 10, token ids in binary files of patched frame-of-reference blocks.

Documents are range-sorted by id, each range is one shard, and a shard is a run of chunks
(about ``CHUNK`` ids of consecutive documents). A chunk's ids are cut into blocks of 512.
A block stores its minimum, the width that holds ``PERCENTILE`` of its ids less the
minimum, the low bits at that width packed into 64-bit words, and an exception list with
position and high bits of the rest. ``block_starts`` indexes the byte where each block
begins, so a reader decodes only the blocks a document touches.

A chunk is a row of a Parquet container in the shared folder (payload plus its indexes):
Spark's committers write it on any store, and a lost task's attempt never shows. A reader
prunes to the index columns where it needs no ids.

Defined cases: null or empty text is the end id alone; rows of one id follow each other by
a hash of their text; a null id sorts first; an empty table writes no chunks; extra columns
are not read; a document larger than a chunk is a chunk of its own.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkplate.llm.common import documents
from sparkplate.llm.tokens import WordEncoder, texts, vocabulary
from sparkplate.session import checkpoint_dir

BLOCK, CHUNK, PERCENTILE, END_ID = 512, 1 << 18, 0.9, 1
FILE_SCHEMA = ("shard int, chunk int, first_id bigint, n_ids bigint, doc_ids array<bigint>, "
               "doc_tokens array<bigint>, block_starts array<int>, payload binary")
_HEAD = np.dtype([("low", "<u4"), ("width", "u1"), ("exceptions", "<u2")])


def _pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Blocks x 512 values to blocks x (8 * width) words: 64 values fill ``width`` words."""
    v = values.reshape(len(values), BLOCK // 64, 64)
    out = np.zeros((len(values), BLOCK // 64, width), np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        out[:, :, word] |= v[:, :, lane] << np.uint64(shift)
        if shift + width > 64:
            out[:, :, word + 1] |= v[:, :, lane] >> np.uint64(64 - shift)
    return out.reshape(len(values), -1)


def _unpack_bits(words: np.ndarray, width: int) -> np.ndarray:
    w = words.reshape(len(words), BLOCK // 64, width)
    out = np.empty((len(words), BLOCK // 64, 64), np.uint64)
    keep = np.uint64((1 << width) - 1)
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        x = w[:, :, word] >> np.uint64(shift)
        if shift + width > 64:
            x = x | (w[:, :, word + 1] << np.uint64(64 - shift))
        out[:, :, lane] = x & keep
    return out.reshape(len(words), BLOCK)


def encode(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """Unsigned 32-bit ids to (payload, block starts). The last block is filled up with its minimum."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return b"", np.zeros(0, np.int32)
    full = np.full(blocks * BLOCK, ids[(blocks - 1) * BLOCK:].min(), np.uint64)
    full[:n] = ids
    full = full.reshape(blocks, BLOCK)
    low = full.min(axis=1)
    diff = full - low[:, None]
    bound = np.partition(diff, int(percentile * BLOCK) - 1, axis=1)[:, int(percentile * BLOCK) - 1]
    widths = np.array([int(b).bit_length() for b in bound.tolist()], np.uint8)
    high = diff >> widths[:, None].astype(np.uint64)
    exceptions = np.count_nonzero(high, axis=1)
    sizes = _HEAD.itemsize + widths.astype(np.int64) * (BLOCK // 8) + exceptions * 6
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(starts[-1], np.uint8)
    heads = np.zeros(blocks, _HEAD)
    heads["low"], heads["width"], heads["exceptions"] = low, widths, exceptions
    out[starts[:-1, None] + np.arange(_HEAD.itemsize)] = heads.view(np.uint8).reshape(blocks, -1)
    for width in np.unique(widths[widths > 0]).tolist():
        at = np.flatnonzero(widths == width)
        packed = _pack_bits(diff[at] & np.uint64((1 << width) - 1), width).astype("<u8").view(np.uint8)
        out[(starts[at] + _HEAD.itemsize)[:, None] + np.arange(packed.shape[1])] = packed
    b, pos = np.nonzero(high)
    nth = np.arange(len(b)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
    lists = starts[:-1] + _HEAD.itemsize + widths.astype(np.int64) * (BLOCK // 8)
    out[(lists[b] + 2 * nth)[:, None] + np.arange(2)] = pos.astype("<u2").view(np.uint8).reshape(-1, 2)
    out[(lists[b] + 2 * exceptions[b] + 4 * nth)[:, None] + np.arange(4)] = (
        high[b, pos].astype("<u4").view(np.uint8).reshape(-1, 4))
    return out.tobytes(), starts[:-1].astype(np.int32)


def decode(payload: bytes, block_starts: np.ndarray, n: int, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``last`` of a chunk of ``n`` ids; only the blocks they touch are read."""
    last = n if last is None else last
    if first >= last:
        return np.zeros(0, "<u4")
    raw = np.frombuffer(payload, np.uint8)
    b0, b1 = first // BLOCK, -(-last // BLOCK)
    starts = np.asarray(block_starts, np.int64)[b0:b1]
    heads = raw[starts[:, None] + np.arange(_HEAD.itemsize)].copy().view(_HEAD).reshape(-1)
    widths, exceptions = heads["width"].astype(np.int64), heads["exceptions"].astype(np.int64)
    out = np.zeros((len(starts), BLOCK), np.uint64)
    for width in np.unique(widths[widths > 0]).tolist():
        at = np.flatnonzero(widths == width)
        words = raw[(starts[at] + _HEAD.itemsize)[:, None] + np.arange(width * (BLOCK // 8))]
        out[at] = _unpack_bits(words.copy().view("<u8"), width)
    b = np.repeat(np.arange(len(starts)), exceptions)
    nth = np.arange(len(b)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
    lists = starts + _HEAD.itemsize + widths * (BLOCK // 8)
    pos = raw[(lists[b] + 2 * nth)[:, None] + np.arange(2)].copy().view("<u2").reshape(-1)
    high = raw[(lists[b] + 2 * exceptions[b] + 4 * nth)[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
    out[b, pos] |= high.astype(np.uint64) << widths[b].astype(np.uint64)
    out += heads["low"].astype(np.uint64)[:, None]
    return out.reshape(-1)[first - b0 * BLOCK:last - b0 * BLOCK].astype("<u4")


def write_tokens(docs: DataFrame, path: str, vocab: str, end_id: int = END_ID, chunk: int = CHUNK) -> None:
    """Encode ``docs`` in ascending id order and write the chunk files to ``path``."""
    def encode_shard(batches):
        encoder, end = WordEncoder.of(vocab), np.array([end_id], "<u4").tobytes()
        shard, number, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, doc_tokens, parts, held = [], [], [], 0

        def flush():
            payload, starts = encode(np.frombuffer(b"".join(parts), "<u4"))
            row = {"shard": [shard], "chunk": [number], "first_id": [first], "n_ids": [held],
                   "doc_ids": [doc_ids], "doc_tokens": [doc_tokens], "block_starts": [starts.tolist()],
                   "payload": [payload]}
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
                     pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), types)], list(row))
        for doc_id, text in texts(batches):
            ids = encoder.ids(text) + end
            if held and held + len(ids) // 4 > chunk:
                yield flush()
                number, first = number + 1, first + held
                doc_ids, doc_tokens, parts, held = [], [], [], 0
            doc_ids.append(doc_id)
            doc_tokens.append(len(ids) // 4)
            parts.append(ids)
            held += len(ids) // 4
        if held:
            yield flush()

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("_h"), F.monotonically_increasing_id().alias("_r"))
    shards = keyed.repartitionByRange("doc_id", "_h", "_r").sortWithinPartitions("doc_id", "_h", "_r")
    shards.select("doc_id", "text").mapInArrow(encode_shard, FILE_SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)

    def decode_chunks(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode(row["payload"], row["block_starts"], row["n_ids"]).tobytes()
                ends = np.cumsum(row["doc_tokens"])
                starts = ends - row["doc_tokens"]
                crc = [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * len(ends), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                     pa.array(starts + row["first_id"], pa.int64()), pa.array(row["doc_tokens"], pa.int64()),
                     pa.array(crc, pa.int64())], ["shard", "doc_id", "local", "n_tokens", "ids_crc32"])

    decoded = files.mapInArrow(decode_chunks, "shard int, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint")
    sizes = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    offsets = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (decoded.join(F.broadcast(offsets), "shard")
            .select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = f"{checkpoint_dir(spark)}/llm-tokens-{uuid.uuid4().hex}"
    write_tokens(documents(spark, sf_dir), path, vocabulary(public_tokenizers.path("word_bpe_49k.json")))
    return read_tokens(spark, path)
