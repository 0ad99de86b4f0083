"""Operator 9, removal of repeated 50-byte strings by blockwise sorting of cover suffixes.

A byte goes when a 50-byte string that covers it also starts in a document with a smaller
id. A suffix array finds such strings by sorting suffixes; here, as in difference-cover
construction, only the suffixes at cover positions enter a sort, block by block:

* The cover holds, for every 50-byte string, the place of its smallest 24-byte hash. Equal
  strings have their cover place at the same offset, which is what a difference cover
  provides, at about 2 / 28 of all places and without aligning documents.
* Cover ranks: a first shuffle of (hash, text digest) tells which cover strings occur in two
  different texts. All other suffixes are settled without a further look.
* Blocks: the surviving cover suffixes are dealt by rank (hash) with the bytes of the
  strings they stand for; sorted by Spark, the blocks stream through a task and each is
  sorted on its own by a 64-bit hash. Equal strings meet, their bytes are compared, and all
  but those of the smallest id are marked. A rank held more than ``HOT`` times is dealt into
  several blocks by the bytes around it. Of equal bytes only those of the smallest id enter a
  block, the others are marked whole: most of them in the task that cut them, the rest as the
  sorted block streams by. Strings unmarked in their block are then sorted by their bytes
  across blocks, and one sweep marks all but the first id of equal ones.

Exact copies of a smaller document are settled by digest before. Texts travel compressed.

Defined cases: null text is empty; texts under 50 bytes lose nothing; a null ``doc_id``
counts as larger than any; rows of one id do not remove from each other; extra columns pass
through ``remove_repeats``; an empty table stays empty. In the text that stays, bytes of a
character that was cut in two are dropped.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkplate.llm.common import documents, materialise

WINDOW, GRAM = 50, 24
SPAN = WINDOW - GRAM + 1  # grams in a window
_RANGE = ["doc", "nth", "start", "stop"]
_LENGTH_BITS = (WINDOW + SPAN).bit_length()
HOT, SEGMENT, SLICE = 4096, 1 << 19, 1 << 14
SEEN = 100_000  # bytes around hot ranks that a task remembers
_U = np.uint64
_BYTE = np.random.default_rng(50).integers(1, 1 << 63, 256).astype(np.uint64) * _U(2) + _U(1)
_FACTORS = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_PLACE = 28  # low bits of a sort key that hold the place within a segment


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _FACTORS[0]
    return h ^ (h >> _U(29))


def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every run of ``size`` bytes, by doubling runs."""
    runs, step, h = {}, 1, _BYTE[data]
    while True:
        runs[step] = h
        if step * 2 > size:
            break
        h = _mix(h[:-step] * _FACTORS[1] + h[step:]) if len(h) > step else h[:0]
        step *= 2
    out, done = None, 0
    for step in sorted(runs, reverse=True):
        if size & step:
            part = runs[step][done:]
            out = part if out is None else out[:len(part)] * _FACTORS[2] + part[:len(out)]
            done += step
    return out[:max(0, len(data) - size + 1)]


def cover(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cover places of texts laid end to end: (place, hash, first window, last window).

    ``ends`` are the texts' ends. A window belongs to the place of its smallest hash, the
    first one of equal hashes; windows that reach over a text's end do not count.
    """
    none = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return none, none.astype(np.uint64), none, none
    h = _mix(_hashes(data, GRAM))
    low = (h >> _U(_PLACE) << _U(_PLACE)) | np.arange(len(h), dtype=np.uint64)
    step = 1
    while step * 2 <= SPAN:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if SPAN > step:
        low = np.minimum(low[:len(low) - (SPAN - step)], low[SPAN - step:])
    place = (low & _U((1 << _PLACE) - 1)).astype(np.int64)
    valid = np.zeros(len(data) + 1, np.int32)
    starts = np.concatenate([[0], ends[:-1]])
    long = ends - starts >= WINDOW
    np.add.at(valid, starts[long], 1)
    np.add.at(valid, ends[long] - WINDOW + 1, -1)
    window = np.flatnonzero(np.cumsum(valid)[:len(place)] > 0)
    place = place[window]
    if not len(place):
        return none, none.astype(np.uint64), none, none
    cut = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([cut[1:], [len(place)]]) - 1
    return place[cut], h[place[cut]], window[cut], window[last]


def _key(h: np.ndarray) -> np.ndarray:
    """The 48 bits of a cover hash by which suffixes are ranked and dealt."""
    return (h >> _U(16)).astype(np.int64)


def _segments(texts):
    """Runs of (row, bytes, offset) of about SEGMENT bytes; a longer text comes in parts that
    overlap by a window less one byte, so that every window lies in exactly one part."""
    held, size = [], 0
    for row, raw in texts:
        for at in range(0, max(1, len(raw) - WINDOW + 1), SEGMENT):
            part = raw[at:at + SEGMENT + WINDOW - 1] if at or len(raw) > SEGMENT + WINDOW else raw
            if held and size + len(part) > SEGMENT:
                yield held
                held, size = [], 0
            held.append((row, part, at))
            size += len(part)
    if held:
        yield held


def _covered(texts):
    """Per segment: its (row, bytes, offset) parts, then for every cover place the hash, the
    first and last window (within the part) and the number of the part."""
    for held in _segments(texts):
        raws = [raw for _, raw, _ in held]
        sizes = np.array([len(r) for r in raws])
        ends = np.cumsum(sizes)
        place, h, first, last = cover(np.frombuffer(b"".join(raws), np.uint8), ends)
        part = np.searchsorted(ends, place, side="right")
        base = (ends - sizes)[part]
        yield held, h, first - base, last - base, part


def _identified(docs: DataFrame) -> DataFrame:
    """(doc, dig, text): id with null as the largest, 64-bit digest, text with null as empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc"), F.xxhash64(text).alias("dig"), text.alias("text"))


def _shared(named: DataFrame) -> DataFrame:
    """(key, dig, n): cover ranks that occur in two different texts, per text."""
    def ranks(batches):
        seen: set[int] = set()
        for batch in batches:
            def fresh():
                for dig, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if dig not in seen and len(text) >= WINDOW // 4:
                        seen.add(dig)
                        yield dig, text.encode()
            if len(seen) > 500_000:
                seen.clear()
            for parts, h, _, _, part in _covered(fresh()):
                digs = np.array([dig for dig, _, _ in parts], np.int64)[part]
                yield pa.RecordBatch.from_arrays([pa.array(_key(h)), pa.array(digs)], ["key", "dig"])

    same = Window.partitionBy("key")
    rows = named.select("dig", "text").mapInArrow(ranks, "key bigint, dig bigint")
    return (rows.withColumn("a", F.min("dig").over(same)).withColumn("b", F.max("dig").over(same))
            .withColumn("n", F.count("*").over(same)).where("a <> b").select("key", "dig", "n"))


def _packed(named: DataFrame, *more: str) -> DataFrame:
    """``named`` with compressed text, ``raw``; texts are shuffled in this form."""
    kept = ["doc", "dig", *more]

    def shrink(batches):
        small = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            raw = [small.compress(t.encode()) for t in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(raw, pa.binary())], [*kept, "raw"])

    chosen = named.select(*kept, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(shrink, f"{schema}, raw binary")


def _suffixes(texts: DataFrame) -> DataFrame:
    """(key, block, hot, doc, nth, first, stop, bytes): the strings each shared cover suffix stands
    for. Bytes of a hot rank that the task has seen with a smaller id are left out: all strings
    from ``first`` to ``stop`` are marked already."""
    names = ["key", "block", "hot", "doc", "nth", "first", "stop", "bytes"]

    def cut(batches):
        big = zstandard.ZstdDecompressor()
        seen: dict[tuple[int, bytes], int] = {}
        for batch in batches:
            rows = batch.to_pylist()
            wanted = [np.array(r["keys"], np.int64) for r in rows]
            hot = [{h["key"]: h["blocks"] for h in r["hot"]} for r in rows]
            raws = ((i, big.decompress(r["raw"])) for i, r in enumerate(rows))
            for parts, h, first, last, part in _covered(raws):
                key = _key(h)
                out = [[] for _ in names]
                bounds = np.searchsorted(part, np.arange(len(parts) + 1))
                for (i, raw, at), a, b in zip(parts, bounds[:-1], bounds[1:]):
                    keep = a + np.flatnonzero(np.isin(key[a:b], wanted[i]))
                    stop = np.ma.masked_all(len(keep), np.int64)
                    doc, strings = rows[i]["doc"], [raw[x:y + WINDOW] for x, y in zip(first[keep].tolist(), last[keep].tolist())]
                    blocks = np.zeros(len(keep), np.int32)
                    is_hot = np.isin(key[keep], list(hot[i]))
                    for j in np.flatnonzero(is_hot).tolist():
                        name = int(key[keep[j]]), strings[j]
                        if seen.setdefault(name, doc) < doc:
                            blocks[j], strings[j] = (doc * 0x9E3779B1 >> 16) % hot[i][name[0]], None
                            stop[j] = last[keep[j]] + WINDOW + at
                        else:
                            blocks[j], seen[name] = zlib.crc32(strings[j]) % hot[i][name[0]], doc
                    if len(seen) > SEEN:
                        seen.clear()
                    out[0].append(key[keep])
                    out[1].append(blocks)
                    out[2].append(is_hot)
                    out[3].append(np.full(len(keep), doc, np.int64))
                    out[4].append(np.full(len(keep), rows[i]["nth"], np.int32))
                    out[5].append(first[keep] + at)
                    out[6].append(stop)
                    out[7] += strings
                if out[7]:
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(np.concatenate(c)) for c in out[:6]), pa.array(np.ma.concatenate(out[6])),
                         pa.array(out[7], pa.binary())], names)

    return texts.mapInArrow(cut, "key bigint, block int, hot boolean, doc bigint, nth int, first bigint, stop bigint, bytes binary")


def _strings(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The rows' bytes end to end, then (hash, row, place in the row, place in the bytes) of
    every 50-byte string of the rows."""
    sizes = np.array([len(r) for r in raws], np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(raws), np.uint8)
    h = _hashes(data, WINDOW)
    counts = sizes - WINDOW + 1
    row = np.repeat(np.arange(len(raws)), counts)
    place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (ends - sizes)[row] + place
    return data, h[at], row, place, at


def _windows(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 50-byte strings at the given places, one row of bytes each."""
    return data[at[:, None] + np.arange(WINDOW)]


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the string at each place of ``a`` (ascending) has the bytes of its partner in ``b``.

    Where both step on by one byte from a pair that is equal, only the last byte is new.
    """
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1] + 1) | (b[1:] != b[:-1] + 1)
    if not np.array_equal(data[a + WINDOW - 1], data[b + WINDOW - 1]):
        return False
    heads = np.flatnonzero(new)
    return all(np.array_equal(_windows(data, a[c]), _windows(data, b[c]))
               for c in np.array_split(heads, len(heads) // SLICE + 1))


def _grouped(name: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by name and id, first string of its name, whether its id is above the first's)."""
    by = np.lexsort((ids, name))
    head = np.flatnonzero(np.concatenate([[True], name[by][1:] != name[by][:-1]]))
    first = np.repeat(by[head], np.diff(np.concatenate([head, [len(by)]])))
    return by, first, ids[by] > ids[first]


def _marked(data: np.ndarray, h: np.ndarray, at: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings whose bytes a smaller id holds too, and the others.

    Hashes propose, bytes decide: should two unequal strings share a hash, the strings are
    grouped again by their bytes.
    """
    by, first, later = _grouped(h, ids)
    order = np.argsort(by[later])
    if not _same_bytes(data, at[by[later]][order], at[first[later]][order]):
        exact = np.ascontiguousarray(_windows(data, at)).view(f"V{WINDOW}").ravel()
        by, first, later = _grouped(np.unique(exact, return_inverse=True)[1], ids)
    return by[later], by[~later]


def _runs(row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first place, last place) of runs of neighbouring places in a row."""
    order = np.lexsort((place, row))
    row, place = row[order], place[order]
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)])) if len(row) else order
    last = np.concatenate([new[1:], [len(row)]]) - 1 if len(row) else order
    return row[new], place[new], place[last]


def _new_bytes(batches, aside: list):
    """The rows whose strings are not all held by a smaller id with equal bytes in the block, from
    batches in which hot rows are sorted by bytes and id. The byte ranges of the others go ``aside``."""
    held, least = None, None
    for batch in batches:
        known = np.array(pc.is_null(batch.column("bytes")))
        hot = np.array(batch.column("hot")) & ~known
        if hot.any():
            columns = [batch.column(c).to_numpy() for c in ("key", "block", "doc")]
            at = np.flatnonzero(hot)
            key, block, doc = (c[at].tolist() for c in columns)
            for j, *name, d, s in zip(at.tolist(), key, block, doc, batch.column("bytes").take(pa.array(at)).to_pylist()):
                if (name, s) != held:
                    held, least = (name, s), d
                known[j] = d > least
        if known.any():
            some = batch.filter(pa.array(known))
            length = pc.cast(pc.binary_length(some.column("bytes")), pa.int64())
            stop = pc.coalesce(some.column("stop"), pc.add(some.column("start"), length))
            aside.append(pa.RecordBatch.from_arrays(
                [*(some.column(c) for c in _RANGE[:3]), stop, pa.nulls(some.num_rows, pa.binary())], [*_RANGE, "s"]))
            batch = batch.filter(pa.array(~known))
        yield batch


def _whole_blocks(batches, aside: list = ()):
    """Tables of whole blocks, about SLICE suffixes or one block each, from sorted batches; an
    empty one where something lies ``aside`` for the caller to take."""
    held, size = [], 0
    for batch in batches:
        if aside:
            yield pa.Table.from_batches([batch.slice(0, 0)])
        held.append(batch)
        size += batch.num_rows
        if size < SLICE:
            continue
        table = pa.Table.from_batches(held)
        key, block = table.column("key").to_numpy(), table.column("block").to_numpy()
        new = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1]))
        if len(new):  # the last block may go on in the next batch
            yield table.slice(0, int(new[-1]) + 1)
            table = table.slice(int(new[-1]) + 1)
        held, size = table.to_batches(), table.num_rows
    if size:
        yield pa.Table.from_batches(held)


def _sort_blocks(suffixes: DataFrame) -> DataFrame:
    """(doc, nth, start, stop, s): byte ranges marked within their block, where ``s`` is null;
    and the unmarked strings of hot ranks, with their bytes."""
    names = [*_RANGE, "s"]

    def sort(batches):
        aside: list = []
        for held in _whole_blocks(_new_bytes(batches, aside), aside):
            yield from aside
            aside.clear()
            if not held.num_rows:
                continue
            hot, doc, nth, first = (held.column(c).to_numpy() for c in ("hot", "doc", "nth", "start"))
            data, h, row, place, at = _strings(held.column("bytes").to_pylist())
            marked, rest = _marked(data, h, at, doc[row])
            r, x, y = _runs(row[marked], place[marked])
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[r]), pa.array(nth[r]), pa.array(first[r] + x), pa.array(first[r] + y + WINDOW),
                 pa.nulls(len(r), pa.binary())], names)
            rest = rest[hot[row[rest]]]
            for some in np.array_split(rest, len(rest) // SLICE + 1) if len(rest) else ():
                r, x = row[some], place[some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[r]), pa.array(nth[r]), pa.array(first[r] + x), pa.array(first[r] + x + WINDOW),
                     pa.array([w.tobytes() for w in _windows(data, at[some])], pa.binary())], names)
        yield from aside

    of_hot = [F.when(F.col("hot"), F.col(c)) for c in ("bytes", "doc")]
    return (suffixes.withColumnRenamed("first", "start").repartition("key", "block").sortWithinPartitions("key", "block", *of_hot)
            .mapInArrow(sort, "doc bigint, nth int, start bigint, stop bigint, s binary"))


def _across_blocks(strings: DataFrame) -> DataFrame:
    """Marked byte ranges among the strings that their blocks left: sorted by bytes and id,
    equal strings follow each other and all but those of the first id are marked."""
    def sweep(batches):
        held, least = None, None
        for batch in batches:
            later = []
            for s, doc in zip(batch.column(4).to_pylist(), batch.column(0).to_pylist()):
                if s != held:
                    held, least = s, doc
                later.append(doc > least)
            yield batch.filter(pa.array(later, pa.bool_())).select([0, 1, 2, 3])

    return (strings.select("doc", "nth", "start", "length", "s").repartition("s").sortWithinPartitions("s", "doc")
            .mapInArrow(sweep, "doc bigint, nth int, start bigint, length int"))


def removals(docs: DataFrame) -> DataFrame:
    """(doc, dig, spans): byte ranges to remove per text, not yet merged; untouched texts are left out.

    ``doc`` is the id with null as 2^63 - 1, ``dig`` the 64-bit digest of the text.
    """
    named = _identified(docs)
    facts = materialise(named.select("doc", "dig", F.sha2("text", 256).alias("sha"),
                                     F.octet_length("text").cast("bigint").alias("n_bytes")), "texts")
    first = facts.groupBy("sha").agg(F.min("doc").alias("least"), F.count("*").alias("n"))
    first = materialise(first, "first")
    copies = (facts.join(first.where("n > 1"), "sha").where(F.col("doc") > F.col("least"))
              .where(F.col("n_bytes") >= WINDOW).select("doc", "dig", "n_bytes").distinct())
    # (doc, nth) names a text as its digest does, in fewer bytes: nth is 1 unless an id repeats
    heads = (facts.join(first, "sha").where(F.col("doc") == F.col("least")).select("doc", "dig").distinct()
             .withColumn("nth", F.row_number().over(Window.partitionBy("doc").orderBy("dig"))))
    heads = materialise(heads, "heads")
    blocks = F.ceil(F.col("n") / HOT).cast("int").alias("blocks")
    sets = (_shared(named).groupBy("dig").agg(F.collect_set("key").alias("keys"), F.collect_set(
        F.when(F.col("n") > HOT, F.struct("key", blocks))).alias("hot")).join(heads, "dig"))
    length = (F.col("stop") - F.col("start")).cast("int").alias("length")
    sorted_blocks = materialise(_sort_blocks(_suffixes(
        _packed(named).join(sets, ["doc", "dig"]).select("doc", "nth", "raw", "keys", "hot"))).select(
            "doc", "nth", "start", length, "s"), "ranges")
    ranges = (sorted_blocks.where("s IS NULL").drop("s")
              .unionByName(_across_blocks(sorted_blocks.where("s IS NOT NULL"))))
    # one number a range while they are gathered: none is longer than the strings of a cover place
    packed = F.collect_set(F.shiftleft("start", _LENGTH_BITS) + F.col("length")).alias("spans")

    def span(x):
        start = F.shiftright(x, _LENGTH_BITS)
        return F.struct(start.alias("start"), (start + x.bitwiseAND(F.lit((1 << _LENGTH_BITS) - 1))).alias("stop"))

    marked = (ranges.groupBy("doc", "nth").agg(packed).join(heads, ["doc", "nth"])
              .select("doc", "dig", F.transform("spans", span).alias("spans")))
    whole = copies.select("doc", "dig", F.array(F.struct(F.lit(0).cast("bigint").alias("start"),
                                                         F.col("n_bytes").alias("stop"))).alias("spans"))
    return materialise(marked.unionByName(whole), "removals")


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs: overlapping and adjoining ranges become one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _cut(docs: DataFrame, keep: list[str], decode: bool = False) -> DataFrame:
    """The ``keep`` columns with ``_kept`` (bytes that stay, or the text they decode to),
    ``_n``, ``_removed`` and ``_spans``."""
    own = [f"_k{i}" for i in range(len(keep))]
    text = F.coalesce("text", F.lit(""))
    named = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, own)],
                        F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc"), F.xxhash64(text).alias("dig"), text.alias("text"))
    joined = _packed(named, *own).join(removals(docs), ["doc", "dig"], "left").select(*own, "raw", "spans")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[:-2])

    def cut(batches):
        big = zstandard.ZstdDecompressor()
        for batch in batches:
            out, sizes, removed, runs = [], [], [], []
            for raw, spans in zip(batch.column(len(own)).to_pylist(), batch.column(len(own) + 1).to_pylist()):
                raw = big.decompress(raw)
                merged = merge_spans([(s["start"], s["stop"]) for s in spans or ()])
                at, parts = 0, []
                for a, b in merged:
                    parts.append(raw[at:a])
                    at = b
                kept = b"".join([*parts, raw[at:]])
                out.append(kept.decode("utf-8", "ignore") if decode else kept)
                sizes.append(len(raw))
                removed.append(len(raw) - len(kept))
                runs.append(len(merged))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(own)], pa.array(out, pa.string() if decode else pa.binary()),
                 pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64())],
                [*own, "_kept", "_n", "_removed", "_spans"])

    kind = "string" if decode else "binary"
    out = joined.mapInArrow(cut, f"{schema}, _kept {kind}, _n bigint, _removed bigint, _spans bigint")
    return out.select(*[F.col(k).alias(c) for c, k in zip(keep, own)], "_kept", "_n", "_removed", "_spans")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text``; a null text stays null."""
    keep = [c for c in docs.columns if c != "text"]
    out = _cut(docs.withColumn("_null", F.col("text").isNull()), [*keep, "_null"], decode=True)
    return out.withColumn("text", F.when(~F.col("_null"), F.col("_kept"))).select(*docs.columns)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _cut(documents(spark, sf_dir).select("doc_id", "text"), ["doc_id"])
    return out.select("doc_id", F.col("_n").alias("n_bytes"), F.col("_removed").alias("n_removed"),
                      F.col("_spans").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"))
