"""Content-based recommendations: TF-IDF (M9) and top-k cosine similarity.

The document-term matrix is a long DataFrame ``(id, term, weight)``: sparse, partitioned by
Spark, never materialised as N x N. Numbers follow the reference's vectorizer defaults:

* lower-case, token = run of 2+ word characters, English stop words removed;
* vocabulary = all terms, or the ``max_features`` with the largest total count (ties: term asc);
* ``tf`` = raw count, ``idf = ln((1 + N) / (1 + df)) + 1`` (N = all documents);
* each document row L2-normalised, so cosine similarity is a dot product.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkplate.functions.numeric import round_half_up
from sparkplate.functions.text import ENGLISH_STOP_WORDS, tokens
from sparkplate.operators.lookup import first_per
from sparkplate.session import cut_lineage


def _counted(text_col: str, stop_words: Sequence[str] | None) -> Column:
    """array<struct(terms, tfs)> of one element: the kept tokens of a text and their counts, taken
    inside the row (sorted, then runs of equal tokens), so nothing is shuffled."""
    toks = tokens(text_col)
    if stop_words:
        toks = F.filter(toks, lambda t: ~t.isin(list(stop_words)))

    def runs(s):
        starts = F.filter(F.transform(s, lambda x, i: F.when(x.eqNullSafe(F.get(s, i - 1)), F.lit(-1)).otherwise(i)),
                          lambda i: i >= 0)
        return F.transform(F.array(starts), lambda p: F.struct(
            F.transform(p, lambda i: F.get(s, i)).alias("terms"),
            F.transform(p, lambda i, j: F.coalesce(F.get(p, j + 1), F.size(s)) - i).alias("tfs")))[0]

    return F.transform(F.array(F.sort_array(toks)), runs)


def term_counts(df: DataFrame, id_col: str, text_col: str,
                stop_words: Sequence[str] | None = ENGLISH_STOP_WORDS) -> DataFrame:
    """``(id, term, tf)``: raw count of each kept token per document. Rows of one id are
    documents of their own, as ids are keys here."""
    counted = df.select(F.col(id_col), F.inline(_counted(text_col, stop_words)))
    return counted.select(id_col, F.inline(F.arrays_zip("terms", "tfs"))).select(
        id_col, F.col("terms").alias("term"), F.col("tfs").cast("bigint").alias("tf"))


def _count_rows(df: DataFrame, id_col: str, text_col: str, stop_words: Sequence[str] | None) -> DataFrame:
    """``(id, terms, tfs)``, a row per document. The terms, which hold no space, are one text with spaces
    between: far smaller to write and to shuffle than an array of them."""
    counted = _spread(df.select(id_col, text_col), id_col).select(id_col, F.inline(_counted(text_col, stop_words)))
    last = F.size("tfs") - F.array_position(F.reverse("tfs"), F.array_max("tfs")).cast("int")
    return counted.select(id_col, F.array_join("terms", " ").alias("terms"), "tfs", F.get("terms", last).alias("_head"))


def _spread(df: DataFrame, id_col: str) -> DataFrame:
    """A table of a few splits dealt to all cores by id: counting tokens costs far more than moving texts."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, id_col) if df.rdd.getNumPartitions() < cores else df


#: Document-term pairs whose weights are taken together.
GROUP_PAIRS = 300_000


def _weigher(keys: Sequence[str], tops: bool):
    """The function of a group's documents and of its terms' idf that returns ``_vectors``' rows."""
    def weigh(docs: pa.Table, idf: pa.Table) -> pa.Table:
        # rows of equal keys are one document
        at = docs.select(keys).append_column("_at", pa.array(np.arange(len(docs)))).group_by(keys, use_threads=False).aggregate(
            [("_at", "list")]).sort_by(keys[0])
        rows = at["_at_list"].combine_chunks()
        tfs = docs["tfs"].combine_chunks().take(rows.flatten())
        owner = np.repeat(np.repeat(np.arange(len(at)), rows.value_lengths()), tfs.value_lengths())
        term = pc.split_pattern(docs["terms"].combine_chunks().take(rows.flatten()), " ").flatten()
        known, tf = idf["term"].combine_chunks(), tfs.flatten().to_numpy()
        code = pc.index_in(term, value_set=known)
        if code.null_count:  # terms outside the vocabulary
            some = code.is_valid()
            code, term, which = code.drop_null(), term.filter(some), some.to_numpy(zero_copy_only=False)
            owner, tf = owner[which], tf[which]
        code = code.to_numpy()
        weight = tf * idf["idf"].to_numpy()[code]
        weight = weight / np.sqrt(np.bincount(owner, weight * weight, len(at)))[owner]

        def lists(of, n, terms, weights):
            ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]).astype("int32")
            return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([terms, pa.array(weights)], ["term", "weight"]))

        out = at.select(keys).append_column("vector", lists(owner, len(at), term, weight))
        filled = lambda t: t.filter(pc.greater(pc.list_value_length(t["vector"]), 0))
        if not tops:
            return filled(out)
        every = pa.table({"of": owner, "code": code, "weight": weight})
        if len(at) < len(docs):  # a term may come several times
            every = every.group_by(["of", "code"], use_threads=False).aggregate([("weight", "sum")]).rename_columns(["of", "code", "weight"])
        blocks, of = np.unique(at[keys[0]].to_numpy(), return_inverse=True)
        best = every.set_column(0, "of", pa.array(of[every["of"].to_numpy()])).group_by(["of", "code"], use_threads=False).aggregate(
            [("weight", "max")]).sort_by("of")
        terms = known.take(best["code"].combine_chunks())
        none = [pa.nulls(len(blocks), at.schema.field(k).type) for k in keys[1:]]
        top = pa.table([pa.array(blocks), *none, lists(best["of"].to_numpy(), len(blocks), terms, best["weight_max"].to_numpy())], out.schema.names)
        return filled(pa.concat_tables([t.append_column("top", pa.array([is_top] * len(t), pa.bool_()))
                                        for t, is_top in ((out, False), (top, True))]))

    return weigh


def _vectors(counted: DataFrame, keys: Sequence[str], n_docs: int, max_features: int | None, tops: bool = False) -> DataFrame:
    """``(*keys, vector)``: normalised array<struct(term, weight)> of ``counted`` rows ``(_group, *keys, terms, tfs)``.

    Documents are shuffled as a row each, by group, and never as pairs: of the pairs only the distinct
    terms of a group go to the vocabulary, and their idf comes back. Rows of equal keys lie in one group.
    With ``tops`` the first key is a block, whose documents lie in one group; a boolean ``top`` marks
    the rows, a block each and without other keys, that hold the block's greatest weight per term.
    """
    some = counted.where(F.size("tfs") > 0).select("_group", *keys, "terms", "tfs")
    words = some.repartition("_group").select("_group", F.split("terms", " ").alias("term"), F.col("tfs").alias("_tf"))
    # total counts matter only where they choose the vocabulary
    words = (words.select("_group", F.inline(F.arrays_zip("term", "_tf"))) if max_features
             else words.select("_group", F.explode("term").alias("term"), F.lit(1).alias("_tf")))
    terms = words.groupBy("_group", "term").agg(F.sum("_tf").alias("_tf"), F.count(F.lit(1)).alias("_n"))
    vocab = terms.groupBy("term").agg(F.sum("_tf").alias("_total"), F.sum("_n").alias("_df"), F.collect_list("_group").alias("_groups"))
    if max_features:
        vocab = vocab.orderBy(F.col("_total").desc(), F.col("term")).limit(max_features)
    idf = vocab.select(F.explode("_groups").alias("_group"), "term",
                       (F.log(F.lit(float(1 + n_docs)) / (F.col("_df") + 1)) + 1).alias("idf"))
    vector = T.ArrayType(T.StructType().add("term", "string").add("weight", "double"))
    schema = T.StructType([T.StructField(k, counted.schema[k].dataType) for k in keys]).add("vector", vector)
    return some.groupBy("_group").cogroup(idf.groupBy("_group")).applyInArrow(
        _weigher(keys, tops), schema.add("top", "boolean") if tops else schema)


def tfidf(df: DataFrame, id_col: str = "business_id", text_col: str = "text_features",
          max_features: int | None = None,
          stop_words: Sequence[str] | None = ENGLISH_STOP_WORDS) -> DataFrame:
    """M9: ``(id, term, weight)`` for every document with at least one vocabulary term.

    All terms count by default; ``max_features`` keeps only the terms with the largest
    totals (the reference's setting is 5,000). The counts, a row per document, are written once:
    they feed the vocabulary and the weights, so the corpus is tokenised once.
    """
    counted = cut_lineage(_count_rows(df, id_col, text_col, stop_words).select(
        id_col, "terms", "tfs", F.greatest(F.size("tfs"), F.lit(0)).alias("_pairs")))
    size = counted.agg(F.count(F.lit(1)).alias("docs"), F.sum("_pairs").alias("pairs")).first()
    groups = (size["pairs"] or 0) // GROUP_PAIRS + 1
    grouped = counted.withColumn("_group", F.pmod(F.xxhash64(id_col), F.lit(groups)).cast("int"))
    return _vectors(grouped, [id_col], size["docs"], max_features).select(id_col, F.inline("vector"))


@dataclass
class VectorIndex:
    """Normalised vectors in blocks of like documents, and each block's greatest weight per term.

    ``vectors``: (block, id, vector), sorted by block inside its files, so that a filter on blocks
    skips pages; ``bounds``: (term, block, top). Both are written, each to files of its own."""
    vectors: DataFrame
    bounds: DataFrame
    blocks: int
    id_col: str


#: Slots into which documents are counted by their most frequent term to number blocks.
HEAD_SLOTS = 4096


def index_vectors(df: DataFrame, id_col: str = "business_id", text_col: str = "text_features",
                  max_features: int | None = None, stop_words: Sequence[str] | None = ENGLISH_STOP_WORDS,
                  block: int = 128) -> VectorIndex:
    """M10's index: documents with the same most frequent term lie in neighbouring blocks of about
    ``block`` documents; a term that heads a third of all documents has blocks of its own."""
    counted = cut_lineage(_count_rows(df, id_col, text_col, stop_words).select(
        id_col, "terms", "tfs", F.greatest(F.size("tfs"), F.lit(0)).alias("_pairs"),
        F.pmod(F.xxhash64("_head"), F.lit(HEAD_SLOTS)).cast("int").alias("_slot")))
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)  # HEAD_SLOTS rows at most
    slots = cut_lineage(counted.groupBy("_slot").agg(F.count(F.lit(1)).alias("_n"), F.sum("_pairs").alias("_in")))
    size = slots.agg(F.sum("_n").alias("docs"), F.sum("_in").alias("pairs")).first()
    n_docs = size["docs"] or 0
    blocks = max(1, round(GROUP_PAIRS * n_docs / (block * (size["pairs"] or 1))))  # in a group
    slots = slots.select("_slot", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.pmod(F.xxhash64(id_col), F.col("_n"))
    blocked = counted.join(F.broadcast(slots), "_slot").select(F.floor(place / block).cast("int").alias("block"), id_col, "terms", "tfs")
    blocked = blocked.withColumn("_group", F.floor(F.col("block") / blocks).cast("int"))
    rows = cut_lineage(_vectors(blocked, ["block", id_col], n_docs, max_features, tops=True).sortWithinPartitions("top", "block"), "top")
    vectors = rows.where(~F.col("top")).select("block", id_col, "vector")
    tops = rows.where("top").select("block", F.inline("vector")).select("term", "block", F.col("weight").alias("top"))
    return VectorIndex(vectors, tops, rows.where("top").count(), id_col)


@dataclass
class Similar:
    """``rows``: (id, name, score); ``read`` of ``blocks`` blocks had their documents scored."""
    rows: DataFrame
    read: int
    blocks: int


def _first_list(df: DataFrame, col: str) -> list:
    """The values of a column of a few rows."""
    return df.agg(F.collect_list(col)).first()[0]


def similar_indexed(index: VectorIndex, items: DataFrame, titles: Sequence[str], k: int = 5,
                    name_col: str = "name", digits: int = 6, seeds: int = 8) -> Similar:
    """M10 from the index; the same rows as ``similar_items``.

    The selected items' weights times the blocks' greatest weights bound the score of every
    document in a block. The ``seeds`` blocks of the best bounds are scored first; of the rest
    only blocks whose bound reaches the k-th best score so far (less one unit of the last of
    ``digits``, as equal rounded scores go by id). Items without any common term enter only if
    fewer than ``k`` score above zero.
    """
    key, unit = index.id_col, 10.0 ** -digits
    empty = items.select(key, name_col, F.lit(0.0).alias("score")).where(F.lit(False))
    if not titles or k < 1:
        return Similar(empty, 0, index.blocks)
    chosen = _first_list(first_per(items.select(key, name_col).where(F.col(name_col).isin(list(titles))), name_col, key), key)
    if not chosen:
        return Similar(empty, 0, index.blocks)
    sel = cut_lineage(index.vectors.where(F.col(key).isin(chosen)).select(F.col(key).alias("_sel"), F.inline("vector"))
                      .withColumnRenamed("weight", "_sw"))
    bound = cut_lineage(index.bounds.join(sel, "term").groupBy("block", "_sel").agg(F.sum(F.col("top") * F.col("_sw")).alias("_b"))
                        .groupBy("block").agg(F.max("_b").alias("bound")))

    def scored(vectors: DataFrame) -> DataFrame:
        dots = (vectors.where(~F.col(key).isin(chosen)).select(key, F.inline("vector")).join(sel, "term")
                .groupBy(key, "_sel").agg(F.sum(F.col("weight") * F.col("_sw")).alias("_dot"))
                .groupBy(key).agg(round_half_up(F.max("_dot"), digits).alias("score")))
        return cut_lineage(dots.where("score > 0").orderBy(F.col("score").desc(), F.col(key)).limit(k))

    first = _first_list(bound.orderBy(F.col("bound").desc(), "block").limit(seeds), "block")
    best = scored(index.vectors.where(F.col("block").isin(first)))
    found = best.agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).first()
    reach = found["least"] - 2 * unit if found["n"] == k else 0.0
    rest = bound.where(~F.col("block").isin(first) & (F.col("bound") >= reach)).select("block")
    n_rest = rest.count()
    if n_rest:
        more = (index.vectors.where(F.col("block").isin(_first_list(rest, "block"))) if n_rest <= 1000
                else index.vectors.join(rest, "block", "left_semi"))
        best = cut_lineage(best.unionByName(scored(more)).orderBy(F.col("score").desc(), F.col(key)).limit(k))
        found = best.agg(F.count(F.lit(1)).alias("n")).first()
    rows = items.select(key, name_col).join(F.broadcast(best), key)  # k rows
    if found["n"] < k:
        zero = (items.select(key, name_col).where(~F.col(key).isin(chosen)).join(best.select(key), key, "left_anti")
                .orderBy(key).limit(k - found["n"]))
        rows = rows.unionByName(zero.withColumn("score", F.lit(0.0)))
    return Similar(rows.orderBy(F.col("score").desc(), F.col(key).asc()), len(first) + n_rest, index.blocks)


def similar_items(vectors: DataFrame, items: DataFrame, titles: Sequence[str], k: int = 5,
                  id_col: str = "business_id", name_col: str = "name", digits: int = 6) -> DataFrame:
    """``(id, name, score)`` of the ``k`` items most similar to the named ones.

    * each known title selects its first row (smallest id); unknown titles are ignored,
      and no known title gives an empty result with the same columns;
    * score of a candidate = max cosine over the selected items; the selected rows
      themselves are excluded, namesakes stay candidates;
    * the selected vectors (at most ``len(titles)`` x vocabulary rows) are joined on
      ``term`` to the long matrix: work is k x N, never N x N;
    * candidates sharing no term score 0 and fill the list only when fewer than ``k``
      items score above 0; ties (scores equal at ``digits`` decimals) go by id.
    """
    if not titles:
        return items.select(id_col, name_col, F.lit(0.0).alias("score")).where(F.lit(False))
    selected = cut_lineage(first_per(items.select(id_col, name_col).where(F.col(name_col).isin(list(titles))),
                                     name_col, id_col).select(id_col))
    # the selected rows and vectors are small (titles x terms of those items); AQE
    # broadcasts them after checking their runtime size, else it joins by shuffle
    sel_vec = vectors.join(selected, id_col, "left_semi").select(
        F.col(id_col).alias("_sel"), "term", F.col("weight").alias("_sw"))
    dots = (vectors.join(sel_vec, "term")
            .groupBy(id_col, "_sel").agg(F.sum(F.col("weight") * F.col("_sw")).alias("_dot"))
            .groupBy(id_col).agg(F.max("_dot").alias("_best")))
    # a score of zero only where some title was found (one-row semi-join on a constant key)
    found = selected.select(F.lit(1).alias("_any")).distinct()
    candidates = (items.select(id_col, name_col).join(selected, id_col, "left_anti")
                  .withColumn("_any", F.lit(1)).join(found, "_any", "left_semi"))
    scored = candidates.join(dots, id_col, "left").select(
        id_col, name_col, F.when(F.col("_best") > 0, round_half_up(F.col("_best"), digits)).otherwise(F.lit(0.0)).alias("score"))
    return scored.orderBy(F.col("score").desc(), F.col(id_col).asc()).limit(k)
