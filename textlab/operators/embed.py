"""E1-E3, A6-A8, J1, J7, S4-derived vectors: dense document vectors.

* Word-vector mean (E3) is a sparse-dense product: the counts of a document's
  words times their vectors (J1; repeats weigh more).  No vector is copied for
  an occurrence.  A word table of checked size is broadcast and a task multiplies
  blocks of documents with the rows of the table they touch, without a shuffle.
  A larger table is cut into blocks by a hash of the word; shares of the runs
  ``(document, word, count)`` meet a copy of the block of their words, and one partial
  sum for each document and block is added up by document.  Documents without a
  known word get a zero vector (J7).
* Token-state pooling (E2, A7, A8): given token states ``(doc_id, pos,
  mask, vec)`` from any encoder, the first-token vector and the masked mean
  ``sum(mask*vec) / max(sum(mask), 1e-9)``.  Zero states (padding, unknown
  tokens) may be left out of the state table: they add nothing to the sums.
* Batch encoding (E1): ``mapInPandas`` with a pluggable encoder factory,
  loaded once per Python worker, applied in batches of 64 texts.  The default
  encoder gathers a batch's states from the broadcast word table by id.
"""

from __future__ import annotations

import math
from typing import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import PAD_TOKEN, SEP_TOKEN, WINDOW_LENGTH, token_window
from .common import bounded_broadcast, global_row_number, let_go, stage
from .linalg import list_column
from .reduce import _row_blocks
from .vectorize import _token_slices, doc_term_counts

ENCODE_BATCH = 64
MASK_FLOOR = 1e-9
# Word-vector tables up to about this many bytes are broadcast (rows checked by a count,
# bytes estimated from the vector width).
WORD_TABLE_BROADCAST_BYTES = 128 << 20
# Largest k ranked by a single top-k; larger k uses the distributed global rank.
RANK_TOPK_LIMIT = 100_000


def _join_words(occ: DataFrame, word_vectors: DataFrame, how: str = "inner") -> DataFrame:
    """Join token occurrences with the word table without ever broadcasting the occurrence side.

    The token stream is the large side but its size is invisible to the
    optimizer after ``explode``; the word table is counted and broadcast only
    under a byte bound (rows x estimated row width), otherwise both sides are
    shuffled (sort-merge join).
    """
    first = word_vectors.select(F.size("vec").alias("w")).first()
    row_bytes = 64 + 4 * (first["w"] if first and first["w"] else 0)
    words = bounded_broadcast(word_vectors, max(1, WORD_TABLE_BROADCAST_BYTES // row_bytes))
    if words is word_vectors:
        return occ.hint("merge").join(word_vectors, "word", how)
    return occ.join(words, "word", how)


def rank_terms_to_vectors(tokens_df: DataFrame, vectors: DataFrame, tokens_col: str = "tokens",
                          id_col: str = "vec_id", vec_col: str = "embedding",
                          topk_limit: int = RANK_TOPK_LIMIT) -> DataFrame:
    """Fixture word vectors: the i-th most frequent term (tf desc, term asc; from 0) gets vector ``id = i``.

    ``(word, vec array<float>)``.  k = the number of vectors grows with the
    data: up to ``topk_limit`` a bounded top-k and a rank over those k rows;
    above it a distributed global rank (:func:`global_row_number`), so no
    single task ever holds k rows.
    """
    k = vectors.count()
    tf = tokens_df.select(F.explode(tokens_col).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("tf"))
    order = [F.col("tf").desc(), F.col("word").asc()]
    if k <= topk_limit:
        top = tf.orderBy(*order).limit(k)
        ranked = top.withColumn(id_col, (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))
    else:
        ranked = global_row_number(tf, order, id_col).where(F.col(id_col) < k)
    return ranked.join(vectors.select(id_col, F.col(vec_col).alias("vec")), id_col).select("word", "vec")


def vector_width(word_vectors: DataFrame, vec_col: str = "vec"):
    """Vector width as a scalar-subquery column."""
    return word_vectors.select(F.max(F.size(vec_col))).scalar()


class WordTable:
    """Words and their vectors as one matrix; its last row, of zeros, is the vector of unknown words."""

    def __init__(self, words: pa.Array, vectors: np.ndarray):
        self.words, self.width = words, vectors.shape[1]
        self.matrix = np.vstack([vectors, np.zeros((1, self.width), vectors.dtype)])

    def ids(self, words: pa.Array) -> np.ndarray:
        """Row of each word, -1 for unknown ones."""
        return pc.fill_null(pc.index_in(words.cast(self.words.type), value_set=self.words, skip_nulls=True), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def sums(self, lens: np.ndarray, ids: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        """The sum of the vectors of each run of ``lens`` ids: small blocks of counts times the rows they touch."""
        out = np.zeros((len(lens), self.width))
        for r0, r1, o0, o1 in _row_blocks(lens):
            if o1 > o0:
                touched, at = np.unique(ids[o0:o1], return_inverse=True)
                cell = np.repeat(np.arange(r1 - r0), lens[r0:r1]) * len(touched) + at
                counts = np.bincount(cell, None if weights is None else weights[o0:o1], (r1 - r0) * len(touched))
                out[r0:r1] = counts.reshape(r1 - r0, -1) @ self.matrix[touched].astype(np.float64)
        return out


def _table_size(word_vectors: DataFrame) -> tuple[int, int, int]:
    """``(rows, width, bytes a row)`` of a word table."""
    n, width = word_vectors.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    return n, width or 0, 64 + 4 * (width or 0)


def _as_table(words: pa.Array, vecs: pa.Array, width: int) -> WordTable:
    return WordTable(words, vecs.flatten().to_numpy(zero_copy_only=False).astype(np.float32, copy=False).reshape(len(words), width))


def broadcast_words(word_vectors: DataFrame, limit: int | None = None):
    """The word table as a broadcast :class:`WordTable`, or None where it is over ``limit`` bytes (counted first)."""
    n, width, row_bytes = _table_size(word_vectors)
    if n * row_bytes > (WORD_TABLE_BROADCAST_BYTES if limit is None else limit):
        return None
    rows = word_vectors.select("word", F.col("vec").cast("array<float>").alias("vec")).toArrow().combine_chunks()
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in rows.columns]
    return word_vectors.sparkSession.sparkContext.broadcast(_as_table(*columns, width))


def _lists(batch: pa.RecordBatch, at: int) -> tuple[np.ndarray, pa.Array]:
    """``(lengths, flat strings)`` of a list column, null lists as empty."""
    lists = batch.column(at)
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()


def _slices(batches, at: int):
    """The batches in pieces of bounded numbers of tokens, however many rows Spark puts into one."""
    for b in batches:
        for a, z in _token_slices(b.column(at)):
            yield b.slice(a, z - a)


def _vectors(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel()))


def mean_word_vectors(docs: DataFrame, word_vectors: DataFrame, tokens_col: str = "tokens",
                      id_col: str = "doc_id", limit: int | None = None) -> DataFrame:
    """``(doc_id, vec array<double>)`` = mean of the vectors of known tokens, else zeros.

    ``limit`` bounds the bytes of a word table that is broadcast; beyond it the product is cut into blocks.
    """
    table = broadcast_words(word_vectors, limit)
    if table is None:
        return _mean_by_blocks(docs, word_vectors, tokens_col, id_col)

    def run(batches):
        words = table.value
        for b in _slices(batches, 1):
            lens, flat = _lists(b, 1)
            ids = words.ids(flat)
            known = np.bincount(np.repeat(np.arange(len(lens)), lens), ids >= 0, len(lens))
            yield pa.RecordBatch.from_arrays([b.column(0), _vectors(words.sums(lens, ids) / np.maximum(known, 1)[:, None])], [id_col, "vec"])

    return docs.select(id_col, tokens_col).mapInArrow(run, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, vec array<double>")


BLOCK_BYTES = 16 << 20
RUN_ROWS = 1 << 20
# Words of the documents whose runs and partial sums are shuffled at a time (some 30 bytes each in runs).
ROUND_TOKENS = 1 << 27


def _mean_by_blocks(docs: DataFrame, word_vectors: DataFrame, tokens_col: str, id_col: str,
                    block_bytes: int | None = None) -> DataFrame:
    """The same product with a word table of any size: shares of the documents' words meet a copy of their block.

    Documents of more than ``ROUND_TOKENS`` words are dealt to rounds by a hash of the id; the files that a round
    shuffles go before the next one begins.
    """
    tokens = docs.select(F.sum(F.size(tokens_col))).first()[0] or 0
    rounds = math.ceil(tokens / ROUND_TOKENS)
    if rounds <= 1:
        return _mean_of_round(docs, word_vectors, tokens, tokens_col, id_col, block_bytes)
    out = None
    for i in range(rounds):
        some = docs.where(F.pmod(F.xxhash64(id_col), F.lit(rounds)) == i)
        part = stage(_mean_of_round(some, word_vectors, tokens // rounds, tokens_col, id_col, block_bytes), "word_means")
        let_go(docs.sparkSession)
        out = part if out is None else out.unionByName(part)
    return out


def _mean_of_round(docs: DataFrame, word_vectors: DataFrame, tokens: int, tokens_col: str, id_col: str,
                   block_bytes: int | None) -> DataFrame:
    """The shares of a block grow in number with the documents, so that a group holds about ``RUN_ROWS`` runs and one block."""
    n, width, row_bytes = _table_size(word_vectors)
    blocks = max(1, math.ceil(n * row_bytes / (block_bytes or BLOCK_BYTES)))
    block = F.pmod(F.xxhash64("word"), F.lit(blocks)).cast("int")
    id_type = docs.schema[id_col].dataType.simpleString()
    cores = docs.sparkSession.sparkContext.defaultParallelism
    shares = max(1, math.ceil(max(cores / blocks, tokens / RUN_ROWS / blocks)))  # a document has no more runs than tokens
    parts = min(2 * blocks * shares, max(4 * cores, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    counts = doc_term_counts(docs, tokens_col, 1, id_col).select(F.col(id_col).alias("id"), F.col("term").alias("word"), F.col("tf").cast("double").alias("tf"))
    share = F.pmod(F.xxhash64("id"), F.lit(shares))
    entries = counts.withColumn("key", block.cast("long") * (1 << 31) + share).repartition(parts, "key")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long")))
    copies = word_vectors.select("word", F.col("vec").cast("array<float>").alias("vec"), block.cast("long").alias("block"), every.alias("share"))
    copies = copies.select("word", "vec", (F.col("block") * (1 << 31) + F.col("share")).alias("place")).repartition(parts, "place")

    def multiply(runs_: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if runs_.num_rows and rows.num_rows:
            table = _as_table(rows["word"].combine_chunks(), rows["vec"].combine_chunks(), width)
            at = table.ids(runs_["word"].combine_chunks())
            codes = pc.fill_null(runs_["id"].combine_chunks().dictionary_encode().indices, -1).to_numpy().astype(np.int64)
            order = np.argsort(codes, kind="stable")
            order = order[at[order] >= 0]
            first = np.flatnonzero(np.diff(codes[order], prepend=-2))
            lens, weights = np.diff([*first, len(order)]), runs_["tf"].to_numpy()[order]
            if len(first):
                out = [pa.table({id_col: runs_["id"].take(pa.array(order[first])), "n": np.add.reduceat(weights, first), "v": _vectors(table.sums(lens, at[order], weights))})]
        return out[0] if out else pa.schema([(id_col, runs_.schema.field("id").type), ("n", pa.float64()), ("v", pa.list_(pa.float64()))]).empty_table()

    partial = entries.groupBy("key").cogroup(copies.groupBy("place")).applyInArrow(multiply, f"{id_col} {id_type}, n double, v array<double>")
    none = docs.select(id_col, F.lit(0.0).alias("n"), F.array_repeat(F.lit(0.0), width).alias("v"))
    sums = partial.unionByName(none).groupBy(id_col).agg(Summarizer.sum(array_to_vector("v")).alias("s"), F.sum("n").alias("n"))

    def means(batches):
        for b in batches:
            _, flat = list_column(b, "s", np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), _vectors(flat.reshape(b.num_rows, width) / np.maximum(b.column(2).to_numpy(), 1.0)[:, None])], [id_col, "vec"])

    return sums.select(id_col, vector_to_array("s").alias("s"), "n").mapInArrow(means, f"{id_col} {id_type}, vec array<double>")


def _looked_up(window) -> Column:
    """The word whose vector each slot takes: the leading special token takes the first content token's state
    (the static encoder's rule, so that the first-token vector says something about the text)."""
    return F.concat(F.slice(window, 2, 1), F.slice(window, 2, F.size(window) - 1))


def window_token_states(docs: DataFrame, word_vectors: DataFrame, tokens_col: str = "tokens",
                        id_col: str = "doc_id", length: int = WINDOW_LENGTH) -> tuple[DataFrame, DataFrame]:
    """Default static encoder: token states of the P13 window from a word-vector table.

    Returns ``(states, masks)``: ``states(doc_id, pos, mask, vec)`` holds the
    non-zero states only (known words inside the window); the leading special
    token has the state of the first content token, the other special tokens,
    padding and unknown words have zero states.  ``masks(doc_id, mask_sum)``.
    """
    win = docs.select(id_col, token_window(tokens_col, length).alias("w"))
    masks = win.select(id_col, F.aggregate("w.mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("mask_sum"))
    occ = win.select(id_col, F.posexplode(_looked_up(F.col("w.window"))).alias("pos", "word"), F.col("w.mask").alias("_m"))
    occ = occ.select(id_col, "pos", "word", F.element_at("_m", F.col("pos") + 1).alias("mask"))
    states = _join_words(occ, word_vectors.select("word", "vec")).select(
        id_col, "pos", "mask", F.transform("vec", lambda x: x.cast("double")).alias("vec"))
    return states, masks


def pool_token_states(states: DataFrame, masks: DataFrame, dim, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, first array<double>, mean array<double>)`` from (sparse) token states."""
    masked = states.where(F.col("mask") != 0).select(
        id_col, array_to_vector(F.transform("vec", lambda x: x * F.col("mask"))).alias("v"))
    sums = masked.groupBy(id_col).agg(Summarizer.sum(F.col("v")).alias("s"))
    first = states.where(F.col("pos") == 0).select(id_col, F.col("vec").alias("first"))
    zero = F.array_repeat(F.lit(0.0), dim.cast("int") if not isinstance(dim, int) else F.lit(dim))
    denom = F.greatest(F.col("mask_sum").cast("double"), F.lit(MASK_FLOOR))
    return (masks.join(sums, id_col, "left").join(first, id_col, "left")
            .select(id_col, F.coalesce("first", zero).alias("first"),
                    F.coalesce(F.when(F.col("s").isNotNull(), F.transform(vector_to_array("s"), lambda x: x / denom)),
                               zero).alias("mean")))


def pool_window(docs: DataFrame, word_vectors: DataFrame, dim, tokens_col: str = "tokens", id_col: str = "doc_id",
                length: int = WINDOW_LENGTH, limit: int | None = None) -> DataFrame:
    """E2/A7/A8 for the default static encoder: ``(doc_id, first, mean)``.

    With a word table that can be broadcast (``limit``, counted) both poolings are
    sums over the window's words, taken where the document lies; else one aggregation.
    """
    table = broadcast_words(word_vectors, limit)
    if table is None:
        return _pool_by_join(docs, word_vectors, dim, tokens_col, id_col, length)

    def run(batches):
        words = table.value
        sep = words.ids(pa.array([SEP_TOKEN]))[0]
        for b in _slices(batches, 1):
            lens, flat = _lists(b, 1)
            ids = words.ids(flat)
            lead = np.where(lens > 0, np.concatenate([ids, [-1]])[np.minimum(np.cumsum(lens) - lens, len(ids))], sep)  # the leading slot's word
            first = words.matrix[lead].astype(np.float64)
            total = words.sums(lens, ids) + first + words.matrix[sep]
            yield pa.RecordBatch.from_arrays([b.column(0), _vectors(first), _vectors(total / (lens + 2)[:, None])], [id_col, "first", "mean"])

    window = docs.select(id_col, F.slice(tokens_col, 1, length - 2).alias("w"))
    id_type = docs.schema[id_col].dataType.simpleString()
    return window.mapInArrow(run, f"{id_col} {id_type}, first array<double>, mean array<double>")


def _pool_by_join(docs: DataFrame, word_vectors: DataFrame, dim, tokens_col: str, id_col: str, length: int) -> DataFrame:
    """The same with a word table of any size.

    Same result as :func:`window_token_states` + :func:`pool_token_states`,
    with one shuffle instead of three: every slot row carries its
    document's mask sum, and slot 0 is kept even when its word is unknown
    (zero state), so every document reaches the single ``groupBy`` and no
    join back to the documents is needed.  The ``Summarizer`` partial is one
    vector per document per task (a document's slots come from one row).
    """
    zero = F.array_repeat(F.lit(0.0), dim.cast("int") if not isinstance(dim, int) else F.lit(dim))
    win = docs.select(id_col, token_window(tokens_col, length).alias("w")).select(
        id_col, "w", F.aggregate("w.mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("mask_sum"))
    slots = win.select(id_col, "mask_sum", F.posexplode(_looked_up(F.col("w.window"))).alias("pos", "word"),
                       F.col("w.mask").alias("_m"))
    slots = slots.select(id_col, "mask_sum", "pos", "word", F.element_at("_m", F.col("pos") + 1).alias("mask"))
    hit = _join_words(slots, word_vectors.select("word", "vec"), "left")
    kept = hit.where(F.col("vec").isNotNull() | (F.col("pos") == 0)).select(
        id_col, "mask_sum", "pos", "mask",
        F.coalesce(F.transform("vec", lambda x: x.cast("double")), zero).alias("state"))
    rows = kept.select(id_col, "mask_sum",
                       array_to_vector(F.transform("state", lambda x: x * F.col("mask"))).alias("v"),
                       F.when(F.col("pos") == 0, F.col("state")).alias("f"))
    agg = rows.groupBy(id_col).agg(Summarizer.sum(F.col("v")).alias("s"), F.first("f", ignorenulls=True).alias("first"),
                                   F.max("mask_sum").alias("mask_sum"))
    denom = F.greatest(F.col("mask_sum").cast("double"), F.lit(MASK_FLOOR))
    return agg.select(id_col, "first", F.transform(vector_to_array("s"), lambda x: x / denom).alias("mean"))


def long_vectors(df: DataFrame, id_col: str, vec_col: str, value_col: str = "value") -> DataFrame:
    """``(id, dim, value)`` rows of an array column, value rounded to 6 places."""
    # the outer form plus a filter: a plain explode evaluates the array a second time for an inferred size filter
    return df.select(id_col, F.posexplode_outer(vec_col).alias("dim", "_v")).where(F.col("dim").isNotNull()).select(
        id_col, "dim", F.round("_v", 6).alias(value_col))


# ---------------------------------------------------------------------------
# Batch inference with a pluggable encoder

class WordVectorEncoder:
    """Static encoder used when no model weights are available: token state = word vector.

    ``table`` is a broadcast :class:`WordTable`; a batch's states are one gather by word id.
    """

    def __init__(self, table, length: int = WINDOW_LENGTH):
        self.table, self.length = table, length

    def encode(self, token_lists: list) -> tuple[np.ndarray, np.ndarray]:
        """States ``(batch, length, dim)`` and mask ``(batch, length)`` for a batch of token lists."""
        words, most = self.table.value, self.length - 2
        lens = np.array([min(len(t), most) for t in token_lists], np.int64)
        content = words.ids(pa.array([w for t in token_lists for w in t[:most]], pa.string()))
        sep, pad = words.ids(pa.array([SEP_TOKEN, PAD_TOKEN]))
        slot = np.arange(self.length)
        window = np.full((len(lens), self.length), pad)
        window[(slot > 0) & (slot <= lens[:, None])] = content
        window[np.arange(len(lens)), lens + 1] = sep
        window[:, 0] = window[:, 1]
        return words.matrix[window].astype(np.float64), (slot < lens[:, None] + 2).astype(np.float64)


def encode_documents(docs: DataFrame, encoder_factory: Callable[[], object], tokens_col: str = "tokens",
                     id_col: str = "doc_id", batch: int = ENCODE_BATCH) -> DataFrame:
    """``(doc_id, first array<double>, mean array<double>)`` through ``encoder.encode`` in batches."""

    def run(batches):
        enc = encoder_factory()
        for pdf in batches:
            ids = pdf[id_col].to_numpy()
            toks = pdf[tokens_col].tolist()
            for s in range(0, len(toks), batch):
                states, mask = enc.encode([list(t) if t is not None else [] for t in toks[s: s + batch]])
                first = states[:, 0, :]
                mean = (states * mask[:, :, None]).sum(axis=1) / np.maximum(mask.sum(axis=1), MASK_FLOOR)[:, None]
                yield pd.DataFrame({id_col: ids[s: s + batch], "first": list(first), "mean": list(mean)})

    schema = f"{id_col} long, first array<double>, mean array<double>"
    return docs.select(id_col, tokens_col).mapInPandas(run, schema)
