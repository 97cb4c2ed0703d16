"""Ranked lexical search without a document index, by one Aho-Corasick scan of the texts.

The items' terms become one automaton, broadcast to every task.  Each term is
guarded by a blank on both sides and each text is brought to the same form
(A-Z lower-cased, every byte outside a term a blank), so the automaton finds
whole terms alone and counts ``tf`` while it reads the text once.  A term's
output maps to the items that hold it, so a document's counts are added up by
item in 64-bit integers, and a task keeps ``k`` documents an item.

The scan's counts are staged: document frequencies and lengths of the whole
corpus are needed before the first score.  ``PART_TERMS`` bounds an automaton:
(item, term) pairs are numbered in order and cut into parts of that many, each
with a scan of its own.  An item whose pairs lie in several parts is scored in
pieces, and its pieces' scores are added by document before it is ranked.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..operators.common import global_row_number
from .common import free_name, read, stage, text_bytes, text_key

K, PART_TERMS, STRETCH, CELLS = 20, 100_000, 1 << 20, 1 << 21
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A-Z to a-z, the bytes of other terms as they are, all else to a blank.
FORM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
COUNTS = "id long, text_key long, n long, terms array<int>, tfs array<int>"
_second = itemgetter(1)


def stretches(line: bytes, most: int = STRETCH):
    """The text in pieces of about ``most`` bytes, cut at blanks."""
    a = 0
    while a < len(line):
        b = line.find(b" ", a + most)
        b = len(line) if b < 0 else b
        yield line[a:b]
        a = b


def scan(automaton, text: bytes, stretch: int = STRETCH) -> tuple[int, dict[int, int]]:
    """``(number of terms, {number of an item's term: tf})`` of a text."""
    n, found = 0, Counter()
    for line in stretches(text.translate(FORM), stretch):
        inside = np.frombuffer(line, np.uint8) != 32
        n += int(inside[0]) + int(np.count_nonzero(inside[1:] & ~inside[:-1]))
        # one character a byte, so that the automaton has at most 256 branches a state
        found.update(map(_second, automaton.iter(f" {line.decode('latin-1')} ")))
    return n, found


class Part:
    """The terms of at most ``PART_TERMS`` (item, term, times) triples, and the items each term belongs to."""

    def __init__(self, entries: list[tuple]):
        self.items = list(dict.fromkeys(e[0] for e in entries))
        self.terms = list(dict.fromkeys(e[1] for e in entries))
        of, at = {x: i for i, x in enumerate(self.items)}, {x: i for i, x in enumerate(self.terms)}
        term = np.array([at[e[1]] for e in entries], np.int64)
        order = np.argsort(term, kind="stable")
        self.item = np.array([of[e[0]] for e in entries], np.int64)[order]
        self.times = np.array([e[2] for e in entries], np.int64)[order]
        self.first = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        self.built = None

    def automaton(self):
        """Made once in each worker."""
        if self.built is None:
            a = ahocorasick.Automaton()
            for i, t in enumerate(self.terms):
                a.add_word(f" {t.encode().decode('latin-1')} ", i)
            a.make_automaton()
            self.built = a
        return self.built

    def scores(self, rows: np.ndarray, terms: np.ndarray, parts: np.ndarray, n_rows: int) -> np.ndarray:
        """``n_rows`` x items: for each hit (row, term) its part of the score, added to the term's items."""
        many = self.first[terms + 1] - self.first[terms]
        hit = np.repeat(np.arange(len(terms)), many)
        at = np.arange(len(hit)) - np.repeat(np.cumsum(many) - many, many) + self.first[terms][hit]
        out = np.zeros(n_rows * len(self.items), np.int64)
        np.add.at(out, rows[hit] * len(self.items) + self.item[at], parts[hit] * self.times[at])
        return out.reshape(n_rows, len(self.items))


def item_terms(items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """``(item, term, times)`` of all items; rows that repeat an id are one item."""
    lowered = F.translate(F.coalesce(F.col(item_text), F.lit("")), UPPER, LOWER)
    terms = items.select(F.col(item_id).alias("item"), F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term"))
    return terms.groupBy("item", "term").agg(F.count(F.lit(1)).alias("times"))


def term_counts(docs: DataFrame, part, id_col: str, text_col: str) -> DataFrame:
    """Scan: a row for each document with at least one term, with its length and the counts of the part's terms."""
    def run(batches):
        for b in batches:
            automaton, rows, ns, terms, tfs = part.value.automaton(), [], [], [], []
            for i, text in enumerate(text_bytes(b.column(2))):
                n, found = scan(automaton, text)
                if n:
                    rows.append(i)
                    ns.append(n)
                    terms.append(np.fromiter(found.keys(), np.int32, len(found)))
                    tfs.append(np.fromiter(found.values(), np.int32, len(found)))
            offs = pa.array(np.cumsum([0, *map(len, terms)]), pa.int32())
            lists = [pa.ListArray.from_arrays(offs, pa.array(np.concatenate([np.empty(0, np.int32), *x]), pa.int32())) for x in (terms, tfs)]
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(ns, pa.int64()), *lists],
                                             ["id", "text_key", "n", "terms", "tfs"])

    return docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("text_key"), text_col).mapInArrow(run, COUNTS)


class Best:
    """The ``k`` best (item, score, id) among all rows seen; equal scores by id, null last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least, self.pool, self.size = k, np.ones(n_items, np.int64), [], 0

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.least)
        if len(row):
            self.pool.append((item, scores[row, item], null[row], ids[row]))
            self.size += len(row)
        if self.size > 4 * self.k * len(self.least) + CELLS:
            self.rank()

    def rank(self) -> tuple[np.ndarray, ...]:
        if not self.pool:
            return tuple(np.empty(0, t) for t in (np.int64, np.int64, bool, np.int64))
        item, score, null, ids = (np.concatenate(x) for x in zip(*self.pool))
        order = np.lexsort((ids, null, -score, item))
        nth = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        order = order[nth < self.k]
        self.pool, self.size = [(item[order], score[order], null[order], ids[order])], len(order)
        last = nth[nth < self.k] == self.k - 1
        self.least[item[order][last]] = score[order][last]
        return self.pool[0]


def part_scores(counts: DataFrame, part, weights, n_docs: int, length: int, split: set, number: int, k: int, item_type) -> DataFrame:
    """``(item, id, text_key, score, part)``: a task's ``k`` best of each item, and all of the items that are ``split``."""
    schema = StructType([StructField("item", item_type), *(StructField(c, LongType()) for c in ("id", "text_key", "score")), StructField("part", IntegerType())])
    arrow = to_arrow_schema(schema)

    def rows(p, item, score, null, ids, key=None):
        key = pa.nulls(len(item), pa.int64()) if key is None else pa.array(key)
        return pa.RecordBatch.from_arrays([pa.array([p.items[i] for i in item.tolist()], arrow.field(0).type), pa.array(ids, pa.int64(), mask=null), key,
                                           pa.array(score, pa.int64()), pa.array(np.full(len(item), number, np.int32))], schema=arrow)

    def run(batches):
        p, w = part.value, weights.value
        best, pieces = Best(len(p.items), k), np.array([x in split for x in p.items], bool)
        for b in batches:
            null = b.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = b.column(0).fill_null(0).to_numpy()
            key = b.column(1).to_numpy()
            m = np.array([75 + 25 * n * n_docs // length for n in b.column(2).to_pylist()], np.int64)
            ends = np.cumsum(b.column(3).value_lengths().to_numpy())
            terms, tfs = (b.column(c).flatten().to_numpy().astype(np.int64) for c in (3, 4))
            row = np.repeat(np.arange(b.num_rows), np.diff(ends, prepend=0))
            gain = w[terms] * (1_000_000_000 * tfs // (1000 * tfs + 12 * m[row]))
            work = np.cumsum(p.first[terms + 1] - p.first[terms])  # additions up to each hit
            a = 0
            while a < b.num_rows:  # rows whose table of scores and whose additions fill about CELLS numbers
                lo = int(ends[a - 1]) if a else 0
                most = int(np.searchsorted(work, (work[lo - 1] if lo else 0) + CELLS, "right"))
                z = min(a + max(1, CELLS // len(p.items)), max(a + 1, int(np.searchsorted(ends, most, "right"))), b.num_rows)
                s = slice(lo, int(ends[z - 1]))
                scores = p.scores(row[s] - a, terms[s], gain[s], z - a)
                if pieces.any():
                    r, i = np.nonzero((scores > 0) & pieces)
                    yield rows(p, i, scores[r, i], null[a:z][r], ids[a:z][r], key[a:z][r])
                    scores[:, pieces] = 0
                best.add(scores, ids[a:z], null[a:z])
                a = z
        yield rows(p, *best.rank())

    return counts.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text", part_terms: int = PART_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``k`` best documents with a score above 0.

    Every row of ``docs`` is a document of its own, repeated rows too; null and
    empty texts, and texts of blanks and signs, have no term and count nowhere;
    a null id ranks last among equal scores.  Rows of ``items`` that repeat an
    id (null too) are one item with the terms of all; items without a term
    have no rows.  An empty table on either side gives an empty result.  Other
    columns of both tables, whatever their names, play no part.
    """
    spark = docs.sparkSession
    numbered = global_row_number(item_terms(items, item_id, item_text), ["item", "term"], "place")
    pairs = stage(numbered.withColumn("part", F.floor(F.col("place") / part_terms).cast("int")), "item_terms")
    item_type, name = pairs.schema["item"].dataType, free_name(docs.select(id_col), item_id)
    n_parts = (pairs.agg(F.max("part")).first()[0] or 0) + 1
    found, n_docs, length = [], 0, 0
    ends = [{r["item"] for r in pairs.where(F.col("place") % part_terms == e).collect()} for e in (part_terms - 1, 0)] if n_parts > 1 else [set(), set()]
    split = ends[0] & ends[1]  # an item on both sides of a border; at most one a border
    for number in range(n_parts):
        entries = [(r["item"], r["term"], r["times"]) for r in pairs.where(F.col("part") == number).collect()]
        if not entries:
            break
        part = spark.sparkContext.broadcast(Part(entries))
        counts = stage(term_counts(docs, part, id_col, text_col), "term_counts")
        if not number:
            n_docs, length = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = F.col("df").cast("double")  # at most part_terms rows
        weight = F.floor(1000 * F.log((2 * F.lit(float(n_docs)) + 2) / (2 * df + 1))).cast("long")
        seen = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).select("term", weight.alias("w"))
        w = np.zeros(len(part.value.terms), np.int64)
        for r in seen.collect():
            w[r["term"]] = r["w"]
        weights = spark.sparkContext.broadcast(w)
        found.append(stage(part_scores(counts, part, weights, n_docs, length, split, number, k, item_type), "part_scores"))
        part.unpersist()
        weights.unpersist()
    if not found:
        return docs.limit(0).select(F.lit(None).cast(item_type).alias(name), F.lit(0).alias("rank"),
                                    F.col(id_col).cast("long").alias(id_col), F.lit(0).cast("long").alias("score"))
    rows = reduce(DataFrame.unionByName, found)
    top = rows.where(F.col("text_key").isNull()).select("item", "id", "score")
    if split:  # copies of a text have equal pieces: one of them is added up, and then stands for at most k
        piece = rows.where(F.col("text_key").isNotNull()).groupBy("item", "id", "text_key", "part").agg(
            F.max("score").alias("score"), F.count(F.lit(1)).alias("copies"))
        whole = piece.groupBy("item", "id", "text_key").agg(F.sum("score").alias("score"), F.max("copies").alias("copies"))
        copies = F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int")))
        top = top.unionByName(whole.select("item", "id", "score", copies).select("item", "id", "score"))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return (top.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(F.col("item").alias(name), "rank", F.col("id").alias(id_col), "score"))


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    """``op11``: the 20 best documents of every benchmark item, see the module docstring."""
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
