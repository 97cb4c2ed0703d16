"""A3/W3 at scale: the most frequent terms by mergeable summaries, proven exact or refused.

Counting all n-grams exactly shuffles every distinct n-gram of every task,
though the vocabulary keeps 20,000.  Here each task keeps a Misra-Gries summary
of at most ``capacity`` counters, cut in batches: when there are more, the
largest count that does not fit is taken off all of them, and what falls to
zero goes.  A count is then low by at most the sum of its task's cuts, and so
is an absent term.  Summaries add up by term, their errors by addition, so

    low(term) <= tf(term) <= low(term) + error        for every term.

The ``CANDIDATES * k`` terms with the largest ``low`` are counted exactly in a
second pass (they are broadcast; their number is the bound).  No other term's
count can exceed ``low`` of the next one plus the error.  When the k-th of the
pruned candidates is above that, or no other term can reach ``min_df``, the
result is the exact top k; otherwise it is refused and the caller counts all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

CAPACITY = 1 << 19
CANDIDATES = 2


class Summary:
    """Counts of at most ``capacity`` terms, each low by at most ``error``."""

    def __init__(self, capacity: int):
        self.capacity, self.error, self.held, self.rows = capacity, 0, [], 0

    def add(self, batch: pa.RecordBatch) -> None:
        self.held.append(pa.Table.from_batches([batch]))
        self.rows += batch.num_rows
        if self.rows > 2 * self.capacity:
            self.cut()

    def cut(self) -> pa.Table | None:
        if not self.held:
            return None
        sums = pa.concat_tables(self.held).group_by("term").aggregate([("tf", "sum")])
        terms, counts = sums["term"].combine_chunks(), sums["tf_sum"].to_numpy()
        if len(counts) > self.capacity:
            off = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            self.error += off
            kept = np.flatnonzero(counts > off)
            terms, counts = terms.take(pa.array(kept)), counts[kept] - off
        self.held, self.rows = [pa.table({"term": terms, "tf": counts})], len(counts)
        return self.held[0]


def summaries(counts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``(term, low)`` of each task over its ``(term, tf)`` rows, and its error in a row without a term."""
    def run(batches):
        own = Summary(capacity)
        for b in batches:
            own.add(b)
        table = own.cut()
        if table is not None:
            for b in table.to_batches(max_chunksize=10_000):
                yield pa.RecordBatch.from_arrays(b.columns, ["term", "low"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([own.error], pa.int64())], ["term", "low"])

    return counts.select("term", F.col("tf").cast("long").alias("tf")).mapInArrow(run, "term string, low long")


def top_terms(counts: DataFrame, prune, k: int, min_df: int, capacity: int = CAPACITY, info: dict | None = None) -> DataFrame | None:
    """The ``k`` most frequent terms ``(term, tf, df)`` among those that ``prune`` keeps, or None if not proven.

    ``counts`` has a row ``(term, tf)`` for each document and distinct term.
    ``prune`` filters a table ``(term, tf, df)`` by document frequency.
    ``info`` gets the error, the bound on other terms, and whether it was proven.
    """
    merged = stage(summaries(counts, capacity).groupBy("term").agg(F.sum("low").alias("low")), "term_summaries")
    error = merged.where("term IS NULL").select(F.sum("low")).first()[0] or 0
    order = [F.col("low").desc(), F.col("term").asc()]
    first = merged.where("term IS NOT NULL").orderBy(*order).limit(CANDIDATES * k + 1).select("low", "term").collect()
    others = first[CANDIDATES * k:]
    bound = (others[0]["low"] if others else 0) + error
    spark = counts.sparkSession
    words = spark.createDataFrame([(r["term"],) for r in first[:CANDIDATES * k]], "term string")
    exact = counts.join(F.broadcast(words), "term").groupBy("term").agg(
        F.sum("tf").cast("long").alias("tf"), F.count(F.lit(1)).cast("long").alias("df"))
    top = stage(prune(exact).orderBy(F.col("tf").desc(), F.col("term").asc()).limit(k), "top_terms")
    n, last = top.agg(F.count(F.lit(1)), F.max(F.struct((-F.col("tf")).alias("tf"), "term"))).first()
    proven = bound < min_df or n == k and -last["tf"] > bound
    if not proven and n == k and not error:  # counts are exact, so ties with the next term fall by its name
        proven = (last["tf"], last["term"]) < (-others[0]["low"], others[0]["term"])
    if info is not None:
        info.update(error=error, bound=bound, proven=proven)
    return top if proven else None
