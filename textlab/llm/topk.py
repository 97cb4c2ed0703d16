"""Exact top-k search by distributed histogram selection.

The stated queries go through in blocks of a fixed size.  For a block, every
task scores its vectors against all queries of the block and counts the
scores in per-query histograms; their sums locate the bin of each query's
k-th highest score.  Rounds refine that bin until at most ``SLACK`` times k
scores lie at or above its lower edge, or it is one score wide.  A last pass
keeps the scores at or above the edge, of equal ones those with the smallest
ids, and ranks them.

A task sends, for a query, only the bins from its own k-th highest score on:
the global k-th score cannot be lower.  So a round sends at most k counts a
query and task, and the last pass at most (SLACK + 1) k rows a query and
task, also where a third of all vectors are equal.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import read, stage

K, SCALE, DIVISOR = 10, 1024, 100
BLOCK, BINS, SLACK = 4096, 512, 4
EXACT = float(1 << 53)
LIMIT = float(1 << 61)  # of a score, and of a component that takes part in one
TILE = 1024


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, vec)`` of rows with an id and a vector of finite components, scaled and floored to doubles that are integers."""
    vec = F.col(vec_col).cast("array<double>")
    fine = vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"), fine.alias("fine")).where("fine AND id IS NOT NULL")
    return rows.select("id", F.transform("vec", lambda x: F.floor(x * SCALE).cast("double")).alias("vec"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(len(column), width)


def scores(queries: np.ndarray, tile: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Integer inner products; doubles where all partial sums are exact in them, else 64-bit integers.

    Raises where a score with an ``other`` row, or a component in it, is not below ``LIMIT``.
    """
    most = np.abs(queries).max(initial=0) * np.abs(tile).max(initial=0) * max(1, queries.shape[1])
    if most < EXACT:
        return (queries @ tile.T).astype(np.int64)
    size = lambda x: (np.abs(x) >= LIMIT).astype(float)
    used = lambda x: (x != 0).astype(float)
    beyond = (np.abs(queries @ tile.T) >= LIMIT) | (size(queries) @ used(tile).T + used(queries) @ size(tile).T > 0)
    if (beyond & other).any():
        raise ValueError("a score does not lie within 2**61: scale the vectors down")
    return queries.astype(np.int64) @ tile.astype(np.int64).T


def tiles(batches, qid, qvec):
    """``(ids, scores)`` of each tile of vectors as wide as the queries; a query's own row scores below all others."""
    for b in batches:
        same = pc.equal(pc.list_value_length(b.column(1)), qvec.shape[1])
        b = b.filter(same)
        ids = b.column(0).to_numpy()
        if len(ids):
            x = matrix(b.column(1), qvec.shape[1])
            for a in range(0, len(ids), TILE):
                other = qid[:, None] != ids[None, a:a + TILE]
                yield ids[a:a + TILE], scores(qvec, x[a:a + TILE], other), other


def _count(block, k: int):
    """Counts of scores in ``BINS`` bins of [low, high] of each query, from this task's k-th highest bin on."""
    def run(batches):
        qid, qvec, low, width = block.value
        counts = np.zeros((len(qid), BINS + 1), np.int64)  # the last bin: at or above the interval's end
        for _, s, other in tiles(batches, qid, qvec):
            at = np.clip((s - low[:, None]) // width[:, None], -1, BINS)
            use = other & (at >= 0)
            row = np.broadcast_to(np.arange(len(qid))[:, None], s.shape)
            counts += np.bincount((row * (BINS + 1) + at)[use], minlength=counts.size).reshape(counts.shape)
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1]
        keep = (counts > 0) & ((above - counts) < k)
        q, at = np.nonzero(keep)
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(at, pa.int32()), pa.array(counts[q, at])],
                                         names=["q", "bin", "n"])

    return run


def _collect(block, k: int):
    """Rows at or above each query's edge: this task's best k by (score, smaller id) among them."""
    def run(batches):
        qid, qvec, low, _ = block.value
        best: list = [None] * len(qid)
        for ids, s, other in tiles(batches, qid, qvec):
            hit = other & (s >= low[:, None])
            for q in np.flatnonzero(hit.any(axis=1)).tolist():
                new_s, new_i = s[q][hit[q]], ids[hit[q]]
                if best[q] is not None:
                    new_s, new_i = np.concatenate([best[q][0], new_s]), np.concatenate([best[q][1], new_i])
                if len(new_s) > k:
                    order = np.lexsort((new_i, -new_s))[:k]
                    new_s, new_i = new_s[order], new_i[order]
                best[q] = new_s, new_i
        found = [(q, b) for q, b in enumerate(best) if b is not None]
        if found:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat([q for q, _ in found], [len(b[0]) for _, b in found]), pa.int32()),
                pa.array(np.concatenate([b[1] for _, b in found])), pa.array(np.concatenate([b[0] for _, b in found]))],
                names=["q", "id", "score"])

    return run


def search_block(rows: DataFrame, qid: np.ndarray, qvec: np.ndarray, k: int, longest: float) -> DataFrame:
    """Top k of every query of one block (at most ``BLOCK`` queries are broadcast)."""
    sc = rows.sparkSession.sparkContext
    reach = np.sqrt((qvec * qvec).sum(axis=1)) * longest + 1  # no score is larger
    reach = np.minimum(reach, 2.0 ** 61).astype(np.int64)
    low, high = -reach, reach
    while True:
        width = np.maximum(1, -(-(high - low + 1) // BINS))
        block = sc.broadcast((qid, qvec, low, width))
        counts = rows.mapInArrow(_count(block, k), "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        above = F.sum("n").over(Window.partitionBy("q").orderBy(F.col("bin").desc()))
        # the k-th score's bin, or the lowest seen where there are fewer than k
        cut = (counts.withColumn("above", above).withColumn("reached", F.col("above") >= k).groupBy("q")
               .agg(F.coalesce(F.max(F.when(F.col("reached"), F.col("bin"))), F.min("bin")).alias("bin"),
                    F.coalesce(F.min(F.when(F.col("reached"), F.col("above"))), F.max("above")).alias("above")))
        found = cut.toArrow()  # one row a query of the block
        q, at, n = (found.column(c).to_numpy() for c in ("q", "bin", "above"))
        top = high.copy()
        low[q] += at * width[q]
        high[q] = np.where(at < BINS, np.minimum(low[q] + width[q] - 1, top[q]), top[q])
        done = np.ones(len(qid), bool)
        done[q] = (n <= SLACK * k) | (high[q] <= low[q])
        if done.all():
            break
    block = sc.broadcast((qid, qvec, low, width))
    out = rows.mapInArrow(_collect(block, k), "q int, id long, score long")
    names = rows.sparkSession.createDataFrame(list(enumerate(qid.tolist())), "q int, query_id long")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).join(F.broadcast(names), "q").select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def top_k(vectors: DataFrame, is_query, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k highest scores of each query row, ties to the smaller id.

    ``is_query`` is a condition on ``id``.  Null ids, null vectors and vectors with null or non-finite
    components take no part; a query meets the vectors of its own width.  Every query
    row is answered; rows that carry its id are its own, and rows that repeat another id
    each count.  A score beyond 2**61 raises.  A query without candidates has no rows.  Other columns are not read.
    """
    rows = stage(usable(vectors, id_col, vec_col), "topk_vectors")
    width, norm = F.size("vec").alias("width"), F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    longest = {r["width"]: r["longest"] for r in rows.groupBy(width).agg(F.max(norm).alias("longest")).collect()}  # a row a width
    queries = rows.where(is_query).withColumn("width", F.size("vec"))
    n = {r["width"]: r["count"] for r in queries.groupBy("width").count().collect()}
    out = None
    for w, count in sorted(n.items()):
        parts = -(-count // block)
        part = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(parts))
        for i in range(parts):
            got = queries.where((F.col("width") == w) & (part == i)).select("id", "vec").orderBy("id").toArrow()
            for a in range(0, got.num_rows, block):  # a part can be somewhat larger than a block
                ids = got.column("id").to_numpy()[a:a + block]
                vec = matrix(got.column("vec").combine_chunks(), w)[a:a + block]
                found = stage(search_block(rows, ids, vec, k, longest[w] or 0.0), "topk_block")
                out = found if out is None else out.unionByName(found)
    if out is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("score")).limit(0)
    return out


def op7_topk(spark, sf_dir: str) -> DataFrame:
    """``op7``: the 10 highest scores of every vector whose id is divisible by 100, against all others."""
    return top_k(read(spark, sf_dir, "embeddings"), F.col("id") % DIVISOR == 0)
