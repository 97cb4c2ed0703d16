"""Exact cosine k-nearest neighbours over a ball index, and the neighbour vote.

A train side of at most ``BLOCK_BYTES`` is broadcast and met by the queries
where they lie.  A larger one becomes a :class:`BallIndex`:

* every row goes to the nearest of at most ``CENTRE_BYTES`` of centres (a seeded
  draw of the rows), and a ball keeps its reach, the widest angle of a member
  to its centre.  Balls are cut into blocks of ``BLOCK_BYTES``, and blocks are
  dealt to at most ``MAX_BINS`` bins, the buckets of a table;
* angles between unit vectors obey the triangle inequality, so no member of a
  ball is closer to a query than ``cos(angle to the centre - reach)``.  A query
  first meets the ball with the best bound, then all others whose bound is not
  below its k-th similarity so far;
* only queries move, once to each bin in which they visit a ball, however many
  balls or blocks that holds, and never stored in between.  A bin and its
  queries meet in one group (the bucketed table needs no exchange): tiles of
  ``TILE_ROWS`` keep their k best over the bin, skip balls below them, and
  return no more than k rows a query.  A bin that very many queries visit is
  met by at most ``MAX_SHARES`` shares of them, with a copy of it each.  There
  are more bins or shares where one would pass ``MOST_BYTES``.  A group holds
  its queries once and its bin twice: as it arrives, and by ball;
* bins are met in rounds.  A round moves at most two times the bytes of both sides
  (``ROUND_BYTES`` at least), its files go before the next one begins, and later
  rounds know the k-th similarities of earlier ones.

Similarities are rounded to 9 places before ranking and ties go to the
smaller train id, so the result is deterministic and engine independent.
Zero vectors have similarity 0 to everything; rows without a vector take no part.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import let_go, remove_folder, stage, unstage
from .linalg import list_column

K_NEIGHBOURS = 5
BLOCK_BYTES = 16 << 20  # of doubles; about 32,000 rows at 64 dimensions
CHUNK_BYTES = 1 << 20
CENTRE_BYTES = 4 << 20
BIN_BYTES = 32 << 20
MAX_BINS, MAX_SHARES = 32, 16
MOST_BYTES = 128 << 20  # of vectors in a bin or a share of queries, whatever their number
ROUND_BYTES = 256 << 20
TILE_ROWS = 256
SLICE_ROWS = 1024
COLUMNS = 4096  # of a tile's product at a time
HOT_VISITS = 1 << 14
PLACES = 9
# Angles from arccos are right to about the root of the double's precision.
ANGLE_SLACK = 1e-7
FOUND = "qid long, tid long, tlabel int, sim double"
TILES = "bin int, share int, qid long, home int, least double, qvec binary"


def _unit_rows(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1)
    safe = np.where(norms > 0, norms, 1.0)
    return m / safe[:, None]


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """The vectors of a batch as unit rows."""
    lens, flat = list_column(batch, name, np.float64)
    return _unit_rows(flat.reshape(len(lens), -1)) if len(flat) else np.zeros((len(lens), 0))


def _unit_cells(batch: pa.RecordBatch, name: str):
    """``(rows, unit rows, binary cells)`` for slices of a batch, so that wide rows are not held several times over."""
    for a in range(0, batch.num_rows, SLICE_ROWS):
        rows = batch.slice(a, SLICE_ROWS)
        m = _matrix(rows, name)
        yield rows, m, pa.array([row.tobytes() for row in m], pa.binary())


def _best_of(sims: np.ndarray, tids: np.ndarray, k: int, least: np.ndarray | None = None):
    """``(row, column, place)`` of each row's k best by (rounded similarity desc, id asc), none below its ``least``."""
    keyed = np.round(sims, PLACES)
    kk = min(k, sims.shape[1])
    bar = np.partition(keyed, sims.shape[1] - kk, axis=1)[:, sims.shape[1] - kk]
    bar = bar if least is None else np.maximum(bar, least)
    r, c = np.nonzero(keyed >= bar[:, None])  # ties included
    order = np.lexsort((tids[c], -keyed[r, c], r))
    r, c = r[order], c[order]
    nth = np.arange(len(r)) - np.searchsorted(r, r)
    return r[nth < kk], c[nth < kk], nth[nth < kk]


def _by_broadcast(train: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """All neighbours where the queries lie; the train side's size has been checked."""
    rows = train.toArrow().combine_chunks()
    batch = rows.to_batches()[0]
    side = train.sparkSession.sparkContext.broadcast(
        (rows["tid"].to_numpy(), rows["tlabel"].to_numpy(zero_copy_only=False) if not rows["tlabel"].null_count else rows["tlabel"].to_pylist(), _matrix(batch, "tvec")))

    def run(batches):
        tids, labels, tm = side.value
        for b in batches:
            qids, qm = b.column(0).to_numpy(), _matrix(b, "qvec")
            step = max(1, min(TILE_ROWS, TILE_ROWS * COLUMNS // len(tids)))
            for a in range(0, len(qids), step):
                sims = qm[a:a + step] @ tm.T
                r, c, nth = _best_of(sims, tids, k)
                yield pa.RecordBatch.from_arrays([pa.array(qids[r + a]), pa.array((nth + 1).astype(np.int32)), pa.array(tids[c]),
                                                  pa.array([labels[i] for i in c.tolist()], pa.int32()), pa.array(sims[r, c])],
                                                 ["query_id", "rank", "train_id", "train_label", "sim"])

    return queries.mapInArrow(run, "query_id long, rank int, train_id long, train_label int, sim double")


def _rows(cells: pa.Array, width: int) -> np.ndarray:
    """The vectors of a binary array without nulls, one row each, where they lie."""
    if not len(cells) or not width:
        return np.zeros((len(cells), width))
    _, ends, data = cells.buffers()
    first = np.frombuffer(ends, np.int64 if pa.types.is_large_binary(cells.type) else np.int32)[cells.offset]
    return np.frombuffer(data, np.float64, len(cells) * width, int(first)).reshape(-1, width)


def _placed_rows(column: pa.ChunkedArray, order: np.ndarray, width: int) -> np.ndarray:
    """The vectors of a binary column in the given order, copied once."""
    place, out, a = np.empty(len(order), np.int64), np.empty((len(order), width)), 0
    place[order] = np.arange(len(order))
    for cells in column.chunks:
        out[place[a:a + len(cells)]] = _rows(cells, width)
        a += len(cells)
    return out


def _bounds(m: np.ndarray, centres: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """No member of a ball is closer to a row of ``m`` than this."""
    angle = np.arccos(np.clip(m @ centres.T, -1, 1)) - reach - ANGLE_SLACK
    return np.cos(np.clip(angle, 0, np.pi))


class _Best:
    """The k best of each row of a tile so far: similarities, and places among the train rows (-1: none yet)."""

    def __init__(self, n: int, k: int, least: np.ndarray):
        self.k, self.sims, self.at, self.bar = k, np.full((n, k), -np.inf), np.full((n, k), -1, np.int64), least.copy()

    def add(self, rows: np.ndarray, sims: np.ndarray, first: int, tids: np.ndarray) -> None:
        """``sims`` of the tile's ``rows`` with the train rows from place ``first`` on."""
        hit = sims >= (self.bar[rows] - 10.0 ** -PLACES)[:, None]
        r, c = np.nonzero(hit)
        if len(r) > 8 * self.k * len(rows):  # no bar yet: ties by id are settled among each row's own
            r, c, _ = _best_of(sims, tids[first:first + sims.shape[1]], self.k)
        if not len(r):
            return
        some, where = np.unique(r, return_inverse=True)
        own = rows[some]
        row = np.concatenate([np.repeat(np.arange(len(own)), self.k), where])
        at = np.concatenate([self.at[own].ravel(), c + first])
        sim = np.concatenate([self.sims[own].ravel(), sims[r, c]])
        order = np.lexsort((tids[at], -np.round(sim, PLACES), row))
        nth = np.arange(len(row)) - np.searchsorted(row[order], row[order])
        kept = order[nth < self.k].reshape(len(own), self.k)
        self.sims[own], self.at[own] = sim[kept], at[kept]
        self.bar[own] = np.maximum(self.bar[own], np.round(self.sims[own, -1], PLACES))


class BallIndex:
    """The train side as a table bucketed by bin, with each ball's centre, reach, blocks and bins."""

    def __init__(self, train: DataFrame, n_rows: int, width: int, k: int, block_rows: int | None = None, chunk_rows: int | None = None):
        spark = self.spark = train.sparkSession
        self.k, self.width, row_bytes = k, width, max(8, 8 * width)
        block_rows = block_rows or max(1, BLOCK_BYTES // row_bytes)
        chunk_rows = chunk_rows or max(1, min(block_rows, CHUNK_BYTES // row_bytes))
        n_centres = max(1, min(math.ceil(n_rows / chunk_rows), CENTRE_BYTES // row_bytes))
        some = train.where(F.exists("tvec", lambda x: x != 0))
        drawn = some.orderBy(F.xxhash64("tid", F.lit(42)), "tid").limit(n_centres).select("tvec").toArrow().combine_chunks()
        self.centres = _matrix(drawn.to_batches()[0], "tvec") if drawn.num_rows else np.zeros((0, width))
        centres = spark.sparkContext.broadcast(self.centres)

        def assign(batches):
            c = centres.value
            for b, m, cells in (x for whole in batches for x in _unit_cells(whole, "tvec")):
                ball, angle = np.full(len(m), -1, np.int32), np.zeros(len(m))
                for a in range(0, len(m), TILE_ROWS):
                    tile = m[a:a + TILE_ROWS]
                    if len(c):
                        sims = tile @ c.T
                        near = sims.argmax(axis=1)
                        ball[a:a + TILE_ROWS] = np.where(tile.any(axis=1), near, -1)
                        angle[a:a + TILE_ROWS] = np.arccos(np.clip(sims[np.arange(len(tile)), near], -1, 1))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), cells, pa.array(ball), pa.array(angle)], ["tid", "tlabel", "tvec", "ball", "angle"])

        rows = stage(train.mapInArrow(assign, "tid long, tlabel int, tvec binary, ball int, angle double"), "ball_rows")
        sizes = {r["ball"]: r for r in rows.groupBy("ball").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("reach")).collect()}  # a row a centre
        of = [sizes.get(b) for b in range(len(self.centres))]
        self.reach = np.array([s["reach"] if s else 0.0 for s in of])
        self.blocks = np.array([math.ceil(s["n"] / block_rows) if s else 0 for s in of], np.int64)
        self.n_blocks = int(self.blocks.sum())
        self.zeros = rows.where("ball < 0").orderBy("tid").limit(k).select("tid", "tlabel").collect() if -1 in sizes else []
        self.smallest = rows.orderBy("tid").limit(k).select("tid", "tlabel").collect()
        cores = spark.sparkContext.defaultParallelism
        most = max(MAX_BINS, math.ceil(n_rows * row_bytes / MOST_BYTES))
        self.n_bins = max(1, min(self.n_blocks, most, max(math.ceil(n_rows * row_bytes / BIN_BYTES), cores)))
        self.buckets = 4 * self.n_bins  # so that few bins share a task
        # balls that lie in the same direction are next to each other in a bin
        ranked = np.argsort(self.centres @ np.linalg.svd(self.centres, full_matrices=False)[2][0]) if len(self.centres) else []
        ranked = [b for b in ranked if self.blocks[b]]
        each = np.array([sizes[b]["n"] / self.blocks[b] for b in ranked for _ in range(self.blocks[b])])
        bins = np.minimum((np.cumsum(each) - each / 2) * self.n_bins // max(each.sum(), 1), self.n_bins - 1).astype(int) if len(each) else []
        places = [(int(b), part) for b in ranked for part in range(self.blocks[b])]
        self.parts = np.zeros((len(self.centres), self.n_bins), np.float32)  # a ball's blocks in each bin
        for (b, _), n in zip(places, bins):
            self.parts[b, n] += 1
        where = spark.createDataFrame([(b, int(self.blocks[b]), part, int(n)) for (b, part), n in zip(places, bins)], "ball int, parts int, part int, bin int")
        counts = where.select("ball", "parts").distinct()
        part = F.pmod(F.xxhash64("tid", F.monotonically_increasing_id()), F.col("parts")).cast("int")
        placed = (rows.join(F.broadcast(counts), "ball").withColumn("part", part).join(F.broadcast(where.drop("parts")), ["ball", "part"])
                  .select("bin", "ball", "tid", "tlabel", "tvec"))
        self.bin_rows = np.bincount(bins, each, self.n_bins) if len(each) else np.zeros(self.n_bins)
        self.name = f"ball_index_{uuid.uuid4().hex}"
        self.path = scratch_dir(spark, self.name)
        placed.repartition(self.buckets, "bin").write.bucketBy(self.buckets, "bin").format("parquet").option("path", self.path).saveAsTable(self.name)
        self.table = spark.table(self.name)
        self.sent = spark.sparkContext.broadcast((self.centres, self.reach, self.blocks, self.parts))
        centres.destroy()
        unstage(rows)
        let_go(spark)

    def forget(self) -> None:
        """Drops the table's entry; its files, in shared storage, stay for plans that still read them."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def end(self) -> None:
        """The table goes with its files: no plan reads it any more."""
        self.forget()
        remove_folder(self.spark, self.path)
        self.sent.destroy()

    def at_home(self, queries: DataFrame) -> DataFrame:
        """``(qid, qvec, zero, home)``: queries as unit rows, with the ball whose bound is the best."""
        index = self.sent

        def run(batches):
            centres, reach, blocks, _ = index.value
            for b, m, cells in (x for whole in batches for x in _unit_cells(whole, "qvec")):
                home = np.full(len(m), -1, np.int32)
                if blocks.any() and m.shape[1]:
                    for a in range(0, len(m), TILE_ROWS):
                        home[a:a + TILE_ROWS] = np.where(blocks > 0, _bounds(m[a:a + TILE_ROWS], centres, reach), -3.0).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([b.column(0), cells, pa.array(~m.any(axis=1)), pa.array(home)],
                                                 ["qid", "qvec", "zero", "home"])

        return queries.mapInArrow(run, "qid long, qvec binary, zero boolean, home int")

    def visits(self, queries: DataFrame, rest: bool, vectors: bool = True, bins: list[int] | None = None) -> DataFrame:
        """``(bin, blocks, qid, home, least, qvec)``: each query once for every bin (of ``bins``) with a ball to visit.

        That is its home ball, or with ``rest`` the others that may hold a neighbour; ``blocks`` counts theirs.
        """
        index, some = self.sent, np.array(range(self.n_bins) if bins is None else bins, np.int32)
        width, names = self.width, ["bin", "blocks", "qid", "home", "least", "qvec"][:6 if vectors else 2]

        def run(batches):
            centres, reach, _, parts = index.value
            parts = parts[:, some]
            for b in batches:
                home, least = b.column(1).to_numpy(), b.column(2).fill_null(-2.0).to_numpy(zero_copy_only=False)
                for a in range(0, b.num_rows, TILE_ROWS):
                    own = home[a:a + TILE_ROWS]
                    if rest:
                        wanted = _bounds(_rows(b.column(3).slice(a, TILE_ROWS), width), centres, reach) >= (least[a:a + TILE_ROWS] - 10.0 ** -PLACES)[:, None]
                        wanted[np.arange(len(own)), own] = False
                        n = wanted.astype(np.float32) @ parts
                    else:
                        n = parts[own]
                    r, c = np.nonzero(n)
                    at = pa.array(r + a)
                    cells = [pa.array(some[c]), pa.array(n[r, c], pa.int64())]
                    if vectors:
                        cells += [b.column(0).take(at), b.column(1).take(at), pa.array(least[r + a]), b.column(3).take(at)]
                    yield pa.RecordBatch.from_arrays(cells, names)

        schema = "bin int, blocks long" + (", qid long, home int, least double, qvec binary" if vectors else "")
        return queries.select("qid", "home", "least", "qvec").mapInArrow(run, schema)

    def plan(self, queries: DataFrame, rest: bool, n_queries: int) -> tuple[list[list[int]], dict[int, int], int]:
        """The bins of each round; the shares of bins that very many visit; the blocks visited."""
        counts = self.visits(queries, rest, vectors=False).groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("blocks").alias("blocks")).orderBy("bin").collect()  # a row a bin
        row_bytes = max(8, 8 * self.width)
        most = max(1, min(HOT_VISITS, BIN_BYTES // row_bytes))
        hot = {r["bin"]: min(max(MAX_SHARES, math.ceil(r["n"] * row_bytes / MOST_BYTES)), math.ceil(r["n"] / most)) for r in counts if r["n"] > most}
        limit, rounds, moved = max(ROUND_BYTES, 2 * row_bytes * (n_queries + self.bin_rows.sum())), [], 0
        for r in counts:
            own = row_bytes * (r["n"] + hot.get(r["bin"], 0) * self.bin_rows[r["bin"]])
            if not rounds or moved + own > limit:
                rounds, moved = [*rounds, []], 0
            rounds[-1].append(r["bin"])
            moved += own
        return rounds, hot, sum(r["blocks"] for r in counts)

    def tiles(self, queries: DataFrame, rest: bool, bins: list[int], hot: dict[int, int]) -> DataFrame:
        """The visits to the bins of a round, dealt to shares in the ``hot`` ones."""
        visits, share = self.visits(queries, rest, bins=bins), F.lit(0)
        if hot:
            parts = self.spark.createDataFrame(list(hot.items()), "bin int, parts int")
            visits = visits.join(F.broadcast(parts), "bin", "left")
            share = F.pmod(F.xxhash64("qid", F.monotonically_increasing_id()), F.coalesce("parts", F.lit(1))).cast("int")
        return visits.select("bin", share.alias("share"), "qid", "home", "least", "qvec")

    def meet(self, tiles: DataFrame, hot: dict[int, int], rest: bool = True, bins: list[int] | None = None) -> DataFrame:
        """``(qid, tid, tlabel, sim)``: the best of each query in each bin (of ``bins``) that it visits."""
        index, k, width = self.sent, self.k, self.width
        table = self.table if bins is None else self.table.where(F.col("bin").isin(bins))

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            found = []
            if left.num_rows and right.num_rows:
                balls = right["ball"].to_numpy()
                order = np.argsort(balls, kind="stable")
                balls, T = balls[order], _placed_rows(right["tvec"], order, width)
                right = right.select(["tid", "tlabel"]).take(pa.array(order))
                tids = np.append(pc.fill_null(right["tid"], -1 << 63).to_numpy(), (1 << 63) - 1)  # the last: none yet
                first = np.flatnonzero(np.diff(balls, prepend=-1))
                held = balls[first]
                centres, reach = index.value[0][held], index.value[1][held]
                for tile in (b.slice(a, TILE_ROWS) for b in left.to_batches() for a in range(0, b.num_rows, TILE_ROWS)):
                    q, own = _rows(tile["qvec"], width), tile["home"].to_numpy()
                    best = _Best(len(q), k, tile["least"].to_numpy())
                    bound = _bounds(q, centres, reach) if rest else None
                    for j in np.argsort(-bound.max(axis=0)) if rest else np.flatnonzero(np.isin(held, own)):
                        end = first[j + 1] if j + 1 < len(first) else len(T)
                        for s in range(first[j], end, COLUMNS):
                            rows = np.flatnonzero((own != held[j]) & (bound[:, j] >= best.bar - 10.0 ** -PLACES) if rest else own == held[j])
                            if len(rows):
                                best.add(rows, q[rows] @ T[s:min(end, s + COLUMNS)].T, s, tids)
                    r, c = np.nonzero(best.at >= 0)
                    at = pa.array(best.at[r, c])
                    found.append(pa.table({"qid": tile["qid"].take(pa.array(r)), "tid": right["tid"].take(at), "tlabel": right["tlabel"].take(at), "sim": best.sims[r, c]}))
            return pa.concat_tables(found) if found else pa.schema([("qid", pa.int64()), ("tid", pa.int64()), ("tlabel", pa.int32()), ("sim", pa.float64())]).empty_table()

        few, found = tiles.where(~F.col("bin").isin([*hot])) if hot else tiles, None
        if bins is None or not hot.keys() >= set(bins):
            rows = table.where(~F.col("bin").isin([*hot])) if hot else table
            found = few.groupBy("bin").cogroup(rows.groupBy("bin")).applyInArrow(run, FOUND)
        if hot:
            parts = self.spark.createDataFrame([(b, i) for b, n in hot.items() for i in range(n)], "bin int, share int")
            n = 8 * sum(hot.values())  # so that few groups share a task
            copies = table.where(F.col("bin").isin([*hot])).join(F.broadcast(parts), "bin").repartition(n, "bin", "share")
            many = tiles.where(F.col("bin").isin([*hot])).repartition(n, "bin", "share")
            shared = many.groupBy("bin", "share").cogroup(copies.groupBy("bin", "share")).applyInArrow(run, FOUND)
            found = shared if found is None else found.unionByName(shared)
        return found

    def search(self, queries: DataFrame, stats: dict | None = None) -> DataFrame:
        """``(qid, tid, tlabel, sim)`` of the k best of every query; ``stats`` gets the blocks visited and pruned."""
        asked = queries.where("not zero")
        best, visited, n_queries = self._candidates(asked, self.zeros), 0, asked.count()

        def with_least():
            kth = best.groupBy("qid").agg(F.when(F.count(F.lit(1)) >= self.k, F.min("sim")).alias("least"))
            return asked.join(kth, "qid", "left")

        for rest in (False, True) if self.n_blocks else ():
            rounds, shares, n = self.plan(with_least(), rest, n_queries)
            for bins in rounds:
                hot, before = {b: shares[b] for b in bins if b in shares}, best
                found = self.meet(self.tiles(with_least(), rest, bins, hot), hot, rest, bins)
                best = stage(_first(best.unionByName(found), self.k), "ball_best")
                unstage(before)
                let_go(self.spark)
            visited += n
        if stats is not None:
            stats.update(visited=visited, blocks=self.n_blocks, bins=self.n_bins, pruned=n_queries * self.n_blocks - visited)
        self.last = [best]
        return best.unionByName(self._candidates(queries.where("zero"), self.smallest))

    def _candidates(self, queries: DataFrame, rows: list) -> DataFrame:
        """Every query with each of at most k rows that have similarity 0 to it."""
        cells = [F.struct(F.lit(r["tid"]).cast("long").alias("tid"), F.lit(r["tlabel"]).cast("int").alias("tlabel")) for r in rows]
        some = queries.select("qid", F.explode(F.array(*cells)).alias("t")) if cells else queries.limit(0).select("qid", F.struct(
            F.lit(0).cast("long").alias("tid"), F.lit(0).alias("tlabel")).alias("t"))
        return some.select("qid", "t.tid", "t.tlabel", F.lit(0.0).alias("sim"))


def _first(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy(F.round("sim", PLACES).desc(), F.col("tid").asc())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("rank")


def knn(train: DataFrame, queries: DataFrame, k: int = K_NEIGHBOURS, block_rows: int | None = None,
        train_id: str = "vec_id", query_id: str = "vec_id", vec_col: str = "embedding",
        label_col: str = "label", chunk_rows: int | None = None, stats: dict | None = None, spent: bool = False) -> DataFrame:
    """``(query_id, rank, train_id, train_label, sim)`` for the k most cosine-similar train rows.

    ``block_rows`` asks for the index whatever the train side's size, with blocks of that many rows.
    ``spent``: ``train`` is a stage that nothing else reads; it goes as soon as its rows are in memory or in the index.
    """
    tr = train.where(F.col(vec_col).isNotNull()).select(F.col(train_id).cast("long").alias("tid"), F.col(label_col).cast("int").alias("tlabel"),
                                                        F.col(vec_col).cast("array<double>").alias("tvec"))
    qu = queries.where(F.col(vec_col).isNotNull()).select(F.col(query_id).cast("long").alias("qid"), F.col(vec_col).cast("array<double>").alias("qvec"))
    n_rows, width = tr.agg(F.count(F.lit(1)), F.max(F.size("tvec"))).first()
    if not n_rows or block_rows is None and 8 * n_rows * width <= BLOCK_BYTES:
        if n_rows:
            found = _by_broadcast(tr, qu, k)
            if spent:
                unstage(train)
            return found
        return qu.limit(0).select(F.col("qid").alias("query_id"), F.lit(0).alias("rank"), F.lit(0).cast("long").alias("train_id"),
                                  F.lit(0).alias("train_label"), F.lit(0.0).alias("sim"))

    index = BallIndex(tr, n_rows, width, k, block_rows, chunk_rows)
    if spent:
        unstage(train)
    try:
        asked = stage(index.at_home(qu), "ball_queries")
        best = index.search(asked, stats)
        top = stage(best, "neighbours")
        unstage(asked, *index.last)
    finally:
        index.end()
    let_go(tr.sparkSession)
    w = Window.partitionBy("qid").orderBy(F.round("sim", PLACES).desc(), F.col("tid").asc())
    return top.select(F.col("qid").alias("query_id"), F.row_number().over(w).alias("rank"), F.col("tid").alias("train_id"),
                      F.col("tlabel").alias("train_label"), "sim")


def vote(neighbours: DataFrame) -> DataFrame:
    """Majority label of the neighbours, equal weights, ties -> smallest label."""
    counts = neighbours.groupBy("query_id", "train_label").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("query_id").orderBy(F.col("n").desc(), F.col("train_label").asc())
    return (counts.withColumn("_r", F.row_number().over(w)).where("_r = 1")
            .select("query_id", F.col("train_label").alias("pred_label")))
