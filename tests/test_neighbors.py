import numpy as np
import pytest

from textlab.operators import neighbors

SCHEMA = "vec_id long, label int, embedding array<double>"


def table(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, int(i % 3), None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)], SCHEMA)


def unit(m):
    n = np.linalg.norm(m, axis=1)
    return m / np.where(n > 0, n, 1)[:, None]


def want(tr, te, k=5, first=1000):
    sims = unit(te) @ unit(tr).T
    out = {}
    for q in range(len(te)):
        best = np.argsort(-np.round(sims[q], 9), kind="stable")[:k]
        out[first + q] = [(int(i), int(i % 3), round(float(sims[q, i]), 9)) for i in best]
    return out


def have(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["train_id"], r["train_label"], round(r["sim"], 9)))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 16}, {"block_rows": 16, "chunk_rows": 4}, {"block_rows": 1000}])
def test_knn_equals_brute_force(spark, sizes):
    rng = np.random.default_rng(3)
    tr, te = rng.standard_normal((60, 8)), rng.standard_normal((15, 8))
    tr[7:12] = tr[3]  # copies, so ties
    tr[20] = tr[33] = tr[41] = te[4] = 0
    assert have(neighbors.knn(table(spark, tr), table(spark, te, 1000), **sizes)) == want(tr, te)


def clusters(rng, n, centres):
    return centres[rng.integers(0, len(centres), n)] + 0.02 * rng.standard_normal((n, centres.shape[1]))


def test_bounds_prune_most_blocks_and_lose_nothing(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 16))
    tr, te = clusters(rng, 1200, centres), clusters(rng, 50, centres)
    stats = {}
    got = neighbors.knn(table(spark, tr), table(spark, te, 10_000), block_rows=20, chunk_rows=10, stats=stats)
    assert have(got) == want(tr, te, first=10_000)
    assert stats["blocks"] >= 60 and stats["pruned"] > 0.8 * 50 * stats["blocks"], stats


def test_a_block_that_most_queries_visit_is_shared(spark, monkeypatch):
    rng = np.random.default_rng(6)
    tr = clusters(rng, 200, rng.standard_normal((4, 6)))
    te = np.repeat(tr[:2], 30, axis=0)
    monkeypatch.setattr(neighbors, "HOT_VISITS", 8)
    monkeypatch.setattr(neighbors, "TILE_ROWS", 4)
    assert have(neighbors.knn(table(spark, tr), table(spark, te, 1000), block_rows=50, chunk_rows=20)) == want(tr, te)


def test_train_rows_do_not_move_when_queries_meet_them(spark):
    rng = np.random.default_rng(7)
    tr = neighbors.F
    rows = table(spark, rng.standard_normal((64, 4))).select(tr.col("vec_id").alias("tid"), tr.col("label").alias("tlabel"), tr.col("embedding").alias("tvec"))
    index = neighbors.BallIndex(rows, 64, 4, 5, 8, 8)
    try:
        tiles = spark.createDataFrame([], neighbors.TILES)
        plan = index.meet(tiles, {})._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") <= 1, plan
    finally:
        index.forget()


def test_zero_null_and_empty_sides(spark):
    rng = np.random.default_rng(8)
    tr = [*rng.standard_normal((20, 3)), None, None]
    te = [rng.standard_normal(3), None, np.zeros(3)]
    for sizes in ({}, {"block_rows": 4}):
        got = have(neighbors.knn(table(spark, tr), table(spark, te, 1000), **sizes))
        both = want(np.array(tr[:20]), np.array([te[0], te[2]]))
        assert got == {1000: both[1000], 1002: both[1001]}
        assert neighbors.knn(table(spark, []), table(spark, te), **sizes).count() == 0
        assert neighbors.knn(table(spark, tr), table(spark, []), **sizes).count() == 0
        few = neighbors.knn(table(spark, tr[:2]), table(spark, te[:1], 1000), **sizes)
        assert have(few) == want(np.array(tr[:2]), np.array(te[:1]))
        zeros = neighbors.knn(table(spark, np.zeros((8, 3))), table(spark, te[:1], 1000), **sizes)
        assert have(zeros) == want(np.zeros((8, 3)), np.array(te[:1]))


def test_vote_tie_goes_to_smallest_label(spark):
    nn = spark.createDataFrame([(1, 3), (1, 3), (1, 1), (1, 1), (1, 2)], "query_id long, train_label int")
    assert neighbors.vote(nn).first()["pred_label"] == 1


def test_a_query_moves_once_to_a_bin_however_many_blocks_it_visits(spark, monkeypatch):
    rng = np.random.default_rng(9)
    monkeypatch.setattr(neighbors, "MAX_BINS", 3)
    tr, te = rng.standard_normal((400, 24)), rng.standard_normal((30, 24))  # bounds prune next to nothing here
    seen, stats, meet = [], {}, neighbors.BallIndex.meet

    def counted(index, tiles, *more):
        seen.append((index.n_blocks, tiles.count()))
        return meet(index, tiles, *more)

    monkeypatch.setattr(neighbors.BallIndex, "meet", counted)
    assert have(neighbors.knn(table(spark, tr), table(spark, te, 1000), block_rows=8, stats=stats)) == want(tr, te)
    assert stats["blocks"] >= 50 and stats["visited"] > 20 * 30
    assert sum(n for _, n in seen) <= 30 * (3 + 3), seen


def test_a_tile_holds_few_numbers_whatever_the_sides(spark, monkeypatch):
    rng = np.random.default_rng(10)
    monkeypatch.setattr(neighbors, "COLUMNS", 7)
    monkeypatch.setattr(neighbors, "TILE_ROWS", 4)
    tr, te = rng.standard_normal((90, 5)), rng.standard_normal((20, 5))
    tr[5:30] = tr[4]  # ties over several products
    for sizes in ({}, {"block_rows": 40}):
        assert have(neighbors.knn(table(spark, tr), table(spark, np.vstack([te, tr[4:6]]), 1000), **sizes)) == want(tr, np.vstack([te, tr[4:6]]))


def test_vectors_are_read_where_they_lie_and_copied_once(spark):
    rng = np.random.default_rng(11)
    m = rng.standard_normal((50, 6))
    cells = neighbors.pa.array([row.tobytes() for row in m], neighbors.pa.binary())
    some = neighbors._rows(cells.slice(7, 30), 6)
    assert (some == m[7:37]).all() and some.base is not None and not some.flags["OWNDATA"]
    assert np.shares_memory(some, neighbors._rows(cells, 6))  # no copy of the cells
    order = rng.permutation(50)
    column = neighbors.pa.chunked_array([cells.slice(0, 13), cells.slice(13, 0), cells.slice(13)])
    assert (neighbors._placed_rows(column, order, 6) == m[order]).all()


def test_bins_and_shares_stay_below_their_bytes(spark, monkeypatch):
    rng = np.random.default_rng(12)
    for name, value in {"MAX_BINS": 2, "MAX_SHARES": 2, "HOT_VISITS": 4, "TILE_ROWS": 4, "SLICE_ROWS": 7, "BIN_BYTES": 1000, "MOST_BYTES": 1600}.items():
        monkeypatch.setattr(neighbors, name, value)
    tr, te = rng.standard_normal((400, 5)), rng.standard_normal((120, 5))  # 16,000 and 4,800 bytes of vectors
    seen, meet = [], neighbors.BallIndex.meet

    def counted(index, tiles, hot, *more):
        seen.append((index.n_bins, max([1, *hot.values()])))
        return meet(index, tiles, hot, *more)

    monkeypatch.setattr(neighbors.BallIndex, "meet", counted)
    assert have(neighbors.knn(table(spark, tr), table(spark, te, 1000), block_rows=8)) == want(tr, te)
    assert all(bins >= 10 for bins, _ in seen) and max(shares for _, shares in seen) > 2, seen


def left_in(spark):
    """The folders of stages and of indexes under the checkpoint root."""
    from pathlib import Path

    from textlab.session import checkpoint_root

    root = Path(checkpoint_root(spark).removeprefix("file:")) / "textlab"
    return {p.name for p in root.glob("*") if p.name.startswith(("ball_", "neighbours", "knn_train"))}


def test_rounds_bound_what_moves_at_a_time_and_leave_nothing_behind(spark, monkeypatch):
    rng = np.random.default_rng(13)
    for name, value in {"HOT_VISITS": 16, "TILE_ROWS": 8, "ROUND_BYTES": 1, "MAX_BINS": 16}.items():
        monkeypatch.setattr(neighbors, name, value)
    tr, te = rng.standard_normal((300, 6)), rng.standard_normal((60, 6))  # 14,400 and 2,880 bytes of vectors
    tr[9:14] = tr[2]  # ties over rounds
    seen, meet, before = [], neighbors.BallIndex.meet, left_in(spark)

    def counted(index, tiles, hot, rest, bins):
        rows = {r["bin"]: r["count"] for r in tiles.groupBy("bin").count().collect()}
        assert rows.keys() <= set(bins)
        seen.append((rest, bins, 48 * sum(rows.values()) + 48 * sum(n * index.bin_rows[b] for b, n in hot.items())))
        return meet(index, tiles, hot, rest, bins)

    monkeypatch.setattr(neighbors.BallIndex, "meet", counted)
    assert have(neighbors.knn(table(spark, tr), table(spark, te, 1000), block_rows=8)) == want(tr, te)
    rest = [bins for r, bins, _ in seen if r]
    assert len(rest) > 1 and len({b for bins in rest for b in bins}) == sum(map(len, rest))  # each bin in one round
    assert all(moved <= 2 * (14_400 + 2_880) or len(bins) == 1 for _, bins, moved in seen), seen
    left = left_in(spark) - before
    assert len(left) == 1 and left.pop().startswith("neighbours"), left


def test_a_spent_train_stage_goes_with_the_index_built(spark):
    from textlab.operators.common import stage

    rng = np.random.default_rng(14)
    tr, te = rng.standard_normal((40, 4)), rng.standard_normal((9, 4))
    for sizes in ({}, {"block_rows": 8}):
        before = left_in(spark)
        train = stage(table(spark, tr), "knn_train")
        assert any(x.startswith("knn_train") for x in left_in(spark) - before)
        assert have(neighbors.knn(train, table(spark, te, 1000), spent=True, **sizes)) == want(tr, te)
        assert not any(x.startswith("knn_train") for x in left_in(spark) - before)
