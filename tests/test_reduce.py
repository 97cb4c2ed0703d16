import numpy as np

from textlab.operators import reduce


def test_choose_k_rules():
    assert reduce.choose_k(list(np.cumsum([0.5, 0.3, 0.2])), 3) == 3
    assert reduce.choose_k(list(np.cumsum([0.4, 0.3])), 2) == 2


def test_sweep_grid_like_linspace():
    assert reduce.sweep_grid(300)[:4] == [10, 25, 40, 55] and reduce.sweep_grid(300)[-1] == 300


def test_truncated_svd_matches_numpy(spark):
    rng = np.random.default_rng(0)
    n, d = 120, 40
    A = np.zeros((n, d))
    rows = []
    for i in range(n):
        idx = np.sort(rng.choice(d, rng.integers(0, 8), replace=False))
        val = rng.random(len(idx)) * (1 + (idx < 5) * 4)
        A[i, idx] = val
        rows.append((i, [int(x) for x in idx], [float(x) for x in val]))
    df = spark.createDataFrame(rows, "doc_id long, indices array<int>, values array<double>")
    out = reduce.truncated_svd(df, d, 5, n, (A.sum(0), (A * A).sum(0)))
    S = np.linalg.svd(A, compute_uv=False)
    assert np.allclose(out["singular_values"], S[:5], rtol=1e-8)
    proj = np.array([r["features"] for r in reduce.project_sparse(df, out["components"], ["doc_id"])
                     .orderBy("doc_id").collect()])
    ratios = proj.var(0) / A.var(0).sum()
    assert np.allclose(out["ratios"], ratios, atol=1e-10)


def test_pca_centred_and_train_only(spark):
    rng = np.random.default_rng(1)
    X = rng.standard_normal((80, 6)) @ np.diag([5, 3, 2, 1, 0.5, 0.1]) + 7.0
    train = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(X)], "doc_id long, features array<double>")
    other = spark.createDataFrame([(999, [100.0] * 6)], "doc_id long, features array<double>")
    p_train, (p_other,), ratios = reduce.pca_fit_project(train, [other], 3, "features")
    P = np.array([r["features"] for r in p_train.orderBy("doc_id").collect()])
    assert np.allclose(P.mean(0), 0, atol=1e-9)
    Xc = X - X.mean(0)
    _, s, vt = np.linalg.svd(Xc, full_matrices=False)
    assert np.allclose(np.abs(P), np.abs(Xc @ vt[:3].T), atol=1e-8)
    assert np.allclose(ratios, (s ** 2 / (s ** 2).sum())[:3], atol=1e-10)


def test_partial_sums_over_many_partitions(spark):
    from textlab.operators.linalg import sum_partials

    df = spark.range(4000).repartition(200)
    got = sum_partials(df, lambda bs: sum(np.bincount(b["id"].to_numpy() % 20_000, minlength=20_000) for b in bs if len(b)), 20_000, ["id"])
    assert got[:4000].tolist() == [1.0] * 4000 and got[4000:].sum() == 0
    assert sum_partials(df.limit(0), lambda bs: None, 7, ["id"]).tolist() == [0.0] * 7


def test_svd_accuracy_at_300_components(spark):
    """The leading values are exact; the tail of a flat spectrum is known to a few percent (randomised solver)."""
    rng = np.random.default_rng(4)
    n, d, k = 500, 1500, 300
    rows, A = [], np.zeros((n, d))
    for i in range(n):
        idx = np.sort(rng.choice(d, 60, replace=False, p=(w := 1 / np.arange(1, d + 1)) / w.sum()))
        A[i, idx] = rng.integers(1, 5, 60)
        rows.append((i, idx.tolist(), A[i, idx].tolist()))
    df = spark.createDataFrame(rows, "doc_id long, indices array<int>, values array<double>")
    got = reduce.truncated_svd(df, d, k, n)["singular_values"]
    err = np.abs(got / np.linalg.svd(A, compute_uv=False)[:k] - 1)
    assert err[50] < 1e-3 and err[200] < 2e-2 and err.max() < 6e-2, (err[50], err[200], err.max())


def test_svd_residuals_bound_every_component(spark):
    """The returned residual is that of the eigenvector itself, converged or not; a deficient matrix is completed."""
    rng = np.random.default_rng(9)
    n, d, k = 300, 400, 60
    A = np.where(rng.random((n, d)) < 0.05, rng.integers(1, 6, (n, d)), 0).astype(float)
    rows = [(i, np.flatnonzero(r).tolist(), r[r > 0].tolist()) for i, r in enumerate(A)]
    df = spark.createDataFrame(rows, "doc_id long, indices array<int>, values array<double>")
    G = A.T @ A
    for passes in (2, 4, 20):
        out = reduce.truncated_svd(df, d, k, n, passes=passes)
        V, lam = out["components"], out["singular_values"] ** 2
        assert np.allclose(V.T @ V, np.eye(k), atol=1e-10)
        assert np.allclose(np.linalg.norm(G @ V - V * lam, axis=0) / lam[0], out["residuals"], atol=1e-9)
    assert out["residuals"].max() <= reduce.SVD_TOLERANCE and out["passes"] < 20
    few = spark.createDataFrame(rows[:5], "doc_id long, indices array<int>, values array<double>")
    out = reduce.truncated_svd(few, d, 12, n)
    want = np.linalg.svd(A[:5], compute_uv=False)
    assert np.allclose(out["singular_values"], [*want, *[0.0] * 7], atol=1e-6) and out["components"].shape == (d, 12)
    assert np.allclose(out["components"].T @ out["components"], np.eye(12), atol=1e-10)
    parts = reduce.split_norms(df, V, ["doc_id"]).orderBy("doc_id").collect()
    assert np.allclose([r["explained"] for r in parts], ((A @ V) ** 2).sum(1)) and np.allclose(
        [r["rest"] for r in parts], ((A - A @ V @ V.T) ** 2).sum(1))


def test_untouched_blocks_are_not_emitted(spark):
    from textlab.operators.linalg import sum_partials

    df = spark.range(8).repartition(8)
    size = 1 << 16

    def fold(batches):
        out = np.zeros(size)
        for b in batches:
            out[b["id"].to_numpy() * 5000] += 1
        return out

    got = sum_partials(df, fold, size, ["id"])
    assert np.flatnonzero(got).tolist() == [i * 5000 for i in range(8)] and got.sum() == 8


def test_qr_tree_keeps_small_components(spark):
    """Variances of 1e-14 of the largest survive the tree, and its depth changes nothing."""
    rng = np.random.default_rng(4)
    X = rng.standard_normal((500, 5)) @ np.diag([1e3, 10.0, 1.0, 1e-2, 1e-4])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "doc_id long, features array<double>")
    want = np.linalg.svd(X - X.mean(0), compute_uv=False) ** 2 / 499
    for parts in (1, 4, 40):  # 40 partitions take two levels
        model = reduce.pca_fit(df.repartition(parts))
        assert np.allclose(model["variances"], want, rtol=1e-6) and model["components"].shape == (5, 5)
    few = reduce.pca_fit(df.limit(3))
    assert few["variances"].shape == (3,) and few["variances"][2] < 1e-6
