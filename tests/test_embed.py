import os
import tempfile

from pyspark.sql import functions as F

from textlab.operators import embed
from textlab.sources import files


def test_mean_counts_repeats_and_zero_fill(spark):
    wv = spark.createDataFrame([("w", [1.0, 0.0]), ("v", [0.0, 3.0])], "word string, vec array<float>")
    docs = spark.createDataFrame([(1, ["w", "w", "v"]), (2, ["zz"]), (3, [])], "doc_id long, tokens array<string>")
    got = {r["doc_id"]: r["vec"] for r in embed.mean_word_vectors(docs, wv).collect()}
    assert got[1] == [2 / 3, 1.0] and got[2] == [0.0, 0.0] and got[3] == [0.0, 0.0]


def test_word_vector_file_later_line_wins(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "part-0.txt"), "w") as f:
        f.write("cat 1 2\ndog 3 4\n\ncat 5 6\n")
    got = {r["word"]: r["vec"] for r in files.read_word_vectors(spark, d).collect()}
    assert got == {"cat": [5.0, 6.0], "dog": [3.0, 4.0]}


def test_pooling_first_and_masked_mean(spark):
    wv = spark.createDataFrame([("a", [2.0, 2.0])], "word string, vec array<float>")
    docs = spark.createDataFrame([(1, ["a", "b"])], "doc_id long, tokens array<string>")
    states, masks = embed.window_token_states(docs, wv)
    p = embed.pool_token_states(states, masks, 2).first()
    # the leading special token takes the first content token's state: (2,2) twice over 4 real slots
    assert p["first"] == [2.0, 2.0] and p["mean"] == [1.0, 1.0]


def test_stream_term_counts_match_batch(spark):
    import tempfile

    from textlab.operators import vectorize
    from textlab.streaming import documents as st

    from conftest import SF_SMALL

    root = tempfile.mkdtemp(prefix="stream-")
    cleaned = st.clean_stream(st.document_stream(spark, f"{SF_SMALL}/documents*.parquet"))
    batch = st.clean_stream(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    vocab = vectorize.fit_vocabulary(batch, n=1)
    st.run_term_counts(cleaned, vocab, f"{root}/out", f"{root}/ckpt")
    got = {(r["doc_id"], r["term_id"], r["count"]) for r in spark.read.parquet(f"{root}/out").collect()}
    want = {(r["doc_id"], r["term_id"], r["count"]) for r in vectorize.bag_of_words(batch, vocab).collect()}
    assert got == want


def test_rank_terms_global_path_matches_topk(spark):
    """The distributed global rank gives the same word -> vector mapping as the bounded top-k."""
    from textlab.operators import embed
    from textlab.plans.corpus import cleaned_corpus
    from textlab.sources.tables import read_table

    sf = "/root/testdata/sf0.001"
    docs = cleaned_corpus(spark, sf).repartition(3)
    vecs = read_table(spark, sf, "embeddings")
    small = {r["word"]: list(r["vec"]) for r in embed.rank_terms_to_vectors(docs, vecs).collect()}
    big = {r["word"]: list(r["vec"]) for r in embed.rank_terms_to_vectors(docs, vecs, topk_limit=0).collect()}
    assert small and small == big


def test_pool_window_equals_states_then_pool(spark):
    wv = spark.createDataFrame([("a", [2.0, 2.0]), ("c", [1.0, -1.0])], "word string, vec array<float>")
    docs = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, ["zz"]), (4, ["c"] * 200 + ["a"])],
                                 "doc_id long, tokens array<string>")
    states, masks = embed.window_token_states(docs, wv)
    want = {r["doc_id"]: (r["first"], r["mean"]) for r in embed.pool_token_states(states, masks, 2).collect()}
    got = {r["doc_id"]: (r["first"], r["mean"]) for r in embed.pool_window(docs, wv, 2).collect()}
    assert got == want and len(got) == 4


def test_plan_shapes_pooling_and_mean(spark):
    """With a broadcast word table nothing is shuffled; window pooling by a join shuffles once, by document."""
    wv = spark.createDataFrame([("a", [2.0, 2.0]), ("c", [1.0, -1.0])], "word string, vec array<float>")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", F.split("text", " ").alias("tokens"))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    for df in (embed.mean_word_vectors(docs, wv), embed.pool_window(docs, wv, 2)):
        assert "Exchange" not in plan(df)
    p = plan(embed.pool_window(docs, wv, 2, limit=0))
    assert p.count("Exchange hashpartitioning(doc_id") == 1


def _random_corpus(spark, n_docs=300, n_words=400, seed=3):
    import numpy as np

    rng = np.random.default_rng(seed)
    vecs = rng.standard_normal((n_words, 7)).astype("float32")
    docs = [[f"w{x}" for x in rng.zipf(1.3, rng.integers(0, 90)) % (n_words + 50)] for _ in range(n_docs)]
    docs[5], docs[6] = None, ["unknown"] * 4
    wv = spark.createDataFrame([(f"w{i}", [float(x) for x in v]) for i, v in enumerate(vecs)], "word string, vec array<float>")
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, tokens array<string>").repartition(3)
    want = [np.mean([vecs[int(w[1:])] for w in d or [] if w[1:].isdigit() and int(w[1:]) < n_words] or [np.zeros(7)], axis=0, dtype=float) for d in docs]
    return df, wv, want


def test_means_are_the_same_broadcast_or_in_blocks(spark, monkeypatch):
    import numpy as np

    docs, wv, want = _random_corpus(spark)
    got = {r["doc_id"]: r["vec"] for r in embed.mean_word_vectors(docs, wv).collect()}
    assert len(got) == 300 and all(np.allclose(got[i], w, atol=1e-9) for i, w in enumerate(want))
    for block_bytes, run_rows in ((1 << 20, 1 << 15), (2000, 1 << 15), (2000, 7)):  # one block, many blocks, many short runs
        monkeypatch.setattr(embed, "BLOCK_BYTES", block_bytes)
        monkeypatch.setattr(embed, "RUN_ROWS", run_rows)
        rows = embed.mean_word_vectors(docs, wv, limit=0).collect()
        assert len(rows) == 300 and all(np.allclose(r["vec"], want[r["doc_id"]], atol=1e-9) for r in rows)


def test_blocks_move_runs_and_partial_sums_not_occurrences(spark):
    docs, wv, _ = _random_corpus(spark)
    plan = embed.mean_word_vectors(docs, wv, limit=0)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(key" in line]
    assert len(moved) == 1 and plan.count("MapInArrow") == 2


def test_encoder_gathers_by_id(spark):
    import numpy as np

    docs, wv, _ = _random_corpus(spark)
    docs = docs.unionByName(spark.createDataFrame([(900, ["w1"] * 500), (901, [])], docs.schema))
    table = embed.broadcast_words(wv)
    got = {r["doc_id"]: (r["first"], r["mean"]) for r in embed.encode_documents(docs, lambda: embed.WordVectorEncoder(table)).collect()}
    empty = spark.createDataFrame([], docs.schema)
    for limit in (None, 0):
        for r in embed.pool_window(docs.fillna({}).withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>"))), wv, 7, limit=limit).collect():
            first, mean = got[r["doc_id"]]
            assert np.allclose(first, r["first"]) and np.allclose(mean, r["mean"])
        assert embed.pool_window(empty, wv, 7, limit=limit).count() == 0
    assert embed.broadcast_words(wv, limit=10) is None


def test_first_token_features_vary(spark):
    from textlab.plans import catalog
    from conftest import SF_SMALL

    values = {r["value"] for r in catalog.first_token_pool(spark, SF_SMALL).where("dim = 0").collect()}
    assert len(values) > 10


def test_shares_of_a_block_grow_with_the_documents(spark, monkeypatch):
    """No task meets all the documents' words of a block: the exchange deals them to shares."""
    docs, wv, want = _random_corpus(spark)
    monkeypatch.setattr(embed, "RUN_ROWS", 500)
    seen = []
    frame = type(docs)
    repartition = frame.repartition

    def noted(self, n, *cols):
        out = repartition(self, n, *cols)
        if cols == ("key",):
            seen.append([r["count"] for r in out.groupBy("key").count().collect()])
        return out

    monkeypatch.setattr(frame, "repartition", noted)
    rows = embed.mean_word_vectors(docs, wv, limit=0).collect()
    assert len(seen) == 1 and len(seen[0]) > 10 and max(seen[0]) < 1500, seen
    assert all(abs(x - y) < 1e-9 for r in rows for x, y in zip(r["vec"], want[r["doc_id"]]))


def test_long_batches_are_cut_by_tokens(spark, monkeypatch):
    from textlab.operators import vectorize

    docs, wv, want = _random_corpus(spark)
    cut = [z - a for a, z in vectorize._token_slices(embed.pa.array([["a"] * 5, None, ["b"] * (vectorize.SLICE_TOKENS + 1), [], ["c"]]))]
    assert cut == [2, 1, 2]
    monkeypatch.setattr(vectorize, "SLICE_TOKENS", 20)
    got = {r["doc_id"]: r["vec"] for r in embed.mean_word_vectors(docs, wv).collect()}
    assert len(got) == 300 and all(abs(x - y) < 1e-9 for i, v in got.items() for x, y in zip(v, want[i]))


def test_rounds_of_documents_give_the_same_means(spark, monkeypatch):
    docs = spark.createDataFrame([(i % 9 or None, [f"w{(i * j) % 13}" for j in range(i % 7)]) for i in range(40)], "doc_id long, tokens array<string>")
    words = spark.createDataFrame([(f"w{i}", [float(i), 1.0 / (i + 1), -1.0]) for i in range(10)], "word string, vec array<float>")
    at_once = embed.mean_word_vectors(docs, words, limit=0)
    rounds, one = [], embed._mean_of_round
    monkeypatch.setattr(embed, "ROUND_TOKENS", 30)
    monkeypatch.setattr(embed, "_mean_of_round", lambda some, *a: rounds.append(some.count()) or one(some, *a))
    rows = lambda df: sorted((r["doc_id"] or -1, [round(x, 12) for x in r["vec"]]) for r in df.collect())
    assert rows(embed.mean_word_vectors(docs, words, limit=0)) == rows(at_once)
    assert len(rounds) > 2 and sum(rounds) == 40
