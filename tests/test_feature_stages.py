from textlab.plans import features


def test_a_feature_set_leaves_nothing_large_in_memory(spark, tmp_path):
    spark.catalog.clearCache()
    stored = spark.sparkContext._jsc.sc().getRDDStorageInfo
    for name in ("BOW_SVD", "MEAN_PCA"):
        features.feature_set(spark, "/root/testdata/sf0.001", name)
        # lookups with a row a class may stay
        assert sum(i.memSize() + i.diskSize() for i in stored()) < 20_000, name
        spark.catalog.clearCache()


def test_the_split_corpus_is_written_once(spark, tmp_path, monkeypatch):
    from textlab.plans import corpus, features

    written = []
    monkeypatch.setattr(corpus, "stage", lambda df, name="stage": written.append(name) or df)
    monkeypatch.setattr(features, "stage_path", lambda spark, sf_dir, name: str(tmp_path / name))
    assert corpus.reused_split_corpus(spark, "/root/testdata/sf0.001").count() == 200
    assert not written  # the stage that is reused is the only copy


def test_a_fit_holds_one_copy_of_its_rows_in_memory(spark):
    from textlab.operators import models

    seen = []

    class Estimator:
        def fit(self, train):
            seen.append(train.storageLevel)

    models.fit_timed(Estimator(), spark.range(10))
    assert seen[0].useDisk and not seen[0].useMemory


def folders(spark):
    from pathlib import Path

    from textlab.session import checkpoint_root

    return {p.name for p in (Path(checkpoint_root(spark).removeprefix("file:")) / "textlab").glob("*")}


def test_feature_sets_share_the_word_vectors_and_leave_their_own_stages_only(spark, tmp_path, monkeypatch):
    from textlab.operators import embed

    ranked, rank = [], embed.rank_terms_to_vectors
    monkeypatch.setattr(embed, "rank_terms_to_vectors", lambda *a, **b: ranked.append(1) or rank(*a, **b))
    monkeypatch.setattr(features, "stage_path", lambda spark, sf_dir, name: str(tmp_path / name))
    before = folders(spark)
    got = features.feature_sets(spark, "/root/testdata/sf0.001", ("BOW_SVD", "MEAN_PCA", "WORDVEC_PCA"))
    assert list(got) == ["BOW_SVD", "MEAN_PCA", "WORDVEC_PCA"] and all(df.count() == 200 for df in got.values())
    assert len(ranked) == 1
    assert not {n for n in folders(spark) - before if n.startswith(("packed", "vectors", "vocabulary"))}


def test_a_join_with_a_lookup_is_not_taken_for_a_larger_corpus(spark, tmp_path):
    from textlab.operators import vectorize

    spark.range(1000).selectExpr("id", "array(cast(id as string)) tokens", "id % 4 label").write.parquet(str(tmp_path / "docs"))
    spark.range(4).selectExpr("id label", "id y").write.parquet(str(tmp_path / "classes"))
    docs, classes = (spark.read.parquet(str(tmp_path / n)) for n in ("docs", "classes"))
    alone = vectorize._plan_bytes(docs)
    assert alone < vectorize._plan_bytes(docs.join(classes, "label")) < 2 * alone
