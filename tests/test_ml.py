"""Invariants of the ML jobs (no SQL oracle for iterative fits)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.operators.split import hash_bucket, hash_split
from revlens.plans import features as FE
from revlens.plans import models as MO
from revlens.sources import fixtures as FX
from tests.conftest import SF_SMALL


def test_hash_split_ignores_partitioning(spark):
    rows = FX.ml_rows(spark, SF_SMALL)
    a, _ = hash_split(rows.repartition(1), "row_key", "s", 75)
    b, _ = hash_split(rows.repartition(7, "overall"), "row_key", "s", 75)
    ka = sorted(r.row_key for r in a.select("row_key").collect())
    kb = sorted(r.row_key for r in b.select("row_key").collect())
    assert ka == kb
    share = len(ka) / rows.count()
    assert 0.70 < share < 0.80


def test_hash_bucket_range(spark):
    b = spark.range(2000).select(hash_bucket(F.col("id"), "x").alias("b")).agg(
        F.min("b").alias("lo"), F.max("b").alias("hi")).first()
    assert b.lo >= 0 and b.hi <= 99


def test_tree_rmse_beats_constant_predictor(spark):
    train, test = MO.train_test(FX.ml_rows(spark, SF_SMALL), FX.FEATURE_COLUMNS)
    rmse = MO.tree_rmse(train, test).first().test_rmse
    std = test.agg(F.stddev_pop("overall")).first()[0]
    assert 0 < rmse <= std * 1.1


def test_depth_sweep_shape(spark):
    train, test = MO.train_test(FX.ml_rows(spark, SF_SMALL), FX.FEATURE_COLUMNS)
    rows = MO.tree_depth_sweep(train, test).collect()
    assert sorted(r.depth for r in rows) == [5, 7, 9, 12]
    assert sum(r.best for r in rows) == 1
    best = [r for r in rows if r.best][0]
    assert best.valid_rmse == min(r.valid_rmse for r in rows)


def test_word2vec_vocabulary_is_min_count_tokens(spark):
    titles = FX.product_titles(spark, SF_SMALL)
    model = FE.fit_word2vec(titles)
    vocab = {r.word for r in model.getVectors().select("word").collect()}
    counted = {r.word for r in FE.token_counts(titles).collect()}
    assert vocab == counted


def test_nearest_words_invariants(spark):
    titles = FX.product_titles(spark, SF_SMALL)
    model = FE.fit_word2vec(titles)
    words = ["the", "and", "not-a-word"]
    rows = FE.nearest_words(model.getVectors(), words).collect()
    by_q = {}
    for r in rows:
        by_q.setdefault(r.query, []).append(r)
    missing = by_q.pop("not-a-word")
    assert [(r.rank, r.word, r.similarity) for r in missing] == [(None, None, None)]
    assert set(by_q) == {"the", "and"}
    for q, rs in by_q.items():
        rs.sort(key=lambda r: r.rank)
        assert len(rs) == 10 and all(r.word != q for r in rs)
        sims = [r.similarity for r in rs]
        assert sims == sorted(sims, reverse=True) and sims[0] <= 1 + 1e-9
    # Same ranking as the model's own driver-side search.
    want = [w for w, _ in model.findSynonymsArray("the", 10)]
    assert [r.word for r in sorted(by_q["the"], key=lambda r: r.rank)] == want


def _onehot(frame):
    return np.array([r.categoryOneHot.toArray() for r in frame.select("categoryOneHot").collect()])


@pytest.mark.parametrize("counts", [[7, 7, 7, 5, 3, 3, 1], [4, 4, 4, 4], [9, 5, 2], [3] * 6 + [8, 1, 1, 1, 2]])
def test_onehot_components_are_the_covariance_eigenvectors(spark, counts):
    rows = [(f"{i}-{j}", f"c{i:02d}") for i, n in enumerate(counts) for j in range(n)]
    cats = spark.createDataFrame(rows, "asin string, category string").repartition(5)
    levels = FE.category_levels(cats)
    found = FE.category_components(levels, len(counts))
    frame = FE.category_features(cats, len(counts))
    x = _onehot(frame)
    cov = np.cov(x, rowvar=False, bias=True)
    table = {r["index"]: r.loadings for r in FE.category_loadings(levels, found).collect()}
    v = np.array([table[i] for i in range(len(counts))])
    assert np.allclose(v.T @ v, np.eye(len(counts)), atol=1e-9)
    values = np.array([c.explained for c in found]) * np.trace(cov)
    assert np.allclose(values, np.sort(np.linalg.eigvalsh(cov))[::-1], atol=1e-12)
    assert np.allclose(cov @ v, v * values, atol=1e-9)
    # Row vectors are projections; their mean is the reported mean.
    p = np.array([r.categoryPCA.toArray() for r in frame.select("categoryPCA").collect()])
    means = [r["mean"] for r in FE.category_pca_mean(cats, len(counts)).orderBy("position").collect()]
    assert np.allclose(p.mean(axis=0), means) and min(means) >= 0


def test_category_pca_agrees_with_mllib(spark):
    from pyspark.ml.feature import PCA
    cats = FX.product_categories(spark, SF_SMALL)
    frame = FE.category_features(cats)
    model = PCA(k=15, inputCol="categoryOneHot", outputCol="pca").fit(frame)
    found = FE.category_components(FE.category_levels(cats), 15)
    assert [c.explained for c in found] == pytest.approx(list(model.explainedVariance.toArray()), abs=1e-9)
    want = np.abs(_onehot(frame).mean(axis=0) @ model.pc.toArray())
    got = np.array([r["mean"] for r in FE.category_pca_mean(cats).orderBy("position").collect()])
    alone = [c.tied is None for c in found]
    assert np.allclose(got[alone], want[alone], atol=1e-9) and np.allclose(want[~np.array(alone)], 0, atol=1e-9)


def test_index_of_a_hot_category(spark):
    # A third of all rows in one category; without adaptive execution.
    rows = [(str(i), "hot" if i % 3 == 0 else f"c{i % 40}") for i in range(3000)]
    cats = spark.createDataFrame(rows, "asin string, category string")
    count = {}
    for _, c in rows:
        count[c] = count.get(c, 0) + 1
    order = sorted(count, key=lambda c: (-count[c], c))
    got = FE.category_index(cats).collect()
    assert len(got) == 3000 and all(order[int(r.categoryIndex)] == r.category for r in got)
    assert FE.category_index(cats.where("false")).count() == 0


def test_onehot_mean_is_level_share(spark):
    cats = FX.product_categories(spark, SF_SMALL)
    rows = FE.category_onehot_mean(cats).orderBy("position").collect()
    n = cats.count()
    counts = sorted((r.n for r in cats.groupBy("category").agg(F.count("*").alias("n")).collect()),
                    reverse=True)
    assert [r.mean for r in rows[:len(counts)]] == pytest.approx([c / n for c in counts])


def test_nearest_words_brute_force(spark):
    # Cosine against every vocabulary vector in numpy, self excluded.
    titles = FX.product_titles(spark, SF_SMALL)
    model = FE.fit_word2vec(titles)
    vecs = {r.word: r.vector.toArray() for r in model.getVectors().collect()}
    words = list(vecs)
    mat = np.array([vecs[w] for w in words])
    got = FE.nearest_words(model.getVectors(), ["the"]).orderBy("rank").collect()
    q = vecs["the"]
    sims = mat @ q / (np.linalg.norm(mat, axis=1) * np.linalg.norm(q))
    order = sorted((i for i, w in enumerate(words) if w != "the"), key=lambda i: (-sims[i], words[i]))[:10]
    assert [r.word for r in got] == [words[i] for i in order]
    assert [r.similarity for r in got] == pytest.approx([sims[i] for i in order], abs=1e-9)


def test_sweep_of_one_fit_equals_separate_fits(spark):
    train, test = MO.train_test(FX.ml_rows(spark, SF_SMALL), FX.FEATURE_COLUMNS)
    depths = (0, 1, 3, 5, 12)
    model = MO.fit_tree(train, 12)
    got = MO._score_all(model, MO.leaf_predictions(model, depths), depths, test, "t").first()
    for d in depths:
        assert got[f"t{d}"] == pytest.approx(MO.rmse(MO.fit_tree(train, d).transform(test)).first().rmse, rel=1e-12)


def test_tree_finds_a_planted_signal(spark):
    rows = spark.range(4000).select(
        F.col("id").cast("string").alias("row_key"), (F.col("id") % 8).cast("double").alias("x"),
        (F.col("id") % 3).cast("double").alias("noise"),
        F.when(F.col("id") % 8 > 3, 10.0).otherwise(-10.0).alias("overall"))
    train, test = MO.train_test(rows, ["x", "noise"])
    assert MO.tree_rmse(train, test).first().test_rmse < 1e-9


def test_incomplete_rows_fail_or_are_counted(spark):
    rows = spark.createDataFrame([("a", 1.0, 1.0), ("b", None, 2.0), ("c", float("nan"), 3.0)],
                                 "row_key string, x double, overall double")
    assert MO.incomplete_rows(rows, ["x"]).first().incomplete == 2
    with pytest.raises(Exception):
        MO.assemble(rows, ["x"]).collect()
    assert MO.assemble(rows, ["x"], "skip").count() == 1


def test_group_mean_rmse_brute_force(spark):
    train = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 10.0)], "g int, overall double")
    valid = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 7.0), (None, 1.0)], "g int, overall double")
    overall = 14 / 3
    want = np.sqrt(np.mean([(5 - 2) ** 2, 1, (7 - overall) ** 2, (1 - overall) ** 2]))
    assert MO.group_mean_rmse(train, valid, "g").first().rmse == pytest.approx(want)


def test_result_documents(spark):
    words = FE.word_document(FX.product_titles(spark, SF_SMALL), ["the", "not-a-word"])
    assert words.columns == ["count_total", "size_vocabulary", "word_0_synonyms", "word_1_synonyms"]
    row = words.first()
    assert len(row.word_0_synonyms) == 10 and row.word_1_synonyms is None
    cats = FX.product_categories(spark, SF_SMALL)
    row = FE.category_document(cats).first()
    assert row.count_total == cats.count() and len(row.meanVector_categoryPCA) == 15
    assert len(row.meanVector_categoryOneHot) == cats.select("category").distinct().count()
    assert sum(row.meanVector_categoryOneHot) == pytest.approx(1)
    sweep = spark.createDataFrame([(5, 2.0, 2.5, 0), (7, 1.0, 1.5, 1)],
                                  "depth int, valid_rmse double, test_rmse double, best int")
    assert MO.sweep_document(sweep, (5, 7)).first().asDict() == {
        "test_rmse": 2.5, "valid_rmse_depth_5": 2.0, "valid_rmse_depth_7": 1.0, "best_depth": 7, "best_depth_test_rmse": 1.5}


def test_missing_categories_fail_unless_kept(spark):
    cats = FX.gappy_categories(spark, SF_SMALL)
    with pytest.raises(Exception):
        FE.category_onehot_mean(cats).collect()
    assert FE.category_onehot_mean(cats, handle_invalid="keep").count() == 26


def test_nothing_stays_persisted(spark):
    import __spark_entry__ as E
    for key in ("tree_rmse", "word_synonyms"):
        E.QUERIES[key](spark, SF_SMALL).collect()
        assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty(), key


def test_spectral_vectors_against_numpy(spark):
    from revlens.plans import wordvectors as WV
    titles = FX.product_titles(spark, SF_SMALL)
    counts = WV.cooccurrence(titles)
    pmi = WV.positive_pmi(counts).toPandas()
    words = sorted(set(pmi["word"]))
    at = {w: i for i, w in enumerate(words)}
    dense = np.zeros((len(words), len(words)))
    dense[pmi["word"].map(at), pmi["context"].map(at)] = pmi["pmi"]
    assert np.allclose(dense, dense.T)
    values, basis = np.linalg.eigh(dense)
    size = 4
    lead = np.argsort(-np.abs(values))[:size]
    want = np.array([values[i] for i in sorted(lead, key=lambda i: -values[i])])
    rows = {r.word: r.v for r in WV.spectral_vectors(WV.positive_pmi(counts), size, 60).collect()}
    got = np.array([rows[w] for w in words])
    assert np.allclose((got ** 2).sum(axis=0), np.maximum(want, 0), rtol=1e-3, atol=1e-6)
    # The first vector is well apart from the others.
    top = basis[:, np.argmax(values)]
    assert abs(got[:, 0] @ top) / np.linalg.norm(got[:, 0]) > 0.9999


def test_spectral_vectors_do_not_depend_on_partitions(spark):
    from revlens.plans import wordvectors as WV
    rng = np.random.default_rng(0)
    topics = [[f"{t}{i}" for i in range(8)] for t in "abc"]
    rows = [(str(i), " ".join(rng.choice(topics[i % 3], 30))) for i in range(300)]
    frame = spark.createDataFrame(rows, "asin string, title string")
    found = []
    for parts, shuffles in ((2, "2"), (8, "8")):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        try:
            pmi = WV.positive_pmi(WV.cooccurrence(frame.repartition(parts), min_count=20))
            vectors = WV.spectral_vectors(pmi, 3)
            found.append({r.word: r.v for r in vectors.collect()})
            near = WV.nearest_by_cosine(vectors, ["a0", "b3", "nothing"], 7).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
        assert len(near) == 14 and all(r.word[0] == r.query[0] for r in near)
    assert found[0].keys() == found[1].keys() and len(found[0]) == 24
    assert all(np.allclose(found[0][w], found[1][w], atol=1e-8) for w in found[0])
    assert WV.spectral_vectors(WV.positive_pmi(WV.cooccurrence(frame.where("false")))).count() == 0


def _cooccurring(texts, window, min_count):
    from collections import Counter
    tokens = [[] if t is None else t.lower().split(" ") for t in texts]
    often = Counter(w for t in tokens for w in t)
    counts = Counter()
    for t in tokens:
        kept = [w for w in t if often[w] >= min_count]
        for i, a in enumerate(kept):
            for b in kept[i + 1: i + 1 + window]:
                counts[a, b] += 1
                counts[b, a] += 1
    return dict(counts)


@pytest.mark.parametrize("most, portion", [(64 << 20, 1 << 20), (64 << 20, 3), (0, 7)])
def test_cooccurrence_against_brute_force(spark, monkeypatch, most, portion):
    from revlens.plans import wordvectors as WV
    monkeypatch.setattr(WV, "MOST_BYTES", most)
    monkeypatch.setattr(WV, "PORTION", portion)
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["A", "a", "b", "c", "É", "", "rare%d" % i], rng.integers(0, 20))) for i in range(60)]
    texts += [None, "", " ", "b", None, "lonely"]
    frame = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "asin string, title string").repartition(5)
    got = {(r.word, r.context): r.n for r in WV.cooccurrence(frame, 3, 10).collect()}
    assert got == _cooccurring(texts, 3, 10) and len(got) > 10


def test_cooccurrence_shuffles_only_counted_pairs(spark):
    from revlens.plans import wordvectors as WV
    frame = spark.createDataFrame([(str(i), "a b c a") for i in range(40)], "asin string, title string")
    plan = WV.cooccurrence(frame, 5, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "collect_list" not in plan


def test_spectral_vectors_leave_one_table(spark):
    import os

    from revlens.plans import wordvectors as WV
    from revlens.sources.scratch import shared_dir
    frame = spark.createDataFrame([(str(i), "a b c d e"[: 1 + 2 * (i % 5)]) for i in range(60)], "asin string, title string")
    pmi = WV.positive_pmi(WV.cooccurrence(frame, 2, 10))
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    vectors = WV.spectral_vectors(pmi, 2, 3)
    left = {n.split("-")[0] for n in set(os.listdir(folder)) - before if "-" in n}
    assert len(set(os.listdir(folder)) - before) == 1 and left == {"vectors"}
    assert vectors.count() > 0
