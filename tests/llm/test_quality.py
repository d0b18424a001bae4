"""Quality classifier: held-out accuracy, isotonic fit, edge rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from tomeflow.llm import quality
from tomeflow.llm.quality import document_statistics, keep_good, pool_adjacent_violators, score_statistics, statistics, train


def corpus(n=600, seed=3):
    rng = random.Random(seed)
    words = ["the", "of", "river", "stone", "walked", "ñandú", "über", "garden", "letter", "seven"]
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        body = [rng.choice(words) for _ in range(rng.randrange(5, 120))]
        if good:
            text = " ".join(body).capitalize() + "."
        else:
            text = rng.choice([" ".join(w.upper() + "!!" for w in body), " ".join(w + rng.choice(["$$$", "***", "&&&"]) for w in body), " | ".join(body)])
        docs.append((i, text, "x", 0.5))
        labels.append((i, int(good)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string, id string, score double")
    y = spark.createDataFrame(labels, "doc_id long, quality int")
    stats = document_statistics(d).cache()
    scored = {r.id: r.score for r in score_statistics(stats, train(stats, y)).collect()}
    unseen = {r.doc_id for r in d.where(quality.held_out(F.col("doc_id"))).collect()}
    assert 0.2 < len(unseen) / len(docs) < 0.45
    right = [(scored[i] >= 0.5) == bool(q) for i, q in labels if i in unseen]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= s <= 1 for s in scored.values())
    kept = {r.doc_id for r in keep_good(d, y).collect()}
    assert keep_good(d, y).columns == d.columns
    assert kept == {i for i, s in scored.items() if s >= 0.5}


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = corpus(200)
    d = spark.createDataFrame(docs, "doc_id long, text string, id string, score double")
    stats = document_statistics(d).cache()
    y = spark.createDataFrame(labels, "doc_id long, quality int")
    flipped = y.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r.id, round(r.score, 9)) for r in score_statistics(stats, train(stats, labels_)).collect()) for labels_ in (y, flipped))
    assert a == b


def test_no_labels_one_class_and_edge_rows(spark):
    rows = [(1, None, "a", 0.0), (1, "", "a", 0.0), (None, "x " * 50000, "b", 0.0), (2, "\n\n \t", "c", 0.0), (3, "🎉" * 3, "c", 0.0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, id string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    stats = document_statistics(d)
    assert [r.score for r in score_statistics(stats, train(stats, none)).collect()] == [0.5] * 5
    one = spark.createDataFrame([(1, 1), (3, 1), (3, None)], "doc_id long, quality int")
    assert {r.score for r in score_statistics(stats, train(stats, one)).collect()} == {1.0}
    assert score_statistics(document_statistics(d.limit(0)), train(stats, one)).count() == 0
    assert all(np.isfinite(statistics(t)).all() for _, t, *_ in rows)


def test_pool_adjacent_violators_is_the_least_squares_fit():
    rng = np.random.default_rng(0)
    for _ in range(50):
        n = int(rng.integers(1, 9))
        y, w = rng.random(n).round(1), rng.integers(1, 5, n).astype(float)
        fit = pool_adjacent_violators(y, w)
        assert (np.diff(fit) >= -1e-12).all()
        # min-max formula of isotonic regression
        mean = lambda a, b: (y[a : b + 1] * w[a : b + 1]).sum() / w[a : b + 1].sum()
        assert np.allclose(fit, [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)])


def test_fourier_features_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(1)
    f = quality.Features(np.zeros(len(quality.STATISTICS)), np.ones(len(quality.STATISTICS)))
    x = rng.normal(size=(40, len(quality.STATISTICS)))
    z = f(x)[:, : quality.FOURIER]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * quality.BANDWIDTH**2))
    assert np.abs(z @ z.T - exact).max() < 0.25


def test_weights_are_those_of_one_fit_over_the_whole_table(spark):
    docs, labels = corpus(150)
    d = spark.createDataFrame(docs, "doc_id long, text string, id string, score double")
    y = spark.createDataFrame(labels, "doc_id long, quality int")
    for partitions in (1, 7, 300):  # the last one makes a tree of two levels
        got = train(document_statistics(d.repartition(partitions)), y)
        label = dict(labels)
        seen = [r for r in document_statistics(d.where(~quality.held_out(F.col("doc_id")))).collect()]
        x = np.array([r.x for r in seen], np.float64)
        mean, scale = x.mean(axis=0), np.sqrt(np.maximum(x.var(axis=0), 1e-6))
        assert np.allclose(got.features.mean, mean) and np.allclose(got.features.scale, scale)
        z = quality.Features(mean, scale)(x)
        ridge = quality.RIDGE * np.eye(z.shape[1])
        ridge[-1, -1] = 1e-6
        want = np.linalg.solve(z.T @ z + ridge, z.T @ np.array([label[r.id] for r in seen], float))
        assert np.allclose(z @ got.weights, z @ want, atol=1e-6)


def test_sums_of_many_partitions(spark):
    df = spark.range(1000).select(F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")).alias("x")).repartition(290)
    assert quality._summed(df, lambda batch: quality._matrix(batch.column(0)).sum(axis=0), 2).tolist() == [499500.0, 1000.0]
