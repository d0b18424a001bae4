"""Pseudo-likelihood: against a plain loop, gradients, training, edge rows."""

import numpy as np
import pyarrow as pa
import pytest

from tomeflow.llm import lm
from tomeflow.llm.lm import TOKEN, Network, Words, contexts, op6_lm_score, score_documents, tokenised, train, vocabulary_of


def fit(docs, rounds=lm.ROUNDS):
    words = vocabulary_of(docs)
    return train(tokenised(docs, words), words, rounds), words


def scored(docs, net, words):
    return score_documents(tokenised(docs, words), net, words)


def plain_score(net, tokens):
    e, w1, b1, wc, bc, wp, bp = (p.astype(np.float64) for p in net.parts)
    total = 0.0
    for i, t in enumerate(tokens):
        around = [tokens[i + k] if 0 <= i + k < len(tokens) else lm.PAD for k in (-2, -1, 1, 2)]
        h = np.tanh(np.concatenate([e[a] for a in around]) @ w1 + b1)
        kind, place = divmod(int(t), lm.PLACES)
        for z, k in ((h @ wc + bc, kind), (h @ wp[kind] + bp[kind], place)):
            total += z[k] - np.log(np.exp(z - z.max()).sum()) - z.max()
    return total


def test_scores_are_those_of_a_plain_loop(monkeypatch):
    rng = np.random.default_rng(0)
    net = Network(rng.normal(0, 0.3, Network.SIZE))
    docs = [rng.integers(0, lm.VOCABULARY, n).astype(TOKEN) for n in (0, 1, 2, 7, 40, 5)]
    want = [plain_score(net, d) for d in docs]
    assert np.allclose(net.scores(docs), want, rtol=1e-4)
    monkeypatch.setattr(lm, "BLOCK", 6)
    assert np.allclose(net.scores(docs), want, rtol=1e-4)


def test_probabilities_sum_to_one():
    net = Network(np.random.default_rng(1).normal(0, 0.3, Network.SIZE))
    context = np.tile(np.array([[3, lm.PAD, 700, 9]]), (lm.VOCABULARY, 1))
    assert np.exp(net.log_probabilities(context, np.arange(lm.VOCABULARY)).astype(np.float64)).sum() == pytest.approx(1, abs=1e-3)


def test_gradient():
    rng = np.random.default_rng(3)
    net = Network(rng.normal(0, 0.2, Network.SIZE))
    context, target = rng.integers(0, lm.VOCABULARY + 1, (9, 4)), rng.integers(0, lm.VOCABULARY, 9)
    g = net.gradient(context, target)
    for i in np.argsort(-np.abs(g))[:60]:
        up, down = net.flat.copy(), net.flat.copy()
        up[i] += 1e-2
        down[i] -= 1e-2
        slope = (Network(up).log_probabilities(context, target).mean(dtype=float) - Network(down).log_probabilities(context, target).mean(dtype=float)) / 2e-2
        assert g[i] == pytest.approx(slope, rel=0.05, abs=1e-3)


def test_contexts_look_to_both_sides():
    assert contexts(np.array([5, 6, 7])).tolist() == [[lm.PAD, lm.PAD, 6, 7], [lm.PAD, 5, 7, lm.PAD], [5, 6, lm.PAD, lm.PAD]]


def test_training_tells_order_from_noise(spark):
    rng = np.random.default_rng(5)
    cycle = [f"w{i}" for i in range(40)]
    ordered = [" ".join(cycle[(s + k) % 40] for k in range(200)) for s in rng.integers(0, 40, 150)]
    rows = [(i, t, 0) for i, t in enumerate(ordered)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(2)
    net, frequent = fit(docs, rounds=6)
    shuffled = [" ".join(rng.permutation(t.split())) for t in ordered[:20]]
    both = spark.createDataFrame([(i, t) for i, t in enumerate(ordered[:20])] + [(100 + i, t) for i, t in enumerate(shuffled)], "doc_id long, text string")
    score = {r.id: r.log_likelihood for r in scored(both, net, frequent).collect()}
    assert sum(score[i] > score[100 + i] for i in range(20)) >= 18


def test_edge_rows(spark):
    rows = [(1, None), (1, ""), (None, "a b"), (2, "a"), (3, "word " * 40000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    net, frequent = fit(docs)
    got = sorted(scored(docs, net, frequent).collect(), key=lambda r: (r.n_tokens, r.id is None))
    assert [(r.id, r.n_tokens) for r in got] == [(1, 0), (1, 0), (2, 1), (None, 2), (3, 40000)]
    assert got[0].log_likelihood == 0 and got[0].perplexity == 1 and all(np.isfinite(r.log_likelihood) for r in got)
    empty = docs.limit(0)
    net, frequent = fit(empty)
    assert frequent == [] and scored(empty, net, frequent).count() == 0


def test_unknown_words_keep_their_class_when_the_table_is_emptied(monkeypatch):
    monkeypatch.setattr(lm, "WORD_TABLE", 3)
    words = Words(["the", "of"])
    first = words.tokens("the of zebra yak ant bee").tolist()
    assert words.tokens("the of zebra yak ant bee").tolist() == first and first[:2] == [0, 1] and min(first[2:]) >= lm.FREQUENT


def test_rare_words_keep_their_own_counts(spark):
    rng = np.random.default_rng(2)
    known = [f"v{i}" for i in range(3000)]
    rows = [(i, " ".join(["the", "of"] * 40 + [known[j] for j in rng.integers(0, 3000, 120) ** 2 // 3000])) for i in range(60)]
    net, words = fit(spark.createDataFrame(rows, "doc_id long, text string"))
    counts = {}
    for _, text in rows:
        for w in text.split():
            counts[w] = counts.get(w, 0) + 1
    others = [w for w in counts if w not in words]
    assert len(words) == lm.FREQUENT and {counts[w] for w in others} >= {1, 2}
    texts = ["the " + w for w in others] + ["the zzz"]
    got = {r.id: r.log_likelihood for r in scored(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"), net, words).collect()}
    table, classes = Words(list(words)), lm.VOCABULARY - lm.FREQUENT
    totals = np.zeros(lm.VOCABULARY)
    for w in others:
        totals[table[w.encode()]] += counts[w]
    for i, text in enumerate(texts):
        tokens = table.tokens(text)
        share = counts.get(text[4:], 1 / (len(others) / classes + 1)) / (totals[tokens[1]] + 1)
        assert got[i] == pytest.approx(net.scores([tokens])[0] + np.log(share), rel=1e-6)


def test_counts_of_common_words_are_held_in_the_tasks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"v{j}" for j in rng.integers(0, 3000, 300) ** 2 // 3000)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    net, scores, joined = None, [], []
    for common in (0, 1800, lm.COMMON):
        monkeypatch.setattr(lm, "COMMON", common)
        words = vocabulary_of(docs)
        assert len(words.common[0]) <= common
        net = net or train(tokenised(docs, words), words)
        joined.append(sum(len(r.words) for r in tokenised(docs, words).collect()))
        scores.append([r.log_likelihood for r in scored(docs, net, words).orderBy("id").collect()])
    assert joined[0] > joined[1] > joined[2] == 0
    assert np.allclose(scores[0], scores[1], rtol=1e-9) and np.allclose(scores[0], scores[2], rtol=1e-9)


def test_every_token_is_a_target_once():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 16, 333):
        tokens = rng.integers(0, lm.VOCABULARY, n)
        for rounds in (1, lm.ROUNDS, 6):
            places = np.concatenate([lm.hidden_places(tokens, turn, rounds) for turn in range(rounds)])
            assert sorted(places.tolist()) == list(range(n))


def test_repeated_rows_score_alike_in_the_query(spark, tmp_path):
    text = " ".join(f"w{i % 7}" for i in range(50))
    docs = spark.createDataFrame([(1, text, 5), (1, text, 5), (2, text, 5), (3, "w1 w2", 5)], "doc_id long, text string, part int").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = op6_lm_score(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "log_likelihood", "perplexity"]
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == [1, 1, 2, 3]
    assert len({round(r.log_likelihood, 9) for r in rows if r.doc_id != 3}) == 1


def test_sums_are_added_in_a_tree(spark):
    part = np.ones(Network.SIZE + 1)
    parts = spark.range(0, 300, 1, 300).mapInArrow(lambda it: (pa.RecordBatch.from_pydict({"part": pa.array([part.tobytes()] * b.num_rows, pa.binary())}) for b in it), "part binary")
    added = lm._summed(parts)
    assert added.rdd.getNumPartitions() <= lm.SUMMED
    assert sum(np.frombuffer(r.part)[0] for r in added.collect()) == 300
