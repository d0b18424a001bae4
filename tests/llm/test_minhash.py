"""Near-dedup against all pairs of a small fixture."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tomeflow.llm import minhash, shingles
from tomeflow.llm.minhash import drop_near_copies, near_components


def shingle_words(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, percent=85):
    sets = [(i, shingle_words(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    return sorted((i, len(s), find(i)) for i, s in sets)


def sample(seed=1, n=260):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["É", "Ünï", "X"]
    out = []
    for i in range(n):
        if out and rng.random() < 0.65:
            words = (rng.choice(out)[1] or "").split()
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(words) + 1)
                words[at : at + rng.randrange(2)] = [rng.choice(vocab)]
            if rng.random() < 0.3:
                words = [w.upper() for w in words]
        else:
            words = [rng.choice(vocab) for _ in range(rng.choice([0, 1, 3, 4, 5, 8, 12, 40, 90, 200]))]
        out.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
    return out + [(n, None), (n + 1, "")]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_all_pairs(spark, seed):
    rows = sample(seed)
    random.Random(0).shuffle(rows)
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, n int, comp string").repartition(4)
    got = near_components(docs).collect()
    assert sorted((r.id, r.n_shingles, r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.id == r.component_id) for r in got)


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(4)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(rng.randrange(1, 3)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.id, r.n_shingles, r.component_id) for r in near_components(docs).collect()) == brute(rows)


def test_repeated_and_null_identifiers(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b), (None, "z"), (4, "q")], "doc_id long, text string")
    got = {(r.id, r.component_id) for r in near_components(docs).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (None, None), (4, 4)}
    assert sorted(r.doc_id or 0 for r in drop_near_copies(docs).collect()) == [0, 1, 4]


def test_null_identifiers_in_buckets(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(None, " ".join(base)), (5, " ".join(base + ["x"])), (2**63 - 1, " ".join(["y"] + base)), (7, " ".join(base[:30]))]
    got = {(r.id, r.component_id) for r in near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(None, None), (5, None), (2**63 - 1, None), (7, 7)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_components(docs).count() == 0
    assert drop_near_copies(docs).count() == 0


def test_densified_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    for size in (3, 12, 60, 1000):
        hits = []
        for _ in range(60):
            u = rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2)
            part = u[: max(1, int(size * 0.7))]
            hits.append((minhash.sketch(np.unique(u)) == minhash.sketch(np.unique(part))).mean())
        assert abs(np.mean(hits) - max(1, int(size * 0.7)) / size) < 0.1


def test_short_texts_are_one_shingle():
    assert len(shingles.shingle_set("a b c")) == 1
    assert len(shingles.shingle_set("")) == len(shingles.shingle_set(None)) == 0
    assert list(shingles.shingle_set("A b")) == list(shingles.shingle_set("a\tB"))
    assert list(shingles.shingle_set("a b")) != list(shingles.shingle_set("a b"))


def edited(rng, words, edits):
    words = list(words)
    for kind in edits:
        at = rng.randrange(len(words))
        words[at : at + (kind != "in")] = [] if kind == "out" else [f"x{rng.randrange(10**6)}"]
    return words


@pytest.mark.parametrize("seed", [3, 4])
def test_links_between_copies_that_the_original_is_not_similar_to(spark, seed):
    """Families near the threshold: copies of distant copies, cut-off copies, longer and shorter ones."""
    rng = random.Random(seed)
    rows = []
    for family in range(3):
        base = [f"f{family}b{i}" for i in range(rng.choice([40, 90, 150]))]
        texts = [base] * 2
        for _ in range(60):
            start = rng.choice(texts)
            texts.append(edited(rng, start, [rng.choice(["in", "out", "swap"]) for _ in range(rng.randrange(1, max(2, len(base) // 30)))]))
        texts += [base[: len(base) * k // 20] for k in range(9, 20)] + [base[len(base) * k // 20 :] for k in range(1, 11)]
        texts += [base + [f"t{i}" for i in range(len(base) * k // 40)] for k in range(1, 14)]
        rows += texts
    rng.shuffle(rows)
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.id, r.n_shingles, r.component_id) for r in near_components(docs).collect()) == brute(rows)


@pytest.mark.parametrize("seed", [3, 4])
def test_prefixes_are_taken_once_and_list_elements_where_members_meet(spark, monkeypatch, seed):
    staged = []
    keep = minhash.Workspace.stage

    def stage(self, df, name, **options):
        staged.append((name, keep(self, df, name, **options)))
        return staged[-1][1]

    monkeypatch.setattr(minhash.Workspace, "stage", stage)
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(120)]
    texts = [base] * 2
    for _ in range(90):
        texts.append(edited(rng, rng.choice(texts), [rng.choice(["in", "out", "swap"]) for _ in range(rng.randrange(1, 5))]))
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    got = near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.id, r.n_shingles, r.component_id) for r in got) == brute(rows)
    names = [name for name, _ in staged]
    assert names.count("rest") == 2 and names.count("links") > 1 and names.count("prefixes") == 1
    tables = dict(staged)
    held = Counter((r.centre, e) for r in tables["placed"].collect() for e in r.apart)
    prefixes = tables["prefixes"].collect()
    assert prefixes and all(held[r.centre, r.token] > 1 for r in prefixes)


def test_a_very_long_text(spark):
    long = [f"w{i}" for i in range(300_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:290_000])), (3, " ".join(long[:200_000])), (4, "x" * 1_000_000), (5, "w1 w2")]
    got = near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.id, r.n_shingles, r.component_id) for r in got) == [(1, 299_996, 1), (2, 289_996, 1), (3, 199_996, 3), (4, 1, 4), (5, 1, 5)]


def test_the_query_has_the_columns_of_its_contract(spark, tmp_path):
    docs = spark.createDataFrame([(3, "a b c", "en"), (8, "A b\tc", "en"), (9, None, None)], "doc_id long, text string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = minhash.op4_minhash_dedup(spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    assert sorted(map(tuple, got.collect())) == [(3, 1, 3, True), (8, 1, 3, False), (9, 0, 9, True)]
