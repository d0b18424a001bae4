"""The corpus pipeline against plain Python, stage by stage."""

import hashlib
import random
import re

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from tomeflow.llm.bpe import read_ranks


def corpus(seed=8):
    rng = random.Random(seed)
    words = ["the", "of", "river", "stone", "walked", "garden", "letter", "seven", "ñandú", "über", "old", "quiet", "lamp", "north"]
    sentence = lambda n: " ".join(rng.choice(words) + str(rng.randrange(60)) for _ in range(n)) + "."
    items = [(i, "Which " + sentence(20)) for i in range(5)]
    docs, good = [], {}
    for i in range(260):
        kind = rng.random()
        if docs and kind < 0.15:
            text = rng.choice(docs)[1].upper() if rng.random() < 0.3 else rng.choice(docs)[1]
        elif docs and kind < 0.3:
            w = rng.choice(docs)[1].split()
            w[rng.randrange(len(w))] = "changed"
            text = " ".join(w)
        elif kind < 0.4:
            text = " | ".join(rng.choice(words) for _ in range(60))
        elif kind < 0.47:
            text = sentence(40) + " " + rng.choice(items)[1] + " " + sentence(10)
        else:
            text = sentence(rng.randrange(20, 160))
        docs.append((i, text, "en", f"src{i % 3}", len(text)))
        good[i] = int(" | " not in text)
    return docs, [(i, q, 0) for i, q in good.items()], items


def fold(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def shingles(t):
    w = fold(t).split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stages_against_plain_python(spark, tmp_path):
    docs, labels, items = corpus()
    make = spark.createDataFrame
    sf = str(tmp_path / "sf")
    make(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{sf}/documents.parquet")
    make(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    make(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")

    table = spark.read.parquet(f"{sf}/documents.parquet")
    columns = table.columns
    text = {d[0]: d[1] for d in docs}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, sf)
        assert table.columns == columns
        table = make(table.collect(), table.schema)
        kept[name] = [r.doc_id for r in table.collect()]
        assert len(kept[name]) == len(set(kept[name]))
    first, exact, near, clean = (set(kept[n]) for n, _ in corpus_pipeline.STAGES[:-1])

    # The classifier is a model: nearly all of its decisions are the labels'; the later stages are judged on what it kept.
    assert len(first ^ {i for i, t in text.items() if " | " not in t}) <= 0.02 * len(text)
    groups = {}
    for i in first:
        groups.setdefault(fold(text[i]), []).append(i)
    assert exact == {max(g) for g in groups.values()}
    order = sorted(exact)
    sets = {i: shingles(text[i]) for i in order}
    root = {i: i for i in order}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, i in enumerate(order):
        for j in order[:x]:
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    assert near == {i for i in order if find(i) == i} and len(near) < len(exact)
    assert clean == {i for i in near if not any(q.lower() in text[i].lower() for _, q in items)} and len(clean) < len(near)

    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(out) == clean
    for i, r in out.items():
        ids = library.encode_ordinary(text[i])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[i].encode()).hexdigest()


def test_stage_order_and_empty_tables(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "MinHash near-dedup", "benchmark decontamination", "byte-level BPE"]
    sf = str(tmp_path / "sf")
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{sf}/{name}.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
