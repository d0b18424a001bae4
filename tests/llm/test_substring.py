"""Substring dedup against a dictionary of all windows."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tomeflow.llm import substring
from tomeflow.llm.substring import WINDOW, remove_repeats


def brute(rows):
    first, docs = {}, []
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        docs.append((i, words))
        for s in range(len(words) - WINDOW + 1):
            w, at = tuple(words[s : s + WINDOW]), (i, s)
            first[w] = min(first.get(w, at), at)
    out = []
    for i, words in docs:
        gone = set()
        for s in range(len(words) - WINDOW + 1):
            if first[tuple(words[s : s + WINDOW])] < (i, s):
                gone.update(range(s, s + WINDOW))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((r.id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in df.collect())


def sample(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(50)] + ["É", "W1"]
    passages = [[rng.choice(vocab) for _ in range(rng.choice([19, 20, 21, 60, 150]))] for _ in range(8)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.randrange(5)):
            words += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(vocab) for _ in range(rng.randrange(70))]
        rows.append((i, rng.choice([" ", "\n"]).join(words)))
    rows += [(200, None), (201, ""), (202, "a " * 400), (203, "x y " * 300), (204, "a " * 25)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,block", [(1, 1_000_000), (2, 300), (3, 1)])
def test_removed_words_are_those_of_all_windows(spark, monkeypatch, seed, block):
    monkeypatch.setattr(substring, "BLOCK_WORDS", block)
    rows = sample(seed)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, hash int").repartition(5)
    assert got(remove_repeats(docs)) == brute(rows)


@pytest.mark.parametrize("heavy", [[], [2], [0, 1, 2, 3]])
def test_blocks_of_any_size_settle_alike(heavy):
    rows = [(i, i * 7, substring.shingles.split_words(t, False)) for i, t in sorted(sample(4)) if t]
    docs = [r for r in rows if len(r[2]) >= WINDOW]
    want = {(i, n, g) for i, n, g, _ in brute(sample(4)) if n >= WINDOW}
    for size in (1, 3, 1000):
        packed = []
        for k in range(0, len(docs), size):
            block = substring.Block(docs[k : k + size], 4)
            words = int(block.sizes()[1].sum())
            block.split(np.array(heavy, np.int64), 4, 3)
            packed += block.rows(4)
            assert len(heavy) or int(block.sizes()[1].sum()) == words
        gone = {i: np.zeros(len(w), bool) for i, _, w in docs}
        for bucket in range(7):
            mine = [r for r in packed if r[0] == bucket]
            if mine:
                table = substring.pa.Table.from_batches([substring._table(mine, substring.ROW)])
                for r in substring._bucket_runs(table).to_pylist():
                    for first, n in np.frombuffer(r["runs"], "<i4").reshape(2, -1).T:
                        gone[r["id"]][first : first + n + WINDOW - 1] = True
        assert {(i, len(g), int(g.sum())) for i, g in gone.items()} == want


def test_equal_hashes_are_compared_word_for_word(monkeypatch):
    h = np.zeros(6, np.uint64)
    kind = np.array([1, 2, 1, 2, 3, 1])
    later = substring._later_starts(h, np.arange(6), lambda i, j: kind[i] == kind[j])
    assert later.tolist() == [False, False, True, True, False, True]


def test_repeated_and_null_identifiers(spark):
    text = " ".join(f"v{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (1, text), (1, "q " + text), (None, text), (2, "z")], "doc_id long, text string")
    rows = sorted(((r.id or 0), r.n_words, r.n_removed) for r in remove_repeats(docs).collect())
    assert rows == [(0, 30, 0), (1, 30, 30), (1, 30, 30), (1, 31, 30), (2, 1, 0)]


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_one_phrase_in_every_document(spark, monkeypatch):
    """The phrase's minimiser would fill one bucket: its windows are dealt by their whole hashes."""
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(5000)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    shared = text(70)
    rows = [(i, " ".join(text(25) + "it is said by all who know the place well and long".split() + text(25) + (shared if i % 9 == 0 else []))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(substring, "BLOCK_WORDS", 2000)
    monkeypatch.setattr(substring, "BUCKET_BYTES", 20_000)
    keyed, _ = substring.keyed(docs, "doc_id", "text")
    buckets = substring.bucket_count(keyed, "text")
    heavy, more = substring.heavy_buckets(keyed, buckets)
    assert 0 < len(heavy) < buckets / 4
    sizes = lambda h, m: [len(r.pack or b"") for r in keyed.mapInArrow(substring._super_kmers(buckets, h, m), "bucket long, pack binary, id long, text_hash long, runs binary").groupBy("bucket").agg(F.first("bucket").alias("b"), F.concat_ws("", F.collect_list(F.base64("pack"))).alias("pack")).collect()]
    assert max(sizes(heavy, more)) < max(sizes(heavy[:0], 1)) / 2
    assert got(remove_repeats(docs)) == brute(rows)


def test_a_very_long_text_and_the_querys_columns(spark, tmp_path):
    words = [f"w{i}" for i in range(200_000)]
    rows = [(1, " ".join(words + words[1000:1100]), "x"), (2, "y" * 500_000, "x"), (3, " ".join(words[:150_000]), "x"), (4, None, "x")]
    spark.createDataFrame(rows, "doc_id long, text string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    found = substring.op5_substring_dedup(spark, str(tmp_path))
    assert found.dtypes == [("doc_id", "bigint"), ("n_words", "bigint"), ("n_removed", "bigint"), ("kept_sha256", "string")]
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in found.collect()) == [(1, 200_100, 100), (2, 1, 0), (3, 150_000, 150_000), (4, 0, 0)]


def test_words_are_hashed_side_by_side_as_split_parts_them(monkeypatch):
    rng = np.random.default_rng(8)
    words = ["", "a", "a\0", "\0", "é" * 5, "\u00a0", "x" * 7, "x" * 8, "x" * 9, "x" * 16, "y" * 64, "y" * 65, "z" * 500, "z" * 501, "\x1c"]
    text = "".join(words[i] + " \t\n\r\v\f"[j] for i, j in rng.integers(0, [len(words), 6], (3000, 2)))
    for raw in (text.encode(), b"", b" \n", b"one"):
        h, begin, end = substring.shingles.hashed_words(raw)
        assert [raw[a:b] for a, b in zip(begin, end)] == raw.split()
        assert len({*h.tolist()}) == len({*raw.split()}) == len({*zip(h.tolist(), raw.split())})
    docs = [(i, 0, t.encode().split()) for i, t in enumerate([text, "b " * 30, text])]
    blocks = []
    for size in (1, 1 << 18):
        monkeypatch.setattr(substring, "HASH_BYTES", size)
        blocks.append(sorted(substring.Block(docs, 4).rows(4), key=str))
    assert blocks[0] == blocks[1]
