"""Exact dedup against a dictionary of texts."""

import glob
import hashlib
import random

import pytest

from tomeflow.llm import exact, joins
from tomeflow.llm.exact import drop_exact_copies, exact_groups
from tomeflow.workspace import shared_dir


def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(rows, keep=max):
    groups = {}
    for i, t in rows:
        groups.setdefault(fold(t), []).append(i)
    return sorted(
        (i, keep(groups[fold(t)]), len(groups[fold(t)]), hashlib.sha256(fold(t).encode()).hexdigest()) for i, t in rows
    )


def got(df):
    return sorted((r.id, r.keep_id, r.group_size, bytes(r.sha).hex()) for r in df.collect())


def sample():
    rng = random.Random(3)
    texts = ["", "a", "A", "Ä", "ä", "ÉCOLE x", "École X", "long " * 4000, "b c", "İ", "i̇"]
    rows = [(i, rng.choice(texts + [None])) for i in range(300)]
    return rows + [(1000 + i, f"unique {i}") for i in range(50)]


def test_groups(spark):
    rows = sample()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(exact_groups(docs)) == brute(rows)
    assert got(exact_groups(docs, keep="smallest")) == brute(rows, min)
    kept = [r.id for r in exact_groups(docs).collect() if r.kept]
    assert sorted(kept) == sorted({b for _, b, _, _ in brute(rows)})


def test_colliding_digests_are_told_apart_by_bytes(spark):
    rows = sample()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    df = exact_groups(docs, digest_bits=8)
    assert got(df) == brute(rows)
    assert sorted(r.id for r in df.collect() if r.kept) == sorted({b for _, b, _, _ in brute(rows)})


def test_filter_keeps_columns_and_one_row_each(spark):
    rows = [(1, "A", 7), (2, "a", 8), (2, "a", 8), (3, "b", 9), (3, "c", 9), (None, None, 1), (None, "", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest int")
    left = drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or -1, fold(r.text)) for r in left.collect()) == [(-1, ""), (2, "a"), (3, "b"), (3, "c")]
    unique = spark.createDataFrame([(1, "A", 7), (2, "a", 8), (3, "b", 9)], "doc_id long, text string, digest int")
    assert sorted(r.doc_id for r in drop_exact_copies(unique).collect()) == [2, 3]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_groups(docs).count() == 0
    assert drop_exact_copies(docs).count() == 0


@pytest.fixture
def many_partitions(spark):
    """As many shuffle partitions as a large cluster has, and none put together."""
    conf = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_few_files_are_written_whatever_the_shuffle_partitions(spark, many_partitions):
    rows = [(i, f"text {i % 400}") for i in range(1200)] + [(2000 + i, "One large GROUP") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    folder = shared_dir(spark).removeprefix("file://") + "/tomeflow/digest-index-*"
    before = set(glob.glob(f"{folder}/*/part-*"))
    df = exact_groups(docs)
    assert len(set(glob.glob(f"{folder}/*/part-*")) - before) <= 5 + 5 + 1  # runs, compacted runs, collisions
    assert df.rdd.getNumPartitions() <= 5
    assert got(df) == brute(rows)


@pytest.mark.parametrize("bits", [256, 8])
def test_beyond_the_broadcast_limits(spark, monkeypatch, bits):
    monkeypatch.setattr(exact, "BROADCAST_ENTRIES", 0)
    monkeypatch.setattr(joins, "BROADCAST_IDS", 0)
    rows = sample()
    docs = spark.createDataFrame(rows + [(7, "again")], "doc_id long, text string")
    assert got(exact_groups(docs, digest_bits=bits)) == brute(rows + [(7, "again")])
