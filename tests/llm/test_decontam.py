"""Decontamination: verbatim and re-parameterised items, coincidences, both joins."""

import random

import pyarrow as pa
import pytest

from tomeflow.llm import decontam, pretokens
from tomeflow.llm.decontam import RAW, canonical, contaminated, document_windows, drop_contaminated, item_windows, judge, op9_decontamination

ITEMS = [
    (1, "Anna Berg buys 12 apples and gives 5 apples to Carl before Anna Berg eats 2 apples on the way home."),
    (2, "A train travels 120 km in 2 hours. How far does the same train travel in 7 hours at that speed?"),
    (3, "Which of these rivers flows through the largest number of different countries in central europe today"),
    (4, "short one"),
    (5, None),
    (6, "what does the word mean"),
]
CASES = {
    10: ("Before. Anna Berg buys 12 apples and gives 5 apples to Carl before Anna Berg eats 2 apples on the way home. After.", [1]),
    11: ("so then Maria Lopez buys 31 apples and gives 8 apples to Bo before Maria Lopez eats 4 apples on the way home, she said", [1]),
    12: ("A train travels 90 km in 3 hours. How far does the same train travel in 11 hours at that speed?", [2]),
    13: ("which of these rivers flows through the largest number of different countries in central europe today", [3]),
    14: ("A river travels far. How far does a bird travel at that speed? Nobody buys apples on the way home.", []),
    15: ("", []),
    16: (None, []),
    17: ("they asked what does the word mean in that old book", [6]),
    18: ("A train travels 5km in 2 hours. How far does the same train travel in 7 hours at that speed? " + " ".join(f"w{i}" for i in range(20000)), [2]),
}


def frames(spark):
    docs = spark.createDataFrame([(i, t, 0) for i, (t, _) in CASES.items()], "doc_id long, text string, item_id int")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_items_are_found_by_both_joins(spark, limit):
    docs, items = frames(spark)
    got = {r.id: (r.item_ids, r.reparameterised) for r in contaminated(docs, items, broadcast_hashes=limit).collect()}
    assert {i: x[0] for i, x in got.items()} == {i: want for i, (_, want) in CASES.items() if want}
    assert got[11][1] and got[12][1] and not got[10][1] and not got[13][1]
    kept = drop_contaminated(docs, items, broadcast_hashes=limit)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, want) in CASES.items() if not want)


def test_inconsistent_slots_are_a_coincidence(spark):
    items = spark.createDataFrame([(1, "first 3 birds then 3 cats then 3 dogs then 3 cows then 3 hens came along")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "first 4 birds then 4 cats then 4 dogs then 4 cows then 4 hens came along"), (2, "first 4 birds then 5 cats then 6 dogs then 7 cows then 8 hens came along")], "doc_id long, text string")
    assert [r.id for r in contaminated(docs, items).collect()] == [1]


def test_words_of_many_texts_are_typed_as_one_by_one(monkeypatch):
    rng = random.Random(4)
    pool = ["Anna", "berg", "12", "5km", "kg", "***", "(what", "end.", "3.5%", "$", "ü", "Two,", "x" * 90, "²", "A.B", "don't"]
    gaps = [" ", "  ", "\n", "\t ", "\x1c", "\x85", "\xa0", "\u3000"]
    texts = [None, "", " ", "\x1c\x1d"] + ["".join(rng.choice(pool) + str(rng.choice(["", k])) + rng.choice(gaps) for _ in range(rng.randrange(30))) for k in range(200)]
    texts += [" " + t for t in texts[4:50]]
    for size in (1, 30, 1000):
        monkeypatch.setattr(pretokens, "ENTRIES", size)
        table = pretokens.Table(pa.uint64())
        for part in (texts[:60], texts[60:], texts[::-1]):
            got = list(decontam.typed_texts(pa.array(part, pa.string()), table))
            assert [x.tolist() for x in got] == [[decontam._typed(w) for w in (t or "").split()] for t in part]
            for t, typed in zip(part, got):
                for own, given in zip(decontam.forms(t), decontam.forms(None, typed), strict=True):
                    assert all(own[k].tolist() == given[k].tolist() for k in (0, 1, 3, 4))
            assert len(table.keys) <= size


def test_common_words_are_typed_once_though_the_table_is_full(monkeypatch):
    monkeypatch.setattr(pretokens, "ENTRIES", 60)
    monkeypatch.setattr(decontam, "WORD_TABLE", 60)
    monkeypatch.setattr(decontam, "_TYPES", pretokens.Table(pa.uint64()), raising=False)
    monkeypatch.setattr(pretokens, "GROUP_BYTES", 1)  # a group for each batch
    typed, asked = decontam._typed, []
    monkeypatch.setattr(decontam, "_typed", lambda word: asked.append(word) or typed(word))
    common = [f"every{chr(97 + i)}" for i in range(20)]
    texts = [" ".join(common + [f"seldom{chr(97 + k)}{chr(97 + i)}" for i in range(15)]) for k in range(12)]
    batches = [pa.RecordBatch.from_pydict({"id": [k], "text_hash": [k], "text": [t]}) for k, t in enumerate(texts)]
    rows = [r for b in decontam._hash_rows([8], [])(iter(batches)) for r in b.to_pylist()]
    assert [asked.count(w) for w in common] == [1] * 20
    assert sorted((r["id"], r["hash"] % (1 << 64)) for r in rows) == sorted((k, int(h)) for k, t in enumerate(texts) for _, _, hs, _ in document_windows(t, [8], []) for h in hs)


def test_clean_texts_share_no_template(spark):
    rng = random.Random(1)
    words = [f"v{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = spark.createDataFrame([(i, text(30)) for i in range(20)], "item_id long, text string")
    docs = spark.createDataFrame([(i, text(300)) for i in range(100)], "doc_id long, text string")
    assert contaminated(docs, items).count() == 0
    assert contaminated(docs.limit(0), items).count() == 0
    assert contaminated(docs, items.limit(0)).count() == 0
    assert drop_contaminated(docs, items.limit(0)).count() == 100


def test_canonical_tokens():
    h, slot, _, _ = canonical("On Monday Anna Berg ran 5km and 3.5 kg, *** 7 apples.")
    assert slot.tolist() == [0, 2, 0, 1, 4, 0, 1, 4, 1, 0]  # the run of names is one slot, 5km a number and a unit
    same, _, _, _ = canonical("On Friday Bob ran 12 km and 4 kg, 9 apples.")
    assert h.tolist() == same.tolist()


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_occurrences_are_judged_one_by_one(spark, limit):
    both = CASES[10][0] + " " + CASES[11][0]
    far = CASES[10][0] + " " + " ".join(f"w{i}" for i in range(500)) + " " + CASES[11][0]
    docs = spark.createDataFrame([(1, both), (2, far), (3, CASES[14][0])], "doc_id long, text string")
    twins = spark.createDataFrame([ITEMS[0], (7, CASES[11][0])], "item_id long, text string")
    assert sorted((r.id, r.item_ids) for r in contaminated(docs, twins, broadcast_hashes=limit).collect()) == [(1, [1, 7]), (2, [1, 7])]
    assert [r.doc_id for r in drop_contaminated(docs, twins, broadcast_hashes=limit).collect()] == [3]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_changed_names_that_open_sentences(spark, limit):
    text = "{0} buys twelve red apples at the market today. {0} eats two of them on the way home. {0} gives half of the rest away to friends. How many apples are left?"
    items = spark.createDataFrame([(1, text.format("Maria"))], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Before that. " + text.format("Bo")), (2, text.format("Anna Berg")), (3, text.format("Maria"))], "doc_id long, text string")
    got = {r.id: (r.item_ids, r.reparameterised) for r in contaminated(docs, items, broadcast_hashes=limit).collect()}
    assert got == {1: ([1], True), 2: ([1], True), 3: ([1], False)}
    assert drop_contaminated(docs, items, broadcast_hashes=limit).count() == 0


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_items_without_template_windows_are_found_verbatim(spark, limit):
    long = "1 + 2 = 3 ; 4 + 5 = 9 ; 6 + 7 = 13"
    items = spark.createDataFrame([(1, "What is 12 * 7 + 3?"), (2, long)], "item_id long, text string")
    cases = {1: "He asked: (what is 12 * 7 + 3) again.", 2: "What is 13 * 7 + 3?", 3: f"so {long} holds", 4: "1 + 2 = 3 ; 4 + 5 = 9 ; 6 + 7 = 14", 5: None}
    docs = spark.createDataFrame([*cases.items()], "doc_id long, text string")
    assert {r.id: r.item_ids for r in contaminated(docs, items, broadcast_hashes=limit).collect()} == {1: [1], 3: [2]}


def held(text, items):
    """Items of a text, each compared with it by itself."""
    out = set()
    for item, (_, words) in enumerate(items):
        for form, size, windows in item_windows(words):
            where = {}
            for x, at, values in windows:
                where.setdefault(x, []).append((at, values))
            hits = []
            for _, places, hashes, values_of in document_windows(text, *([[], [size]] if form == RAW else [[size], []])):
                for k, x in enumerate(hashes.tolist()):
                    hits += [(int(places[k]), at, mine, values_of(k)) for at, mine in where.get(x, [])]
            if hits and judge(hits, len(windows), form == RAW):
                out.add(items[item][0])
    return sorted(out)


def test_random_items_against_all_pairs(spark):
    rng = random.Random(8)
    names, words = ["Anna", "Bo Lind", "Carl", "Dora"], [f"w{chr(97 + i)}{chr(97 + i % 7)}" for i in range(20)]
    slot = lambda: rng.choice([str(rng.randrange(9)), rng.choice(names), "%d km" % rng.randrange(5), rng.choice(words), rng.choice(words)])
    items = [(i, " ".join(slot() for _ in range(rng.choice([1, 3, 6, 9, 14, 30])))) for i in range(30)]
    items += [(30, "3 5 8 13 21 34 55 ?"), (31, "3 5 8 13 21 34 55 ?"), (32, items[5][1]), (33, None), (34, "?!"), (None, items[7][1])]
    docs = []
    for i in range(120):
        parts = [" ".join(slot() for _ in range(rng.randrange(25)))]
        for _ in range(rng.randrange(3)):
            text = rng.choice(items)[1] or ""
            if rng.random() < 0.5:
                text = " ".join(str(rng.randrange(9)) if w.isdigit() else w for w in text.split())
            parts += [text, " ".join(rng.choice(words) for _ in range(rng.randrange(12)))]
        docs.append((i, " ".join(parts)))
    docs += [(None, items[4][1]), (None, items[4][1]), (None, "nothing"), (7, items[8][1]), (7, "other"), (500, None), (501, "")]
    keyed = [(i if i is not None else 1000 + k, t) for k, (i, t) in enumerate(items)]
    back = {k: i for (i, _), (k, _) in zip(items, keyed)}
    want = sorted((-1 if d is None else d, sorted({back[k] for k in found} - {None})) for d, t in docs if (found := held(t, keyed)))
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert 20 < len(want) < len(docs)
    for limit in (1 << 20, 0):
        got = contaminated(frame, bench, broadcast_hashes=limit).collect()
        assert sorted((-1 if r.id is None else r.id, [x for x in r.item_ids if x is not None]) for r in got) == want
    bad = [(d, t) for d, t in docs if held(t, keyed)]
    left = sorted((str(r.doc_id), str(r.text)) for r in drop_contaminated(frame, bench).collect())
    assert left == sorted((str(d), str(t)) for d, t in docs if (d, t) not in bad)


def test_values_of_one_kind_do_not_stand_for_many(spark):
    item = "first 3 birds then 4 cats then 5 dogs then 6 cows then 7 hens came along"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, item.translate(str.maketrans("34567", "99999"))), (2, item.translate(str.maketrans("34567", "45678"))), (3, item)], "doc_id long, text string")
    assert sorted(r.id for r in contaminated(docs, items).collect()) == [2, 3]


def test_the_query_has_the_columns_of_its_contract(spark, tmp_path):
    docs, items = frames(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = op9_decontamination(spark, str(tmp_path))
    assert got.columns == ["doc_id", "item_ids", "coverage", "reparameterised"]
    assert {r.doc_id: r.item_ids for r in got.collect()} == {i: want for i, (_, want) in CASES.items() if want}
