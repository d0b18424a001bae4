"""The registered queries on a small folder: their columns, and rows that only they add."""

import hashlib

import pytest

from tomeflow.llm import queries

CONTRACT = {
    "op1_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op3_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op4_minhash_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op5_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op10_wavelet_output": ["doc_id", "start", "n_tokens", "ids_crc32"],
}
TEXTS = {1: "A b c d e f g", 2: None, 3: "", 4: "a B c d e f g", 5: "river " * 20000}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS n", "'x' AS keep_id").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(7, 1, "user", "hi"), (7, 2, "assistant", None)], "conv_id long, turn int, role string, text string").write.parquet(f"{path}/conversations.parquet")
    return str(path)


@pytest.mark.parametrize("name", CONTRACT)
def test_documents(spark, folder, name):
    got = queries.QUERIES[name](spark, folder)
    assert got.columns[: len(CONTRACT[name])] == CONTRACT[name]
    rows = {r.doc_id: r for r in got.collect()}
    assert sorted(rows) == sorted(TEXTS)
    match name:
        case "op1_bpe":
            assert all(rows[k].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest() for k, t in TEXTS.items())
        case "op3_exact_dedup":
            assert [(rows[k].keep_id, rows[k].group_size, rows[k].kept) for k in sorted(rows)] == [(4, 2, False), (3, 2, False), (3, 2, True), (4, 2, True), (5, 1, True)]
        case "op4_minhash_dedup":
            assert [(rows[k].n_shingles, rows[k].component_id) for k in sorted(rows)] == [(3, 1), (0, 2), (0, 3), (3, 1), (1, 5)]
        case "op5_substring_dedup":
            assert [(rows[k].n_words, rows[k].n_removed) for k in sorted(rows)] == [(7, 0), (0, 0), (0, 0), (7, 0), (20000, 19999)]
        case "op10_wavelet_output":
            assert [rows[k].start for k in sorted(rows)] == [sum(rows[j].n_tokens for j in rows if j < k) for k in sorted(rows)]
            assert rows[2].n_tokens == rows[3].n_tokens == 1


def test_conversations(spark, folder):
    rows = {r.conv_id: r for r in queries.QUERIES["op8_chat_format"](spark, folder).collect()}
    said = "</s>[INST] ok [/INST]"
    assert sorted(rows) == [-1, 7]
    assert (rows[-1].n_turns, rows[-1].loss_chars) == (2, len(said))
    assert rows[-1].turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert rows[-1].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert (rows[7].n_turns, rows[7].loss_chars) == (2, 0)
