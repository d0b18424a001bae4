"""Wavelet matrices against lists; shards against the library."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import regex
from tokenizers import Tokenizer

from tomeflow.llm import pretokens, wavelet
from tomeflow.llm.wavelet import WaveletMatrix, find_token, from_bytes, read_documents, to_bytes, write_shards

VOCAB = P.path("byte_bpe_50k.json")


def test_access_rank_select_and_decode():
    rng = np.random.default_rng(1)
    for n, top, levels in [(1, 1, 1), (511, 7, 3), (512, 7, 3), (5000, 50000, 16), (1500, 70000, 17), (0, 5, 3)]:
        ids = rng.integers(0, top, n).astype(np.uint32 if levels > 16 else np.uint16)
        ids[: n // 2] //= 50
        m = WaveletMatrix.build(ids, levels)
        assert m.decode().tolist() == ids.tolist()
        for i in rng.integers(0, n, 30) if n else []:
            token = int(ids[i])
            assert m.access(int(i)) == token
            assert m.rank(token, int(i)) == int((ids[:i] == token).sum())
            assert m.count(token) == int((ids == token).sum())
            assert m.occurrences(token)[:50] == np.flatnonzero(ids == token).tolist()[:50]
        assert m.count(1 << levels) == 0


def test_sequences_longer_than_a_part():
    rng = np.random.default_rng(3)
    for n, top, levels in [(2 * wavelet.PART + 77, 50257, 16), (wavelet.PART, 70000, 17)]:
        ids = (rng.zipf(1.2, n) % top).astype(np.uint32 if levels > 16 else np.uint16)
        m = WaveletMatrix.build(ids, levels)
        order = ids
        for k, plane in enumerate(m.planes):
            bit = order >> (levels - 1 - k) & 1
            assert np.unpackbits(plane, count=n, bitorder="little").tolist() == bit.tolist()
            order = order[np.argsort(bit, kind="stable")]
        assert (m.decode() == ids).all()


def test_the_pattern_for_latin_texts_is_the_patterns_own():
    own, fast = regex.compile(pretokens.WORD_SPACE_PATTERN).findall, pretokens.latin_pattern().findall
    rng = random.Random(5)
    chars = [chr(c) for c in range(pretokens.LATIN_END)]
    for c in chars:
        for text in (c, f"a{c}b", f" {c} {c}", f"{c}{c}1", f"'{c}", f" \n{c}\n "):
            assert fast(text) == own(text), repr(text)
    for _ in range(300):
        text = "".join(rng.choice([rng.choice(chars), " ", "'", "s", "\n", "ll"]) for _ in range(60))
        assert fast(text) == own(text), repr(text)


def test_a_full_table_keeps_what_the_last_texts_hold(monkeypatch):
    monkeypatch.setattr(pretokens, "ENTRIES", 60)
    asked = []

    def encode(strings, plain):
        asked.extend(strings)
        return [np.frombuffer(s.encode(), np.uint8).astype("<u2").tobytes() for s in strings]

    encoder = pretokens.PieceEncoder(encode, "<u2")
    common = " ".join(f"common{i}" for i in range(20))
    for k in range(12):
        text = f"x {common} " + " ".join(f"rare{k}n{i}" for i in range(15))
        (ids,) = encoder.many([text])
        assert bytes(ids.tolist()).decode() == text
    assert [asked.count(f" common{i}") for i in range(20)] == [1] * 20


def test_file_round_trip():
    ids = np.arange(3000, dtype=np.uint16) % 700
    m, docs, lengths = from_bytes(to_bytes(WaveletMatrix.build(ids, 10), [None, 3, 9, 9], np.array([1, 0, 2000, 999])))
    assert docs == [None, 3, 9, 9] and lengths.tolist() == [1, 0, 2000, 999]
    assert m.decode().tolist() == ids.tolist() and m.access(701) == 1


def texts():
    rng = random.Random(2)
    out = ["", " ", "  a", "a  b", "a\n \nb", "a\n b c", " lead", "tail \n", "<|endoftext|> x", "a <|endoftext|> b", "x<|endoftext|>y z <|endoftext|", "the <| endoftext |>", "日本語 テキスト", "x\x85 y", "one\x1c two", "z" * 3000]
    pool = ["the", "Straße", "naïve", "x1", "…", "\n", " ", "\t", "don't", "🎉", "\xa0", "　", "''s", "A.B"]
    out += ["".join(rng.choice(pool) + rng.choice(["", " ", "  "]) for _ in range(rng.randrange(40))) for _ in range(300)]
    return out


def test_piecewise_ids_are_the_librarys(monkeypatch):
    library = Tokenizer.from_file(VOCAB)
    encode, _, _ = wavelet._library(VOCAB)
    for _ in range(2):  # the second time from the table
        for t, ids in zip(texts(), encode(texts()), strict=True):
            assert ids.tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)
    for size in (1, 40, 300):
        monkeypatch.setattr(pretokens, "GROUP_BYTES", size)
        monkeypatch.setattr(pretokens, "ENTRIES", size)
        for t, ids in zip(texts(), encode(texts()), strict=True):
            assert ids.tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_shards_hold_every_document_in_order(spark):
    library = Tokenizer.from_file(VOCAB)
    rows = [(i * 3, t, "c") for i, t in enumerate(texts())] + [(None, "null id", "c"), (6, None, "c"), (6, "again", "c")]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "id long, text string, start string")
    manifest = write_shards(docs, VOCAB, id_col="id", shard_bytes=4000)
    assert manifest.count() > 3
    got = sorted(read_documents(manifest).collect(), key=lambda r: r.start)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at, whole = 0, []
    for r, (i, t, _) in zip(got, order, strict=True):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        assert (r.id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
        whole += ids
    token = max(set(whole), key=whole.count)
    assert sorted(r.place for r in find_token(manifest, token).collect()) == [k for k, x in enumerate(whole) if x == token]


def test_empty_table(spark):
    manifest = write_shards(spark.createDataFrame([], "doc_id long, text string"), VOCAB)
    assert read_documents(manifest).count() == 0


def test_the_query_gives_the_librarys_ids_of_long_texts_too(spark, tmp_path):
    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(4, "word and ünit " * 20_000, 1), (2, "a <|endoftext|> b", 1), (7, None, 1), (9, "", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, start int").write.parquet(f"{tmp_path}/documents.parquet")
    got = wavelet.op10_wavelet_output(spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    want, start = [], 0
    for i, text, _ in sorted(rows):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got.collect())) == want
