"""Byte-level BPE against the rank library itself."""

import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from tomeflow.llm.bpe import codec, decode_ids, encode_texts, read_ranks, roundtrip_digests

VOCAB = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(VOCAB), special_tokens={})


def texts():
    rng = random.Random(5)
    out = ["", " ", "  a", "a ", "a  b", "a   b", "a\n \nb", "a \n b", "a\n b", "\n", "  ", " a\x1c b", "a\u3000 b", "x " * 50 + " \t ", "\n\n \t x", "a" * 5000, "don't we'll IT'S", "<|endoftext|>", "naïve Straße ñandú 日本語 🎉👩‍👩‍👧", "\x00\x01\x1c\x1f\x85  　 z"]
    for _ in range(400):
        pool = rng.choice(["abcde ", "äöüßñé ", "0123456789.,$%& ", "\t\n\r   　", "漢字かな交じり", "🎉🧵"])
        out.append("".join(rng.choice(pool + "the on ") for _ in range(rng.randrange(60))))
    for _ in range(300):
        out.append("".join(chr(rng.choice([rng.randrange(0x20, 0x250), rng.randrange(0x370, 0xD7FF), rng.randrange(0x10000, 0x1FFFF)])) for _ in range(rng.randrange(30))))
    return out


def test_ids_are_the_librarys(library):
    c = codec(VOCAB, P.PATTERN)
    for t in texts():
        ids = c.encode(t)
        assert ids == library.encode_ordinary(t), t
        assert c.decode(ids) == t.encode()


def test_every_token_as_a_text(library):
    c = codec(VOCAB, P.PATTERN)
    for token in list(read_ranks(VOCAB))[::7]:
        try:
            t = token.decode()
        except UnicodeDecodeError:
            continue
        assert c.encode(t) == library.encode_ordinary(t), t


def test_a_full_cache_is_emptied(library, monkeypatch):
    from tomeflow.llm import bpe, pretokens

    monkeypatch.setattr(pretokens, "ENTRIES", 5)
    c = bpe.Codec(VOCAB, P.PATTERN)
    for t in texts()[:200]:
        assert c.encode(t) == library.encode_ordinary(t)


def test_other_patterns_are_not_cut_at_spaces():
    pattern = r"\w+ \w+|\s|."
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(VOCAB), special_tokens={})
    from tomeflow.llm.bpe import Codec

    c = Codec(VOCAB, pattern)
    for t in texts()[:100]:
        if "\x85" not in t:
            assert c.encode(t.replace("\n", "")) == other.encode_ordinary(t.replace("\n", ""))


def test_operator_and_edge_rows(spark, library):
    rows = [(1, None, "x"), (1, None, "x"), (2, "", "y"), (None, "the thing", "z"), (3, "word " * 30000, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = roundtrip_digests(docs, VOCAB, P.PATTERN).collect()
    assert len(got) == 5
    for r, (i, t, _) in zip(got, rows):
        ids = library.encode_ordinary(t or "")
        assert (r.doc_id, r.n_tokens) == (i, len(ids))
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    back = decode_ids(encode_texts(docs, VOCAB, P.PATTERN), VOCAB, P.PATTERN, text_col="bytes").collect()
    assert [bytes(r.bytes) for r in back] == [(t or "").encode() for _, t, _ in rows]
    assert roundtrip_digests(docs.limit(0), VOCAB, P.PATTERN).count() == 0
