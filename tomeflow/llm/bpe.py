"""Byte-level BPE with a sentencepiece model that is written straight from a rank file.

A rank file (base64 token, space, rank) becomes a sentencepiece BPE ``ModelProto``
without any training: every token's bytes map to one printable character each, the
piece of rank r scores -r, the normaliser is the identity.  sentencepiece then
merges the neighbouring pair of the best score, which is the pair of the lowest
rank, as rank-based byte-level BPE does.  A pre-token that is a token as a whole
is that token, whether or not merges lead to it.  Decoding maps every id back to
its bytes.

Work is per row: no shuffle, one Arrow batch in memory, and a table of bounded size
of words and their ids in each Python worker (see ``pretokens``).

Defined results: a null text counts as empty and has no ids; texts of any length
are encoded whole; repeated rows and null identifiers pass through; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.llm import pretokens
from tomeflow.llm.batches import release, releasing, small_batches


def byte_alphabet() -> list[str]:
    """One printable character for each byte: itself where it is printable, else the next from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protobuf field: bytes are length-delimited, ints varints, floats 32 bits."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised BPE ModelProto; piece 0 is the unknown piece, piece r + 1 the token of rank r."""
    alphabet = byte_alphabet()
    by_rank = sorted(ranks.items(), key=lambda x: x[1])
    if [r for _, r in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must run from 0 without gaps")
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"the vocabulary has no token for the bytes {missing}")
    pieces = [_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))]
    for token, rank in by_rank:
        piece = "".join(alphabet[b] for b in token).encode()
        pieces.append(_field(1, _field(1, piece) + _field(2, -float(rank)) + _field(3, 1)))
    # trainer_spec: model type BPE, unknown piece 0, no begin, end or padding piece (-1 as 64-bit varints)
    none = (1 << 64) - 1
    trainer = _field(3, 2) + _field(40, 0) + _field(41, none) + _field(42, none) + _field(43, none)
    # normalizer_spec: identity; no dummy prefix, no removal or escape of white space
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


#: Texts are encoded together up to this share of the encoder's group: pieces, ids and tables take many times their bytes.
SHARE = 8
#: The table of pieces has this share of the largest one's entries: each group's look-up hashes all of them anew.
TABLE_SHARE = 2


class Codec:
    """Encoder and decoder of one vocabulary; made once in each Python worker."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.ranks = read_ranks(path)
        self.tokens = [t for t, _ in sorted(self.ranks.items(), key=lambda x: x[1])]
        self.decimal = [str(i) for i in range(len(self.tokens))]
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.ranks))
        self.find = regex.compile(pattern).findall
        self.alphabet = dict(enumerate(byte_alphabet()))
        self.pieces = pretokens.PieceEncoder(self._encode_strings, "<u4", share=TABLE_SHARE) if pattern == pretokens.WORD_SPACE_PATTERN else None

    def _merge(self, pre_tokens: list[str]) -> list[list[int]]:
        """Ids of pre-tokens: the token that a pre-token is as a whole, else sentencepiece's merges."""
        raw = [p.encode() for p in pre_tokens]
        whole = list(map(self.ranks.get, raw))
        rest = [r.decode("latin-1").translate(self.alphabet) for r, w in zip(raw, whole) if w is None]
        merged = iter(self.model.encode(rest, num_threads=1) if rest else ())
        return [[w] if w is not None else [i - 1 for i in next(merged)] for w in whole]

    def _encode_strings(self, strings: list[str], plain: int = 0) -> list[bytes]:
        found: dict[int, bytes] = {}
        if self.pieces:  # many short strings: they are split and merged as lines of one text
            at, text, counts = pretokens.as_lines(strings, plain)
            if at:
                ids = np.array([i for merged in self._merge(self.find(text)) for i in merged], "<u4")
                found = pretokens.split_lines(at, counts, ids, self.ranks[b"\n"]) or {}
        for k, s in enumerate(strings):
            if k not in found:
                found[k] = np.array([i for merged in self._merge(self.find(s)) for i in merged], "<u4").tobytes()
        return [found[k] for k in range(len(strings))]

    def encode_many(self, texts: pa.Array | list[str]) -> Iterator[list[int]]:
        """Ids of each text; null counts as empty."""
        if self.pieces:
            return (ids.tolist() for ids in self.pieces.many(texts))
        plain = texts.to_pylist() if isinstance(texts, pa.Array) else texts
        return (np.frombuffer(self._encode_strings([t or ""])[0], "<u4").tolist() for t in plain)

    def encode(self, text: str) -> list[int]:
        return next(self.encode_many([text]))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode_texts(docs: DataFrame, vocab: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with a column of token ids; a column of that name is replaced."""
    from pyspark.sql.pandas.functions import arrow_udf
    from pyspark.sql.types import ArrayType, IntegerType

    small_batches(docs.sparkSession)

    @arrow_udf(ArrayType(IntegerType()))
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(vocab, pattern)
        for texts in batches:
            yield pa.array(list(c.encode_many(texts)), pa.list_(pa.int32()))

    return docs.withColumn(ids_col, ids(F.col(text_col)))


def decode_ids(docs: DataFrame, vocab: str, pattern: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``docs`` with the bytes of a column of token ids; null ids give no bytes."""
    from pyspark.sql.pandas.functions import arrow_udf
    from pyspark.sql.types import BinaryType

    @arrow_udf(BinaryType())
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(vocab, pattern)
        for ids in batches:
            yield pa.array([c.decode(i or []) for i in ids.to_pylist()], pa.binary())

    return docs.withColumn(text_col, texts(F.col(ids_col)))


def roundtrip_digests(docs: DataFrame, vocab: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass: ``id, n_tokens, ids_sha256, decoded_sha256``."""
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    id_type = docs.select(id_col).schema

    small_batches(docs.sparkSession)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocab, pattern)
        for doc_ids, texts in pretokens.grouped(batches, share=SHARE):
            counts, id_hash, text_hash = [], [], []
            for ids in c.encode_many(texts):
                counts.append(len(ids))
                id_hash.append(hashlib.sha256(",".join(map(c.decimal.__getitem__, ids)).encode()).hexdigest())
                text_hash.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(counts, pa.int64()), pa.array(id_hash, pa.string()), pa.array(text_hash, pa.string())],
                [id_type.names[0], "n_tokens", "ids_sha256", "decoded_sha256"],
            )
            release()

    return docs.select(id_col, text_col).mapInArrow(releasing(digests), schema)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return roundtrip_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


SQL: dict[str, str] = {}
