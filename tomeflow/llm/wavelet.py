"""Token-id output as wavelet matrices, one compressed file for each shard.

Documents are range-partitioned by identifier; every partition is a shard.  A shard's
ids, each document closed by an end id, become a wavelet matrix (Claude, Navarro and
Ordonez, 2015): one bit-plane for each bit of an id, the highest first, every plane
stably partitioned by the plane before.  A plane carries a rank directory (ones before
each block of 512 bits), so a token is read, counted or located with a few lookups per
plane, without the other tokens.

File: ``TFWM1``, the length of a JSON header, the header, then zstd frames: document
identifiers, document lengths, and for each plane its bits and its directory.

Files go below the shared folder under a name that holds the task attempt, and the
manifest lists those of committed tasks only, so retries and lost executors leave no
half-written or doubled shard.

Defined results: a null text has the end id alone; a null identifier sorts first;
rows that repeat an identifier are ordered by text; an empty table gives no shards
and an empty result; other columns are not read.
"""

from __future__ import annotations

import bisect
import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tomeflow.llm import pretokens
from tomeflow.llm.batches import small_batches
from tomeflow.llm.bpe import byte_alphabet
from tomeflow.workspace import Workspace

MAGIC = b"TFWM1"
BLOCK = 512
SHARD_BYTES = 12 << 20
PART = 1 << 16

_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class WaveletMatrix:
    """Bit-planes with rank and select over a sequence of non-negative ids."""

    def __init__(self, size: int, planes: list[np.ndarray], ranks: list[np.ndarray]):
        self.size, self.planes, self.ranks = size, planes, ranks
        self.zeros = [size - int(r[-1]) for r in ranks]

    @classmethod
    def build(cls, ids: np.ndarray, levels: int) -> WaveletMatrix:
        planes, ranks = [], []
        size, pad = len(ids), -len(ids) % BLOCK
        bit = np.zeros(size + pad, bool)
        ids, after = ids.copy(), np.empty_like(ids)
        for level in range(levels - 1, -1, -1):
            np.not_equal(ids & ids.dtype.type(1 << level), 0, out=bit[:size])
            plane = np.packbits(bit, bitorder="little")
            ones = np.bitwise_count(plane.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
            planes.append(plane)
            ranks.append(np.concatenate(([0], np.cumsum(ones))).astype(np.uint32))
            if level:
                # The stable partition, a part at a time that stays in the processor's cache.
                ends = [0, size - int(ranks[-1][-1])]
                for start in range(0, size, PART):
                    part, is_one = ids[start : start + PART], bit[start : min(start + PART, size)]
                    for kind, places in enumerate((np.flatnonzero(~is_one), np.flatnonzero(is_one))):
                        part.take(places, out=after[ends[kind] : ends[kind] + len(places)], mode="clip")
                        ends[kind] += len(places)
                ids, after = after, ids
        return cls(size, planes, ranks)

    def _bit(self, level: int, i: int) -> int:
        return self.planes[level][i >> 3] >> (i & 7) & 1

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block = i // BLOCK
        from_byte, to_byte = block * BLOCK // 8, i >> 3
        count = int(self.ranks[level][block]) + int(_ONES[self.planes[level][from_byte:to_byte]].sum())
        return count + (int(_ONES[self.planes[level][to_byte] & ((1 << (i & 7)) - 1)]) if i & 7 else 0)

    def _select(self, level: int, k: int, bit: int) -> int:
        """Place of the k-th (from 0) bit of a kind in a plane: its block by the directory, then within."""
        before = self.ranks[level].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.planes[level][block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - before[block]])

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        out = 0
        for level, zeros in enumerate(self.zeros):
            bit = self._bit(level, i)
            ones = self._rank1(level, i)
            i = zeros + ones if bit else i - ones
            out = out << 1 | int(bit)
        return out

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a token among the first ``end`` places lie below the last plane."""
        levels = len(self.planes)
        lo, hi = 0, end
        for level, zeros in enumerate(self.zeros):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            lo, hi = (zeros + a, zeros + b) if token >> (levels - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, token: int, end: int) -> int:
        """Occurrences of a token among the first ``end`` places."""
        if token >> len(self.planes):
            return 0
        lo, hi = self._range(token, min(max(end, 0), self.size))
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.size)

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of a token."""
        if token >> len(self.planes) or not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._range(token, self.size)[0] + k
        for level in range(len(self.planes) - 1, -1, -1):
            bit = token >> (len(self.planes) - 1 - level) & 1
            i = self._select(level, i - self.zeros[level] if bit else i, bit)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """All ids, by undoing the partitions from the last plane to the first."""
        out = np.zeros(self.size, np.uint32 if len(self.planes) > 16 else np.uint16)
        before = np.empty_like(out)
        for level, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            out[zeros:] |= out.dtype.type(1 << level)
            ends = [0, zeros]
            for start in range(0, self.size, PART):
                part = before[start : start + PART]
                bit = np.unpackbits(plane[start >> 3 : (start + PART) >> 3], count=len(part), bitorder="little").view(bool)
                for kind, places in enumerate((np.flatnonzero(~bit), np.flatnonzero(bit))):
                    part[places] = out[ends[kind] : ends[kind] + len(places)]
                    ends[kind] += len(places)
            out, before = before, out
        return out


def to_bytes(matrix: WaveletMatrix, doc_ids: list[int | None], lengths: np.ndarray) -> bytes:
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    known = np.array([i or 0 for i in doc_ids], "<i8")
    sections = [np.diff(known, prepend=0).tobytes(), np.asarray(lengths, "<u8").tobytes()]
    for plane, rank in zip(matrix.planes, matrix.ranks):
        sections += [plane.tobytes(), rank.astype("<u4").tobytes()]
    frames = [pack(s) for s in sections]
    nulls = [k for k, i in enumerate(doc_ids) if i is None]
    header = json.dumps({"size": matrix.size, "levels": len(matrix.planes), "docs": len(doc_ids), "nulls": nulls, "frames": [len(f) for f in frames]}).encode()
    return MAGIC + len(header).to_bytes(8, "little") + header + b"".join(frames)


def from_bytes(raw: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    """``(matrix, document identifiers, document lengths)`` of a file."""
    import zstandard

    if raw[: len(MAGIC)] != MAGIC:
        raise ValueError("not a shard file")
    at = len(MAGIC) + 8
    n = int.from_bytes(raw[len(MAGIC) : at], "little")
    header = json.loads(raw[at : at + n])
    at += n
    unpack, sections = zstandard.ZstdDecompressor().decompress, []
    for length in header["frames"]:
        sections.append(unpack(raw[at : at + length]))
        at += length
    ids: list[int | None] = np.cumsum(np.frombuffer(sections[0], "<i8")).tolist()
    for k in header["nulls"]:
        ids[k] = None
    planes = [np.frombuffer(s, np.uint8) for s in sections[2::2]]
    ranks = [np.frombuffer(s, "<u4") for s in sections[3::2]]
    return WaveletMatrix(header["size"], planes, ranks), ids, np.frombuffer(sections[1], "<u8").astype(np.int64)


@functools.lru_cache(maxsize=2)
def _library(path: str):
    """Encoder of whole texts through the tokenizers library; one in each Python worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    library = Tokenizer.from_file(path)
    run = functools.partial(library.encode_batch_fast, add_special_tokens=False)
    # The same tokenizer for pre-tokens that are given one by one, their bytes mapped: its pattern has nothing left to do.
    by_word = Tokenizer.from_file(path)
    by_word.encode_special_tokens = True  # no text with an added token is cut into pre-tokens
    by_word.pre_tokenizer = pre_tokenizers.Sequence([])
    mapping = dict(enumerate(byte_alphabet()))
    end_id = run(["\n"])[0].ids

    whole = json.loads(library.to_str())
    split = whole.get("pre_tokenizer") or {}
    # Cutting at word spaces is right for the byte-level pattern without normaliser or added prefix.
    cuttable = whole.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    size = library.get_vocab_size()
    dtype = "<u2" if size <= 1 << 16 else "<u4"
    find = pretokens.latin_pattern().findall

    added = tuple(t.content for t in library.get_added_tokens_decoder().values())

    n_bytes = np.zeros(size, np.int64)
    for token, k in library.get_vocab().items():
        n_bytes[k] = len(token)
    table = pretokens.Table()

    def merged(words: pa.Array) -> pa.Array | None:
        """Ids of pre-tokens; None if they are not the bytes of the pre-tokens."""
        mapped = pretokens.joined(words, "\0").decode("latin-1").translate(mapping).split(mapping[0])
        ids = np.array(by_word.encode_batch_fast([mapped], is_pretokenized=True, add_special_tokens=False)[0].ids, dtype)
        ends, word_ends = np.cumsum(n_bytes[ids]), np.cumsum(pc.binary_length(words).to_numpy().astype(np.int64))
        edges = np.concatenate(([0], np.searchsorted(ends, word_ends) + 1))
        return pretokens.binaries(ids, edges) if edges[-1] == len(ids) and (ends[edges[1:] - 1] == word_ends).all() else None

    def ids_of(words: list[str]) -> np.ndarray | None:
        """Ids of a sequence of pre-tokens; each distinct one is merged once."""
        coded = pa.array(words, pa.string()).dictionary_encode()
        entry, lacking = table.find(coded.dictionary)
        new = coded.dictionary.take(pa.array(lacking))
        values = merged(new) if len(new) else pa.array([], pa.large_binary())
        if values is None:
            return None
        ids = pa.concat_arrays([table.values, values]).take(pa.array(entry[coded.indices.to_numpy()]))
        used = np.zeros(len(table.keys) + len(new), bool)
        used[entry] = True
        table.add(used[: len(table.keys)], new, values)
        return np.frombuffer(ids.buffers()[2] or b"", dtype)

    def latin_pieces(pieces: pa.Array) -> pa.Array | None:
        """Ids of pieces without white space, as lines of one text that begin with a space each."""
        ids = ids_of(find(" " + pretokens.joined(pieces, "\n ").decode())) if len(end_id) == 1 else None
        if ids is None or (is_end := ids == end_id[0]).sum() != len(pieces) - 1:
            return None
        ends = np.flatnonzero(is_end) - np.arange(len(pieces) - 1)
        return pretokens.binaries(np.compress(~is_end, ids), np.concatenate(([0], ends, [len(ids) - len(ends)])))

    def encode(strings: list[str], plain: int) -> list[bytes]:
        # Latin strings, on whose letters all Unicode versions agree, are split here and given as pre-tokens of one text.
        found: dict[int, bytes] = {}
        latin = [k for k, s in enumerate(strings) if s.isascii() or max(s) < "\u0250"]
        first = bisect.bisect_left(latin, plain)
        latin = latin[:first] + [k for k in latin[first:] if not any(x in strings[k] for x in added)]
        at, text, counts = pretokens.as_lines([strings[k] for k in latin], first)
        if at and len(end_id) == 1 and "\0" not in text:
            ids = ids_of(find(text))
            found = ids is not None and pretokens.split_lines([latin[k] for k in at], counts, ids, end_id[0]) or {}
        rest = [k for k in range(len(strings)) if k not in found]
        for k, e in zip(rest, run([strings[k] for k in rest]) if rest else ()):
            found[k] = np.array(e.ids, dtype).tobytes()
        return [found[k] for k in range(len(strings))]

    def whole_texts(texts: pa.Array | list[str]) -> Iterator[np.ndarray]:
        return (np.array(run([t or ""])[0].ids, dtype) for t in (texts.to_pylist() if isinstance(texts, pa.Array) else texts))

    return pretokens.PieceEncoder(encode, dtype, added, latin_pieces).many if cuttable else whole_texts, dtype, max(1, (size - 1).bit_length())


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


MANIFEST = "shard long, first_id long, path string, n_docs long, n_tokens long"


def _write_shards(folder: str, vocab: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, dtype, levels = _library(vocab)
        end = np.array([end_id], dtype)
        ids: list[int | None] = []
        parts: list[np.ndarray] = []
        lengths: list[int] = []
        for doc_ids, texts in pretokens.grouped(batches):
            ids += doc_ids.to_pylist()
            for tokens in encode(texts):
                parts += (tokens, end)
                lengths.append(len(tokens) + 1)
        if not ids:
            return
        tokens = np.concatenate(parts)
        del parts
        raw = to_bytes(WaveletMatrix.build(tokens, levels), ids, np.array(lengths))
        task = TaskContext.get()
        target = f"{folder}/shard-{task.partitionId():08d}-{task.taskAttemptId()}.twm"
        store, path = _filesystem(target)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(path) as f:
            f.write(raw)
        yield pa.RecordBatch.from_pydict(
            {"shard": [task.partitionId()], "first_id": pa.array([ids[0]], pa.int64()), "path": [target], "n_docs": [len(ids)], "n_tokens": [len(tokens)]}
        )

    return write


def write_shards(docs: DataFrame, vocab: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the shards in ascending order of identifiers; returns the manifest, with ``start`` (ids of all shards before)."""
    spark = docs.sparkSession
    small_batches(spark)
    ws = Workspace(spark, "wavelet")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    dealt = rows.repartitionByRange(int(shards), "id").sortWithinPartitions("id", "text")
    manifest = ws.stage(dealt.mapInArrow(_write_shards(ws.new_path("shards"), vocab, end_id), MANIFEST), "manifest")
    # A row for each shard of SHARD_BYTES of text: the running sum is over file names, not documents.
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0).cast("long")))


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for target, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            store, path = _filesystem(target)
            with store.open_input_file(path) as f:
                matrix, ids, lengths = from_bytes(f.read())
            tokens = matrix.decode()
            ends = np.cumsum(lengths)
            begins = ends - lengths
            crc = [zlib.crc32(tokens[b:e].astype("<u4")) for b, e in zip(begins, ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(begins + start, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())],
                ["id", "start", "n_tokens", "ids_crc32"],
            )


def read_documents(manifest: DataFrame) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of every document, from the files alone."""
    n = max(1, manifest.count())
    return manifest.select("path", "start").repartition(n, "path").mapInArrow(_read_shards, "id long, start long, n_tokens long, ids_crc32 long")


def _look_up(token: int):
    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for target, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, path = _filesystem(target)
                with store.open_input_file(path) as f:
                    matrix, *_ = from_bytes(f.read())
                places = [start + i for i in matrix.occurrences(token)]
                yield pa.RecordBatch.from_pydict({"place": pa.array(places, pa.int64())})

    return look_up


def find_token(manifest: DataFrame, token: int) -> DataFrame:
    """``place`` of every occurrence of a token, by rank and select in each shard."""
    n = max(1, manifest.count())
    return manifest.select("path", "start").repartition(n, "path").mapInArrow(_look_up(token), "place long")


def op10_wavelet_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_documents(write_shards(docs, public_tokenizers.path("byte_bpe_50k.json"))).withColumnRenamed("id", "doc_id")


SQL: dict[str, str] = {}
