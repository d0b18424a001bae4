"""Substring dedup by super-k-mer partitioning.

A window is 20 consecutive words of one document.  Every window whose word sequence
starts earlier too (smaller identifier, or same document and earlier start) has its
words removed.

1. A block of documents is hashed word by word.  Windows that repeat *within* the
   block are settled there: only a window's first start in the block stays open, so
   a passage that a third of all documents hold leaves each block once.
2. Consecutive open windows that share a minimiser (the least hash of their 3-word
   runs) form a super-k-mer: its words travel once, as one packed string, to the
   bucket of the minimiser.  A block's super-k-mers for one bucket travel together,
   compressed.
3. A bucket sorts its windows.  Windows of equal hash are compared word for word (by
   64-bit word hashes, 20 of them), and all but the first start of each are listed.
4. The listed windows come back to their documents, whose covered words go.  Documents
   that lose nothing are not moved, as far as the others' identifiers can be broadcast.

A minimiser that very many texts have, each in another context, would fill a bucket.
So a pass before counts the bytes that each bucket is going to get.  Of the ``HEAVY``
fullest at most, those of more than ``HEAVY_TIMES`` the usual size are split: their windows
travel one by one, to a bucket of their whole hash.

Memory: a block holds ``BLOCK_WORDS`` words or one document; a bucket about
``BUCKET_BYTES`` of text, as the number of buckets follows the size of the input.

Defined results: a null text has no words; documents of fewer than 20 words lose
nothing; a null identifier ranks below all others; rows that repeat an identifier are
told apart by their texts' hashes, and none's start is earlier than the same start in
another, so exact repeats of a row count as one document; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.llm import shingles
from tomeflow.llm.batches import small_batches
from tomeflow.llm.joins import BROADCAST_IDS, NULL_ID, id_side, keyed
from tomeflow.workspace import Workspace

WINDOW, MINIMISER = 20, 3
BLOCK_WORDS = 1_000_000
BUCKET_BYTES = 12 << 20
HASH_BYTES = 1 << 18
HEAVY, HEAVY_TIMES = 100_000, 4


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width`` values."""
    out = x
    span = 1
    while span < width:
        step = min(span, width - span)
        out = np.minimum(out[: len(out) - step], out[step:])
        span += step
    return out


def _later_starts(h: np.ndarray, rank: np.ndarray, same) -> np.ndarray:
    """Mask of windows that an equal window precedes in ``rank``.

    ``h`` are window hashes; ``same(i, j)`` says which of the windows i and j are equal word for word.
    """
    later = np.zeros(len(h), bool)
    if not len(h):
        return later
    order = np.lexsort((rank, h))
    group = np.flatnonzero(np.diff(h[order], prepend=~h[order[0]]) != 0)  # first place of each run of equal hashes
    head = order[np.repeat(group, np.diff(group, append=len(order)))]
    todo = order != head
    i, j = order[todo], head[todo]
    equal = same(i, j)
    tie = rank[i] == rank[j]  # repeats of one row: neither is earlier
    later[i[equal & ~tie]] = True
    if not equal.all():  # two sequences share a hash: settle the others among themselves
        rest = np.sort(i[~equal])
        later[rest] = _later_starts(h[rest], rank[rest], lambda a, b: same(rest[a], rest[b]))
    return later


def _same_words(words: np.ndarray, at: np.ndarray):
    """Compares windows that start at ``words[at[i]]``."""

    def same(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        ok = np.ones(len(i), bool)
        for k in range(WINDOW):
            ok &= words[at[i] + k] == words[at[j] + k]
        return ok

    return same


@functools.lru_cache(maxsize=1)
def _zstd():
    import zstandard

    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _packed_runs(ids: np.ndarray, hashes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """``(id, text hash, runs)`` of windows given by document and start; a document's runs are one row."""
    if not len(ids):
        return
    order = np.lexsort((starts, hashes, ids))
    ids, hashes, starts = ids[order], hashes[order], starts[order]
    owner = np.concatenate(([True], (np.diff(ids) != 0) | (np.diff(hashes) != 0)))
    cut = np.flatnonzero(owner | np.concatenate(([True], np.diff(starts) != 1)))
    runs = np.stack([starts[cut], np.diff(np.append(cut, len(starts)))]).astype("<i4")
    edge = np.append(np.flatnonzero(owner[cut]), len(cut))
    for lo, hi in zip(edge[:-1], edge[1:]):
        yield int(ids[cut[lo]]), int(hashes[cut[lo]]), runs[:, lo:hi].tobytes()


def _hashed(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, begin and end of the words of all parts joined by a space, ``HASH_BYTES`` of them or one part at a time."""
    found, at, first, size = [], 0, 0, 0
    for k, part in enumerate(parts, 1):
        size += len(part) + 1
        if size >= HASH_BYTES or k == len(parts):
            h, begin, end = shingles.hashed_words(b" ".join(parts[first:k]))
            found.append((h, begin + at, end + at))
            at, first, size = at + size, k, 0
    return tuple(np.concatenate(x) for x in zip(*found))


class Block:
    """Documents held together: windows settled here, and the super-k-mers of the open ones with their buckets."""

    def __init__(self, docs: list[tuple[int, int, list[bytes]]], buckets: int):
        sizes = np.array([len(w) for *_, w in docs], np.int64)
        self.base = np.concatenate(([0], np.cumsum(sizes)))
        parts = [b" ".join(w) for *_, w in docs]
        self.text = b" ".join(parts)
        words, self.word_begin, self.word_end = _hashed(parts)
        valid = np.ones(len(words), bool)  # starts of windows that lie within one document
        for k in range(1, WINDOW):
            valid[self.base[1:] - k] = False
        starts = np.flatnonzero(valid)
        doc_of = np.searchsorted(self.base, starts, side="right") - 1
        self.ids, self.hashes = np.array([d[:2] for d in docs], np.int64).T
        local = starts - self.base[doc_of]
        rank = np.unique(self.ids, return_inverse=True)[1][doc_of].astype(np.int64) << 32 | local
        self.windows = shingles.windows(words, WINDOW)
        later = _later_starts(self.windows[starts], rank, _same_words(words, starts))
        self.settled, self.settled_at = doc_of[later], local[later]
        # Super-k-mers: runs of neighbouring open windows of one minimiser.
        least = sliding_min(shingles.windows(words, MINIMISER), WINDOW - MINIMISER + 1)[starts]
        s, m, d = starts[~later], least[~later], doc_of[~later]
        cut = np.flatnonzero(np.concatenate((np.ones(min(len(s), 1), bool), (np.diff(s) != 1) | (m[1:] != m[:-1]) | (np.diff(d) != 0))))
        self.length = np.diff(np.append(cut, len(s)))
        self.begin, self.owner = s[cut], d[cut]
        self.bucket = (shingles.mix(m[cut]) % np.uint64(buckets)).astype(np.int64)

    def split(self, heavy: np.ndarray, buckets: int, more: int) -> None:
        """Cut the super-k-mers of heavy buckets into single windows, which go to ``more`` buckets after the others."""
        full = np.isin(self.bucket, heavy)
        if not full.any():
            return
        begin, length, owner = self.begin[full], self.length[full], self.owner[full]
        at = np.repeat(begin, length) + np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        place = buckets + (shingles.mix(self.windows[at]) % np.uint64(more)).astype(np.int64)
        join = lambda kept, new: np.concatenate((kept[~full], new))
        self.begin, self.owner, self.bucket = join(self.begin, at), join(self.owner, np.repeat(owner, length)), join(self.bucket, place)
        self.length = join(self.length, np.ones(len(at), np.int64))

    def rows(self, buckets: int) -> Iterator[tuple]:
        """Packed super-k-mers by bucket, and the runs settled here by document."""
        for doc, text_hash, runs in _packed_runs(self.ids[self.settled], self.hashes[self.settled], self.settled_at):
            yield int(shingles.mix(np.array([doc]).view(np.uint64))[0] % np.uint64(buckets)), None, doc, text_hash, runs
        if not len(self.begin):
            return
        order = np.argsort(self.bucket, kind="stable")
        pack, _ = _zstd()
        begin, length, owner = self.begin, self.length, self.owner
        for part in np.split(order, np.flatnonzero(np.diff(self.bucket[order])) + 1):
            head = np.stack([self.ids[owner[part]], self.hashes[owner[part]], begin[part] - self.base[owner[part]], length[part]]).astype("<i8")
            ends = self.word_end[begin[part] + length[part] + WINDOW - 2]
            body = b"\n".join(map(self.text.__getitem__, map(slice, self.word_begin[begin[part]].tolist(), ends.tolist())))
            yield int(self.bucket[part[0]]), pack.compress(len(part).to_bytes(8, "little") + head.tobytes() + body), None, None, None

    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and the words that go to them."""
        bucket, which = np.unique(self.bucket, return_inverse=True)
        return bucket, np.bincount(which, self.length + WINDOW - 1, len(bucket)).astype(np.int64)


ROW = pa.schema([("bucket", pa.int64()), ("pack", pa.binary()), ("id", pa.int64()), ("text_hash", pa.int64()), ("runs", pa.binary())])
RUNS = pa.schema([("id", pa.int64()), ("text_hash", pa.int64()), ("runs", pa.binary())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _blocks(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[Block]:
    held: list[tuple[int, int, list[bytes]]] = []
    count = 0
    for batch in batches:
        for doc, text_hash, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            words = shingles.split_words(text.as_py(), fold=False)
            if len(words) >= WINDOW:
                held.append((doc, text_hash, words))
                count += len(words)
                if count >= BLOCK_WORDS:
                    yield Block(held, buckets)
                    held.clear()
                    count = 0
    if held:
        yield Block(held, buckets)


def _super_kmers(buckets: int, heavy: np.ndarray, more: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, buckets):
            block.split(heavy, buckets, more)
            rows, size = [], 0
            for row in block.rows(buckets):
                rows.append(row)
                size += len(row[1] or row[4])
                if size > 4 << 20:
                    yield _table(rows, ROW)
                    rows, size = [], 0
            if rows:
                yield _table(rows, ROW)

    return pack


def _bucket_sizes(buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, buckets):
            bucket, words = block.sizes()
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(bucket, pa.int64()), "words": pa.array(words, pa.int64())})

    return count


def _bucket_runs(table: pa.Table) -> pa.Table:
    """Settle one bucket: the runs of windows that start elsewhere earlier; runs settled before pass through."""
    out = [(i.as_py(), h.as_py(), r.as_py()) for i, h, r in zip(*(table.column(f.name) for f in RUNS)) if r.is_valid]
    _, unpack = _zstd()
    heads, words = [], []
    for packed in table.column("pack"):
        if packed.is_valid:
            raw = unpack.decompress(packed.as_py())
            n = int.from_bytes(raw[:8], "little")
            heads.append(np.frombuffer(raw, "<i8", 4 * n, 8).reshape(4, n))
            words.append(_hashed([raw[8 + 32 * n :]])[0])
    if heads:
        doc, text_hash, start, length = np.concatenate(heads, axis=1)
        flat = np.concatenate(words)
        base = np.cumsum(length + WINDOW - 1) - (length + WINDOW - 1)  # place of each super-k-mer's words
        step = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        at = np.repeat(base, length) + step
        local = np.repeat(start, length) + step
        rank = np.repeat(np.unique(doc, return_inverse=True)[1].astype(np.int64) << 32, length) | local
        later = _later_starts(shingles.windows(flat, WINDOW)[at], rank, _same_words(flat, at))
        out += _packed_runs(np.repeat(doc, length)[later], np.repeat(text_hash, length)[later], local[later])
    return pa.Table.from_batches([_table(out, RUNS)])


def _cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for text, runs in zip(batch.column(1), batch.column(2)):
            words = shingles.split_words(text.as_py(), fold=False)
            gone = 0
            if runs.is_valid and len(runs):
                mark = np.zeros(len(words) + 1, np.int32)
                for r in runs.as_py():
                    first, length = np.frombuffer(r, "<i4").reshape(2, -1)
                    np.add.at(mark, first, 1)
                    np.add.at(mark, first + length + WINDOW - 1, -1)
                stay = np.cumsum(mark[:-1]) == 0
                gone = int(len(words) - stay.sum())
                words = [w for w, s in zip(words, stay.tolist()) if s]
            n_words.append(len(words) + gone)
            n_removed.append(gone)
            kept.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            ["id", "n_words", "n_removed", "kept_text"],
        )


def bucket_count(docs: DataFrame, text_col: str) -> int:
    """Buckets of about BUCKET_BYTES of travelling text (three times the input's)."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(16, int(3 * size // BUCKET_BYTES) + 1)


def heavy_buckets(rows: DataFrame, buckets: int) -> tuple[np.ndarray, int]:
    """Buckets that get too many words, ``HEAVY`` at most, and how many buckets their single windows need."""
    sizes = rows.mapInArrow(_bucket_sizes(buckets), "bucket long, words long").groupBy("bucket").agg(F.sum("words").alias("words"))
    sizes = Workspace(rows.sparkSession, "buckets").stage(sizes, "sizes")
    usual = (sizes.agg(F.sum("words")).first()[0] or 0) / buckets
    full = sizes.where(F.col("words") > HEAVY_TIMES * usual).orderBy(F.desc("words"), "bucket").limit(HEAVY).collect()
    return np.array([r["bucket"] for r in full], np.int64), max(1, int(sum(r["words"] for r in full) * WINDOW // max(usual, 1)))


def repeated_runs(rows: DataFrame) -> DataFrame:
    """``id, text_hash, runs``: packed (first window, number of windows) of the windows to remove; several rows a document."""
    small_batches(rows.sparkSession)
    buckets = bucket_count(rows, "text")
    packed = rows.mapInArrow(_super_kmers(buckets, *heavy_buckets(rows, buckets)), "bucket long, pack binary, id long, text_hash long, runs binary")
    return packed.groupBy("bucket").applyInArrow(_bucket_runs, "id long, text_hash long, runs binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, n_words, n_removed, kept_text`` (kept words joined by one space)."""
    rows, _ = keyed(docs, id_col, text_col)
    ws = Workspace(docs.sparkSession, "repeats")
    runs = ws.stage(repeated_runs(rows).groupBy("id", "text_hash").agg(F.collect_list("runs").alias("runs")), "runs")
    some = ws.stage(runs.select("id").distinct(), "ids")
    if some.count() <= BROADCAST_IDS:  # only texts that lose words are sorted to their runs
        none = F.lit(None).cast("array<binary>").alias("runs")
        both = rows.join(id_side(some), "id", "left_semi").join(runs.hint("merge"), ["id", "text_hash"], "left").select("id", "text", "runs")
        both = both.unionAll(rows.join(id_side(some), "id", "left_anti").select("id", "text", none))
    else:
        both = rows.join(runs.hint("merge"), ["id", "text_hash"], "left").select("id", "text", "runs")
    out = both.mapInArrow(_cover, "id long, n_words long, n_removed long, kept_text string")
    return out.withColumn("id", F.nullif("id", F.lit(NULL_ID)))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


SQL: dict[str, str] = {
    "op5_substring_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        words AS MATERIALIZED (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
        windows AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM w WHERE len(w) >= 20),
        hashed AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM windows),
        later AS (SELECT doc_id, i FROM hashed QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1),
        covered AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
        kept AS (
            SELECT doc_id, count(*) AS n_words, count(c.i) AS n_removed,
                   coalesce(string_agg(CASE WHEN c.i IS NULL THEN word END, ' ' ORDER BY words.i), '') AS kept
            FROM words LEFT JOIN covered c USING (doc_id, i) GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents LEFT JOIN kept USING (doc_id)
    """
}
