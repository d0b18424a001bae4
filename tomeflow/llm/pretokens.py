"""Cached encoding of texts cut at their word spaces.

Under the common byte-level pattern a space between two characters that are not
white space always opens a pre-token, so the text on either side of it can be
encoded alone.  Texts are cut there by Arrow's kernels, the distinct pieces of some
texts looked up or encoded once, and the ids of all pieces gathered by Arrow; the
piece table of a worker is bounded: a full one keeps what the last texts hold.
A text with any other space (doubled, at an end, beside a line break) is encoded
whole, so the library's own pattern decides.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The split pattern for which cutting at word spaces is right (a fixed value of the vocabulary files).
WORD_SPACE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

LATIN_END = 0x250

ENTRIES = 500_000
PIECE_CHARS = 48
GROUP_BYTES = 16_000_000


#: What a piece has that is empty or holds white space, control characters or characters from U+0250 on.
_NOT_EASY = r"^$|[\x00-\x20\x7f-\xa0]|[^\x00-\x{24f}]"


def latin_pattern() -> re.Pattern:
    """The split pattern for texts below U+0250, its classes spelt out for the standard library's faster engine."""
    import regex

    def members(kind: str) -> str:
        return "".join(map(re.escape, regex.findall(kind, "".join(map(chr, range(LATIN_END))))))

    letter, number, space = (members(x) for x in (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


def is_plain(piece: str) -> bool:
    """Whether both ends of a piece are characters other than white space (str.isspace covers more than the pattern's)."""
    return piece != "" and not piece[0].isspace() and not piece[-1].isspace()


def as_lines(strings: list[str], plain: int = 0) -> tuple[list[int], str, list[int]]:
    """Strings that can be lines of one text: their places, the text, and how many lines each has.

    The first ``plain`` strings are a space and a plain piece each.

    In that text every line break is a pre-token of its own: no other white space is beside it but
    the one space that a line may begin with.
    """
    at = [*range(plain)]
    at += [k for k, s in enumerate(strings[plain:], plain) if not s[-1].isspace() and not (s[1] if s[0] == " " and len(s) > 1 else s[0]).isspace()]
    chosen = [strings[k] for k in at]
    text = "\n".join(chosen)
    odd = "\n\n" in text or "\n \n" in text or not text.isascii() or "\t" in text or "\r" in text or "\v" in text or "\f" in text
    if odd and _ODD_BREAK.search(text):
        at = [k for k in at if not _ODD_BREAK.search(strings[k])]
        chosen = [strings[k] for k in at]
        text = "\n".join(chosen)
    return at, text, [s.count("\n") + 1 for s in chosen]


#: White space beside a line break, but for one space before a word.
_ODD_BREAK = re.compile(r"\s\n|\n[^\S ]|\n \s")


def split_lines(at: list[int], counts: list[int], ids: np.ndarray, line_break: int) -> dict[int, bytes] | None:
    """The ids of each string, given those of the text of all lines; None if the breaks do not add up."""
    ends = np.flatnonzero(ids == line_break)
    if len(ends) != sum(counts) - 1:
        return None
    raw, width = ids.tobytes(), ids.dtype.itemsize
    last = np.cumsum(counts)[:-1] - 1
    stops = [*(ends[last] * width).tolist(), len(raw)]
    begins = [0, *(stop + width for stop in stops[:-1])]
    return {k: raw[b:e] for k, b, e in zip(at, begins, stops)}


def grouped(batches: Iterator[pa.RecordBatch], text: int = 1, share: int = 1) -> Iterator[list[pa.Array]]:
    """Columns of several batches together, as far as their texts are within a group of the encoder, or a share of that."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        n = batch.column(text).nbytes
        if held and size + n > GROUP_BYTES // share:
            yield [pa.concat_arrays(c) for c in zip(*(b.columns for b in held))]
            held, size = [], 0
        held.append(batch)
        size += n
    if held:
        yield [pa.concat_arrays(c) for c in zip(*(b.columns for b in held))]


def joined(strings: pa.Array, by: str) -> bytes:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(strings)], pa.int32()), strings), by)[0].as_buffer().to_pybytes()


def binaries(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Binary values that lie side by side in ``data``, parted at ``edges``."""
    offsets = np.ascontiguousarray(edges, np.int64) * data.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


class Table:
    """Strings and a value of each (the bytes of their ids), a share of ``ENTRIES`` at most; a full table keeps what was used last."""

    def __init__(self, kind: pa.DataType = pa.large_binary(), share: int = 1):
        self.keys, self.values, self.share = pa.array([], pa.string()), pa.array([], kind), share

    def find(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The entry of each of distinct strings, and which ones lack; those count on from the table's end."""
        place = pc.index_in(strings, value_set=self.keys)
        lacking = np.flatnonzero(place.is_null().to_numpy(zero_copy_only=False))
        entry = place.fill_null(0).to_numpy().astype(np.int64)
        entry[lacking] = len(self.keys) + np.arange(len(lacking))
        return entry, lacking

    def add(self, used: np.ndarray, strings: pa.Array, values: pa.Array) -> None:
        """``used`` marks the entries that the last texts hold."""
        short = pc.less_equal(pc.utf8_length(strings), PIECE_CHARS)
        strings, values = strings.filter(short), values.filter(short)
        bound = ENTRIES // self.share
        if len(self.keys) + len(strings) > bound:
            kept = pa.array(np.flatnonzero(used)[: bound // 2])
            self.keys, self.values = self.keys.take(kept), self.values.take(kept)
            strings, values = (x.slice(0, bound - len(kept)) for x in (strings, values))
        self.keys, self.values = pa.concat_arrays([self.keys, strings]), pa.concat_arrays([self.values, values])


class PieceEncoder:
    """Ids of texts through ``encode``, which gives the ids of each of a list of strings, as bytes of ``dtype``.

    Its second argument is how many of the strings, from the first on, are a space and a plain piece.
    Texts that hold one of the strings ``whole`` (tokens that reach over spaces) are encoded as they are.
    ``latin``, if given, has the ids of pieces of visible characters below U+0250, each after a space.
    """

    def __init__(self, encode: Callable[[list[str], int], list[bytes]], dtype: str, whole: tuple[str, ...] = (), latin: Callable[[pa.Array], pa.Array | None] | None = None, share: int = 1):
        self.encode, self.dtype, self.whole, self.latin = encode, np.dtype(dtype), whole, latin
        self.table = Table(share=share)

    def _group(self, texts: pa.Array) -> Iterator[np.ndarray]:
        cut = pc.split_pattern(texts, " ")
        offsets = cut.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        coded = cut.flatten().dictionary_encode()
        # Entries: the table's, then the pieces that it lacks, then the first pieces of texts.
        entry, lacking = self.table.find(coded.dictionary)
        pieces, indices, known = coded.dictionary.take(pa.array(lacking)), coded.indices.to_numpy(), len(self.table.keys)
        # The first piece of a text has no space before it: it is a string of its own.
        first = indices[offsets[:-1]]
        opening = np.unique(first)
        heads = coded.dictionary.take(pa.array(opening)).to_pylist()
        heads_at = known + len(pieces)
        at = entry[indices]
        at[offsets[:-1]] = heads_at + np.searchsorted(opening, first)
        used = np.zeros(heads_at + len(heads), bool)
        used[at] = True
        inner = used[known:heads_at]
        easy, easy_ids = np.zeros(0, np.int64), None
        if self.latin:
            easy = np.flatnonzero(inner & ~pc.match_substring_regex(pieces, _NOT_EASY).to_numpy(zero_copy_only=False))
            easy_ids = self.latin(pieces.take(pa.array(easy))) if len(easy) else None
        if easy_ids is None:
            easy, easy_ids = np.zeros(0, np.int64), pa.array([], pa.large_binary())
        hard = inner.copy()
        hard[easy] = False
        hard = np.flatnonzero(hard)
        strings = pieces.take(pa.array(hard)).to_pylist()
        # Pieces that are not plain make their texts odd; of a head only the end matters, and an empty one is no piece at all.
        odd = [known + k for k, x in zip(hard.tolist(), strings) if not (x.isalpha() or is_plain(x))]
        odd += [heads_at + k for k, h in enumerate(heads) if h and h[-1].isspace()]
        strange = np.zeros(len(used), bool)
        strange[odd] = True
        is_odd = np.add.reduceat(strange[at], offsets[:-1]) > 0 if odd else np.zeros(len(texts), bool)
        for string in self.whole:
            is_odd = is_odd | pc.match_substring(texts, string).to_numpy(zero_copy_only=False)
        plain = ~strange[known + hard]
        strings, hard = [" " + x for x, p in zip(strings, plain) if p], hard[plain]
        wanted = [k for k, h in enumerate(heads) if h and not strange[heads_at + k]]
        whole = texts.filter(pa.array(is_odd)).to_pylist() if is_odd.any() else []
        ids = self.encode(strings + [heads[k] for k in wanted] + whole, len(strings))
        rest = iter(ids[len(ids) - len(whole) :])
        # Values: the table's, those of this group's pieces and heads, and an empty one for all else.
        values = pa.concat_arrays([self.table.values, easy_ids, pa.array([*ids[: len(ids) - len(whole)], b""], pa.large_binary())])
        value = np.full(len(used), len(values) - 1)
        value[:known] = np.arange(known)
        encoded = np.concatenate((easy, hard, len(pieces) + np.array(wanted, np.int64)))
        value[known + encoded] = known + np.arange(len(encoded))
        gathered = values.take(pa.array(value[at]))
        out = np.frombuffer(gathered.buffers()[2] or b"", self.dtype)
        edge = np.frombuffer(gathered.buffers()[1], np.int64, len(at) + 1)[offsets] // self.dtype.itemsize
        new = encoded[: len(easy) + len(hard)]
        self.table.add(used[:known], pieces.take(pa.array(new)), values.slice(known, len(new)))
        for k in range(len(texts)):
            yield np.frombuffer(next(rest), self.dtype) if is_odd[k] else out[edge[k] : edge[k + 1]]

    def many(self, texts: pa.Array | list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, null as empty, worked off in groups of bounded size."""
        texts = pc.fill_null(texts.cast(pa.string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        group = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // GROUP_BYTES
        for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(group)) + 1) if len(texts) else ():
            yield from self._group(texts.slice(int(part[0]), len(part)))
