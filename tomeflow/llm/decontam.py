"""Benchmark decontamination by template windows and slot consistency.

Words are stripped of outer punctuation and typed: a number becomes a number slot, a
unit after a number a unit slot, a capitalised word (or run of them) within a sentence
a name slot; every other word is itself, lower-cased.  Eight consecutive tokens, of
which at least four are words, are a template window; an item of fewer tokens is one
window as a whole.  Documents' windows are hash-joined with those of the benchmark.
A capitalised word that opens a sentence may be a name or not: unless it is a function
word, texts are typed in both ways, and an item is found by its windows of either.

1. Items' windows are a table: hash, place, slot values.  Documents give the hashes of
   their windows, which are hash-joined with those of the items; the items' side is
   broadcast up to a counted number of hashes, both sides are shuffled beyond.
2. An item that a document holds has at least half of its windows there, so at least one
   of its rarest half: hits on these alone make candidate pairs, which windows that very
   many items share do not.  A count of the matched windows settles the coverage.
3. Texts of documents with a covered item are read once more for the slot values of the
   matched windows.  Their hits are joined with the item's, a row for each pair, and judged.

The slots agree if the document repeats a value wherever the item repeats one (three of
four slots at least), and, the other way round, a value of the document does not stand
for many of the item (half of the slots at least, as changed values may coincide).  So a
question with other numbers and names is caught, and a sentence that happens to have the
same frame is not.  Both are judged for each occurrence by itself, that is the windows at
one distance between their places in document and item, or at distances that differ by
little; one that passes is enough.  If none does, the windows of the whole document are
judged together, for items that it holds in parts.

Memory: words are typed for a group of texts at a time, through a bounded table of words;
a pair's hits are one row, bounded by the two texts; nothing of the benchmark or
the documents is collected but the window sizes in use, ``WINDOW`` at most of each kind.

Defined results: null texts have no windows; items without any window are found by their
whole word sequence, case-folded and without outer punctuation; items without any letter
or digit cannot be found; a null or repeated document identifier is judged row by row (a
list has each item once); rows that repeat an item identifier are items of their own; an
empty table on either side gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tomeflow.llm import pretokens, shingles
from tomeflow.llm.batches import releasing, small_batches
from tomeflow.llm.joins import BROADCAST_IDS, NULL_ID, id_side, keyed
from tomeflow.workspace import Workspace

WINDOW = 8
LITERALS = 4
COVERAGE = 0.5
CONSISTENCY = 0.75
RAW = 2  # form of an item without template windows: its words as they are
RAW_SEED = 9
DRIFT = 3  # tokens put in or left out at one place of an occurrence
BACKWARD = 0.5
WORD_TABLE = 300_000
HASH_ROWS = 250_000

NUMBER, NAME, UNIT, GLUED, ENDS, SKIP, FUNCTION = 1, 2, 4, 8, 16, 32, 64
FLAG_BITS = 7
FLAGS = (1 << FLAG_BITS) - 1
_SLOT = {NUMBER: 0x1111 << FLAG_BITS, NAME: 0x2222 << FLAG_BITS, UNIT: 0x3333 << FLAG_BITS}

UNITS = frozenset(
    "% percent km m cm mm kg g mg lb lbs oz ml l cl ft in mi mph kmh km/h gb mb kb hz w kw v s ms h min "
    "mile miles meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters gram grams kilogram kilograms "
    "pound pounds ounce ounces liter liters litre litres inch inches foot feet yard yards second seconds minute minutes hour hours day days "
    "week weeks month months year years dollar dollars euro euros cent cents degree degrees".split()
)
NUMBER_WORDS = frozenset(
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
    "thirty forty fifty sixty seventy eighty ninety hundred thousand million".split()
)
FUNCTION_WORDS = frozenset(
    "a an the this that these those i you he she it we they my your his her its our their one each every all both some any no none many much most more few several other another such "
    "who whom whose which what when where why how and or but nor so yet if then than because although though while since until unless as whether "
    "of in on at by for from to with without into onto over under between among through during before after about against above below near out off up down "
    "is are was were be been am do does did has have had can could will would shall should may might must not there here now today however therefore thus also only just even".split()
)
_DIGITS = re.compile(r"[-+]?[$€£]?\d+(?:[.,:/]\d+)*%?", re.A)
_WITH_UNIT = re.compile(r"([-+]?\d+(?:[.,]\d+)*)([^\W\d_]+|%)")
_MARKS = re.compile(r"[.,;:!?'\"()\[\]{}…“”‘’«»]+")
_EDGE = re.compile(r"^[^\w$€£+%-]+|[^\w%]+$")


def _typed(word: str) -> int:
    """A word as 57 bits of hash and its flags."""
    if word.isalpha():  # most words: nothing to strip, no digits
        low = word.lower()
        if low in NUMBER_WORDS:
            return _SLOT[NUMBER] | NUMBER
        name = NAME if word[0].isupper() and (len(word) == 1 or not word[1:].isupper()) else 0
        return xxhash.xxh64_intdigest(low.encode()) >> FLAG_BITS << FLAG_BITS | name | (UNIT if low in UNITS else 0) | (FUNCTION if low in FUNCTION_WORDS else 0)
    ends = ENDS if word.rstrip("\"')]»”’*$#&")[-1:] in (".", "!", "?", ":", "…") else 0
    core = _EDGE.sub("", word)
    letters = core.isalpha()  # then neither digits nor a unit after them
    if not letters and not any(c.isalnum() or c in "%€$£" for c in core):
        return SKIP | ends
    low = core.lower()
    if low in NUMBER_WORDS or not letters and _DIGITS.fullmatch(core):
        return _SLOT[NUMBER] | NUMBER | ends
    if not letters and (m := _WITH_UNIT.fullmatch(low)) and m[2] in UNITS:
        return _SLOT[NUMBER] | NUMBER | GLUED | ends
    h = xxhash.xxh64_intdigest(low.encode()) >> FLAG_BITS << FLAG_BITS
    unit = UNIT if low in UNITS else 0
    name = NAME if core[0].isupper() and (len(core) == 1 or not core[1:].isupper()) else 0
    return h | unit | name | ends | (FUNCTION if low in FUNCTION_WORDS else 0)


class _Words(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= WORD_TABLE:
            self.clear()
        t = self[word] = _typed(word)
        return t


_WORDS = _Words()
_TYPES = pretokens.Table(pa.uint64())


Form = tuple[np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray]


def canonical(text: str | None, openings: bool = False) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """``(token hashes, slot flags, words, place of each token's word)`` of a text; ``openings``: names may open sentences."""
    return forms(text)[-1 if openings else 0][:4]


def typed_texts(texts: pa.Array, table: pretokens.Table) -> Iterator[np.ndarray]:
    """The words of each text as ``_typed`` gives them, each distinct word that the table lacks typed once."""
    split = pc.utf8_split_whitespace(pc.fill_null(texts, ""))  # as str.split() does, but for empty words at the ends
    words, offsets = split.flatten(), split.offsets.to_numpy()
    coded = words.dictionary_encode()
    entry, lacking = table.find(coded.dictionary)
    new = coded.dictionary.take(pa.array(lacking))
    values = pa.array(np.fromiter(map(_typed, new.to_pylist()), np.uint64, len(new)))
    known = table.values.to_numpy()
    used = np.zeros(len(known) + len(new), bool)
    used[entry] = True
    real = np.not_equal(pc.binary_length(words).to_numpy(), 0)
    t = np.concatenate((known, values.to_numpy()))[entry[coded.indices.to_numpy()[real]]]
    table.add(used[: len(known)], new, values)
    edges = np.concatenate(([0], np.cumsum(real)))[offsets - offsets[0]].tolist()
    return (t[b:e] for b, e in zip(edges, edges[1:]))


def forms(text: str | None, typed: np.ndarray | None = None) -> list[Form]:
    """A text with sentence openings as words and, where that differs, as names; the last array marks such names.

    With the words' types given, the text is not needed and the forms have no words.
    """
    words = (text or "").split() if typed is None else []
    t = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words)) if typed is None else typed
    at = np.arange(len(t))
    flags = t.astype(np.uint8) & np.uint8(FLAGS)
    opening = np.ones(len(t), bool)
    opening[1:] = (flags[:-1] & ENDS) > 0
    real = (flags & SKIP) == 0
    # A skipped token hands its sentence end on to the next word.
    if not real.all():
        run = np.maximum.accumulate(np.where(opening, at, -1))
        last = np.maximum.accumulate(np.where(real, at, -1))
        before = np.concatenate(([-1], last[:-1]))
        opening = run > before
        t, flags, at, opening = t[real], flags[real], at[real], opening[real]
    number = (flags & NUMBER) > 0
    slot = np.where(number, np.uint8(NUMBER), np.uint8(0))
    unit = np.flatnonzero((flags & UNIT) > 0)
    unit = unit[(unit > 0) & ~number[unit] & number[unit - 1]]
    slot[unit] = UNIT
    free = slot == 0
    doubtful = opening & ((flags & (NAME | FUNCTION)) == NAME) & free
    name = ((flags & NAME) > 0) & ~opening & free
    glued = (flags & GLUED) > 0
    h = t & ~np.uint64(FLAGS)
    h[number], h[unit] = _SLOT[NUMBER], _SLOT[UNIT]
    parts = (words, at, opening, doubtful, glued if glued.any() else None)
    first = _with_names(h, slot, name, *parts)
    return [first, _with_names(h, slot, name | doubtful, *parts)] if doubtful.any() else [first]


def _with_names(h: np.ndarray, slot: np.ndarray, name: np.ndarray, words: list[str], at: np.ndarray, opening: np.ndarray, doubtful: np.ndarray, glued: np.ndarray | None) -> Form:
    """The form in which ``name`` marks the names."""
    h, slot = np.where(name, np.uint64(_SLOT[NAME]), h), np.where(name, np.uint8(NAME), slot)
    keep = np.ones(len(h), bool)
    keep[1:] = ~(name[1:] & name[:-1] & ~opening[1:])  # a run of names in a sentence is one slot
    if glued is not None:
        again = 1 + glued
        first = np.repeat(np.cumsum(again) - again, again)
        second = np.arange(int(again.sum())) > first
        h, slot, at, keep, doubtful = (np.repeat(x, again) for x in (h, slot, at, keep, doubtful))
        h[second], slot[second] = _SLOT[UNIT], UNIT
    return h[keep], slot[keep], words, at[keep], doubtful[keep]


def template_windows(h: np.ndarray, slot: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(starts, hashes)`` of the windows of ``size`` tokens that hold enough words."""
    if len(h) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.concatenate(([0], np.cumsum(slot == 0)))
    starts = np.flatnonzero(total[size:] - total[:-size] >= min(LITERALS, size))
    return starts, shingles.windows(h, size)[starts]


def slot_values(slot: np.ndarray, words: list[str], at: np.ndarray, start: int, size: int) -> list[str]:
    """Values of the slots of a window; a run of names is its words up to the next token."""
    out = []
    for k in range(start, start + size):
        if slot[k]:
            stop = at[k + 1] if slot[k] == NAME and k + 1 < len(at) else at[k] + 1
            run = [_EDGE.sub("", w).lower() for w in words[at[k] : max(stop, at[k] + 1)]]
            value = " ".join(w for w in run if w)
            if slot[k] != NAME and (m := _WITH_UNIT.fullmatch(value)):
                value = m[1 if slot[k] == NUMBER else 2]
            out.append(f"{slot[k]}{value}")
    return out


def window_size(tokens: int) -> int:
    return min(WINDOW, tokens)


def raw_hashes(text: str | None) -> np.ndarray:
    """Hashes of all words but marks of a sentence, case-folded and without outer punctuation; never those of template tokens."""
    words = [w for w in (text or "").split() if not _MARKS.fullmatch(w)]
    return np.fromiter((xxhash.xxh64_intdigest((_EDGE.sub("", w) or w).casefold().encode(), RAW_SEED) for w in words), np.uint64, len(words))


def item_windows(text: str | None) -> Iterator[tuple[int, int, list[tuple[int, int, list[str]]]]]:
    """``(form, size, [(hash, place, slot values)])`` for each form of an item that has windows."""
    found = False
    for form, (h, slot, words, at, _) in enumerate(forms(text)):
        if size := window_size(len(h)):
            starts, hashes = template_windows(h, slot, size)
            if len(starts):
                found = True
                yield form, size, [(int(x), int(s), slot_values(slot, words, at, s, size)) for s, x in zip(starts, hashes)]
    if not found and any(c.isalnum() for c in text or ""):
        h = raw_hashes(text)
        size = window_size(len(h))
        yield RAW, size, [(int(x), s, []) for s, x in enumerate(shingles.windows(h, size))]


def document_windows(text: str | None, sizes: list[int], raw_sizes: list[int], typed: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, Callable[[int], list[str]]]]:
    """``(size, places, hashes, values of the k-th)`` of a document; of the second form only the windows that differ."""
    places = None
    for h, slot, words, at, doubtful in forms(text, typed):
        for size in sizes:
            starts, hashes = template_windows(h, slot, size)
            place = starts
            if places is None:
                pass
            elif len(starts):
                total = np.concatenate(([0], np.cumsum(doubtful)))
                differs = total[starts + size] > total[starts]
                starts, hashes = starts[differs], hashes[differs]
                place = np.searchsorted(places, at[starts])  # as counted in the first form
            yield size, place, hashes, lambda k, s=starts, z=size, v=(slot, words, at): slot_values(*v, s[k], z)
        places = at if places is None else places
    if raw_sizes:
        raw = raw_hashes(text)
        for size in raw_sizes:
            hashes = shingles.windows(raw, size)
            yield size, np.arange(len(hashes)), hashes, lambda k: []


def consistent(pairs: Counter) -> tuple[bool, bool]:
    """Whether slots agree, and whether any value differs; ``pairs`` counts (item value, document value)."""
    total = sum(pairs.values())
    if not total:
        return True, False
    forward: dict[str, Counter] = defaultdict(Counter)
    backward: dict[str, Counter] = defaultdict(Counter)
    for (mine, theirs), n in pairs.items():
        forward[mine][theirs] += n
        backward[theirs][mine] += n
    one, other = (sum(c.most_common(1)[0][1] for c in way.values()) for way in (forward, backward))
    return one >= CONSISTENCY * total and other >= BACKWARD * total, any(a != b for a, b in pairs)


def judge(hits: list[tuple[int, int, list[str], list[str]]], total: int, exact: bool = False) -> tuple[float, bool] | None:
    """``(coverage, re-parameterised)`` of an item that a document holds; hits are (place in document, place in item, item's values, document's values)."""

    def passes(part: list[int]) -> tuple[float, bool] | None:
        coverage = len({hits[k][1] for k in part}) / total
        if coverage < (1 if exact else COVERAGE):
            return None
        # A window that comes with the item's own values and, typed the other way, with others has the former.
        same = {hits[k][1] for k in part if hits[k][2] == hits[k][3]}
        pairs: Counter = Counter()
        for k in part:
            if hits[k][1] not in same or hits[k][2] == hits[k][3]:
                pairs.update(zip(hits[k][2], hits[k][3]))
        agrees, changed = consistent(pairs)
        return (coverage, changed) if agrees else None

    order = sorted(range(len(hits)), key=lambda k: hits[k][0] - hits[k][1])
    near: list[list[list[int]]] = []  # distances that differ by little, and the hits of each
    last = None
    for k in order:
        distance = hits[k][0] - hits[k][1]
        if last is None or distance - last > DRIFT:
            near.append([[]])
        elif distance != last:
            near[-1].append([])
        near[-1][-1].append(k)
        last = distance
    found = []
    for group in near:
        if not exact and (x := passes([k for part in group for k in part])):
            found.append(x)
        else:
            found += [x for part in group if (x := passes(part))]
    if not found and not exact and (x := passes(order)):
        found = [x]
    return (max(c for c, _ in found), any(x for _, x in found)) if found else None


FOUND = "id long, item_ids array<long>, coverage double, reparameterised boolean"
_strings = pa.list_(pa.string())
_ITEM = pa.schema([("entry", pa.int64()), ("item", pa.int64()), ("size", pa.int64()), ("exact", pa.bool_()), ("total", pa.int64()), ("hash", pa.int64()), ("at", pa.int64()), ("mine", _strings)])
ITEM_ROW = "entry long, item long, size long, exact boolean, total long, hash long, at long, mine array<string>"
_SLOTS = pa.schema([("id", pa.int64()), ("text_hash", pa.int64()), ("hash", pa.int64()), ("place", pa.int64()), ("theirs", _strings)])
SLOT_ROW = "id long, text_hash long, hash long, place long, theirs array<string>"


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(hashes).view(np.int64))


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of items; each form of an item is an entry, which is judged by itself."""
    for batch in batches:
        out = []
        for key, item, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            for form, size, found in item_windows(text):
                head = {"entry": 3 * key + form, "item": item, "size": size, "exact": form == RAW, "total": len(found)}
                out += [{**head, "hash": int(np.uint64(x).astype(np.int64)), "at": s, "mine": values} for x, s, values in found]
        yield pa.RecordBatch.from_pylist(out, _ITEM)


def _hash_rows(sizes: list[int], raw_sizes: list[int]):
    """Window hashes of documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, text_hashes, texts in pretokens.grouped(batches, 2, share=4):
            owner, found, n = [], [], 0
            for k, typed in enumerate(typed_texts(texts, _TYPES)):
                hashes = [h for _, _, h, _ in document_windows(texts[k].as_py() if raw_sizes else None, sizes, raw_sizes, typed)]
                found += hashes
                owner.append(np.full(sum(map(len, hashes)), k))
                n += len(owner[-1])
                if n and (n >= HASH_ROWS or k == len(texts) - 1):
                    at = pa.array(np.concatenate(owner))
                    yield pa.RecordBatch.from_arrays([ids.take(at), text_hashes.take(at), _signed(np.concatenate(found))], ["id", "text_hash", "hash"])
                    owner, found, n = [], [], 0

    return rows


def _slot_rows(sizes: list[int], raw_sizes: list[int]):
    """Places and slot values of the matched windows of documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text_hash, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                wanted = np.array(wanted.as_py(), np.int64).view(np.uint64)
                for _, places, hashes, values in document_windows(text.as_py(), sizes, raw_sizes):
                    hit = np.flatnonzero(np.isin(hashes, wanted))
                    n = len(hit)
                    if n:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([doc] * n, pa.int64()), pa.array([text_hash] * n, pa.int64()), _signed(hashes[hit]), pa.array(places[hit], pa.int64()), pa.array([values(k) for k in hit.tolist()], _strings)],
                            schema=_SLOTS,
                        )

    return rows


def _judge_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("id", pa.int64()), ("text_hash", pa.int64()), ("item", pa.int64()), ("coverage", pa.float64()), ("changed", pa.bool_())])
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            hits = [(h["place"], h["at"], h["mine"], h["theirs"]) for h in r["hits"]]
            if held := judge(hits, r["total"], r["exact"]):
                out.append({"id": r["id"], "text_hash": r["text_hash"], "item": r["item"], "coverage": held[0], "changed": held[1]})
        yield pa.RecordBatch.from_pylist(out, schema)


def _held(ws: Workspace, rows: DataFrame, benchmark: DataFrame, item_col: str, text_col: str, broadcast_hashes: int) -> DataFrame:
    """``id, text_hash, item_ids, coverage, reparameterised`` of the documents ``rows`` (``id, text_hash, text``) that hold an item."""
    items = benchmark.select(F.monotonically_increasing_id().alias("entry"), F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    items = ws.stage(items.mapInArrow(_item_rows, ITEM_ROW), "items")
    used = items.groupBy("exact").agg(F.sort_array(F.collect_set("size")).alias("sizes")).collect()  # WINDOW sizes at most of either kind
    sizes, raw_sizes = ([x for r in used if r["exact"] is kind for x in r["sizes"]] for kind in (False, True))
    known = ws.stage(items.select("hash").distinct(), "item-hashes")
    hits = ws.stage(rows.mapInArrow(releasing(_hash_rows(sizes, raw_sizes)), "id long, text_hash long, hash long").join(id_side(known, broadcast_hashes), "hash", "left_semi").distinct(), "hits")

    # An item's rarest windows: one more than it may lack.
    need = F.when(F.col("exact"), F.col("total")).otherwise(F.ceil(F.lit(COVERAGE) * F.col("total")))
    rank = F.row_number().over(Window.partitionBy("entry").orderBy("entries", "hash", "at"))
    rarest = items.join(items.groupBy("hash").agg(F.count_distinct("entry").alias("entries")), "hash").withColumn("rank", rank).where(F.col("rank") <= F.col("total") - need + 1)
    candidates = ws.stage(hits.join(rarest.select("hash", "entry").distinct(), "hash").select("id", "text_hash", "entry").distinct(), "candidates")
    windows = candidates.join(items.select("entry", "exact", "total", "hash", "at"), "entry").join(hits, ["id", "text_hash", "hash"])
    covered = windows.groupBy("id", "text_hash", "entry", "exact", "total").agg(F.count_distinct("at").alias("places")).where(F.col("places") >= need)
    covered = ws.stage(covered.select("id", "text_hash", "entry"), "covered")

    some = ws.stage(covered.select("id").distinct(), "held-ids")
    texts = ws.stage(rows.join(id_side(some), "id", "left_semi").distinct(), "held-texts")
    # A document's matched windows: as many as its text has at most.
    wanted = covered.join(items.select("entry", "hash"), "entry").select("id", "text_hash", "hash").distinct().join(hits, ["id", "text_hash", "hash"], "left_semi")
    wanted = wanted.groupBy("id", "text_hash").agg(F.collect_list("hash").alias("wanted"))
    slots = ws.stage(texts.join(wanted.hint("merge"), ["id", "text_hash"]).select("id", "text_hash", "text", "wanted").mapInArrow(releasing(_slot_rows(sizes, raw_sizes)), SLOT_ROW), "slots")
    pairs = (
        covered.join(items, "entry")
        .join(slots, ["id", "text_hash", "hash"])
        .groupBy("id", "text_hash", "entry", "item", "total", "exact")
        .agg(F.collect_list(F.struct("place", "at", "mine", "theirs")).alias("hits"))
    )
    judged = pairs.mapInArrow(_judge_pairs, "id long, text_hash long, item long, coverage double, changed boolean")
    return ws.stage(
        judged.groupBy("id", "text_hash").agg(F.array_sort(F.collect_set("item")).alias("item_ids"), F.max("coverage").alias("coverage"), F.bool_or("changed").alias("reparameterised")), "held"
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    broadcast_hashes: int = BROADCAST_IDS,
) -> DataFrame:
    """One row per document that holds an item: ``id, item_ids, coverage`` (largest), ``reparameterised`` (any item with other values)."""
    small_batches(docs.sparkSession)
    rows, unique = keyed(docs, id_col, text_col)
    held = _held(Workspace(docs.sparkSession, "decontamination"), rows, benchmark, item_col, item_text_col, broadcast_hashes)
    if not unique:  # a row for each of the rows that repeat an identifier
        held = rows.select("id", "text_hash").join(held.hint("merge"), ["id", "text_hash"])
    return held.select(F.nullif("id", F.lit(NULL_ID)).alias("id"), "item_ids", "coverage", "reparameterised")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", broadcast_hashes: int = BROADCAST_IDS) -> DataFrame:
    """``docs`` without the documents that hold an item; columns unchanged."""
    small_batches(docs.sparkSession)
    rows, unique = keyed(docs, id_col, text_col)
    held = _held(Workspace(docs.sparkSession, "contaminated"), rows, benchmark, item_col, "text", broadcast_hashes)
    own = F.coalesce(docs[id_col].cast("long"), F.lit(NULL_ID))
    if unique:
        return docs.join(id_side(held.select(F.col("id").alias("_tf_id"))), own == F.col("_tf_id"), "left_anti")
    lost = held.select(F.col("id").alias("_tf_id"), F.col("text_hash").alias("_tf_hash")).hint("merge")
    return docs.join(lost, (own == F.col("_tf_id")) & (F.xxhash64(docs[text_col]) == F.col("_tf_hash")), "left_anti")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated(docs, benchmark).withColumnRenamed("id", "doc_id")


SQL: dict[str, str] = {}
