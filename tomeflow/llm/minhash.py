"""Near-dedup: one-permutation MinHash with optimal densification, bands, star-shaped candidates.

1. One pass over the texts gives each document its shingle set's size and 128-bit
   digest, and 25 band keys of a one-permutation sketch of 125 bins.  An empty bin
   borrows from the first filled bin in a random order of its own (optimal
   densification), so small sets are sketched as well as large ones.
2. Documents of equal sets are one class; only its representative goes on.
3. A bucket is the set of representatives that share a band key.  Its candidates are
   a star: the member that shares most buckets with others, most often the original, is
   the centre and is compared with every other member.  Links merge components.
4. Members of one centre that are in different components by then may still be similar
   to each other.  Each is described by its difference from the centre, the shingles that
   one of the two has and the other lacks.  Two sets are similar if their differences
   from each other are at most 15/185 of their sizes' sum; of such a pair at least one is
   not similar to the centre, which bounds from below how many elements their differences
   *from the centre* share: about half of the smaller one.  So differences are dealt by
   prefix filtering, rarest elements among the members outside the centre's component
   first, and a match counts only if enough elements follow it on both sides.  Copies
   that differ from the original each in their own way share too little to meet.
   First each element's members meet its largest difference (another star), then what
   is still in different components meets pair by pair.
5. Every candidate is confirmed on the full shingle sets of the whole texts.

So a bucket of n near copies costs about n pairs, not n^2, and no pair of a bucket goes
unjudged unless its ends are connected already or their sets cannot be similar.  With 5
rows and 25 bands, a pair at the least similarity misses all buckets with a probability
of 4e-7; there are no caps.  Grouped steps are plain aggregates and equi-joins of
written tables (map-side combined, split by adaptive execution), so a group of any size
spreads over tasks.

Defined results: a null or wordless text has no shingles and no links; rows that
repeat an identifier are one document; a null identifier ranks below all others; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.llm import shingles
from tomeflow.llm.batches import releasing, small_batches
from tomeflow.llm.joins import id_side
from tomeflow.operators.components import connected_components
from tomeflow.workspace import Workspace

ROWS, BANDS = 5, 25
BINS = ROWS * BANDS
NULL_ID = -(1 << 63)

_rng = np.random.default_rng(77)
#: RANK[j, b] is the place of bin b in the order in which the empty bin j looks for a filled one.
RANK = np.argsort(_rng.random((BINS, BINS)), axis=1).argsort(axis=1)
_BAND_ODD = _rng.integers(1 << 62, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_SALT = _rng.integers(0, 1 << 63, BANDS, dtype=np.uint64)


def sketch(shingle_set: np.ndarray) -> np.ndarray:
    """One value for each bin; ``shingle_set`` is sorted and not empty."""
    bins = ((shingle_set >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    first = np.flatnonzero(np.diff(bins, prepend=np.uint64(BINS)) != 0)  # the least hash of each filled bin
    filled = bins[first].astype(np.int64)
    out = np.zeros(BINS, np.uint64)
    out[filled] = shingle_set[first]
    if len(filled) < BINS:
        empty = np.setdiff1d(np.arange(BINS), filled, assume_unique=True)
        out[empty] = out[filled[RANK[np.ix_(empty, filled)].argmin(axis=1)]]
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    return shingles.mix((values.reshape(BANDS, ROWS) * _BAND_ODD).sum(axis=1, dtype=np.uint64) + _BAND_SALT).view(np.int64)


def set_digest(shingle_set: np.ndarray) -> tuple[int, int]:
    """128 bits that do not depend on order."""
    a = shingles.mix(shingle_set).sum(dtype=np.uint64)
    b = shingles.mix(shingle_set ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, d1, d2, keys = [], [], [], []
        for value in batch.column(1):
            s = shingles.shingle_set(value.as_py())
            n.append(len(s))
            a, b = set_digest(s) if len(s) else (0, 0)
            d1.append(a)
            d2.append(b)
            keys.append(band_keys(sketch(s)) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
            ["id", "n", "d1", "d2", "keys"],
        )


def similar(a: np.ndarray, b: np.ndarray, both: int, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union."""
    return 100 * both >= percent * (len(a) + len(b) - both)


JUDGED = "centre long, member long, n long, cc long, cm long, ok boolean, nc long, apart array<long>"


def _judge(percent: int):
    """Compare pairs; of members of larger buckets also list the shingles that only one of centre and member has."""
    names = [c.split()[0] for c in JUDGED.split(", ")]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: dict[int, np.ndarray] = {}

        def of(key: int, text: pa.Scalar) -> np.ndarray:
            if key not in recent:
                if len(recent) >= 16:
                    recent.clear()
                recent[key] = shingles.shingle_set(text.as_py())
            return recent[key]

        for batch in batches:
            ok, apart, size = [], [], []
            for c, m, more, tc, tm in zip(*(batch.column(k).to_pylist() for k in (0, 1, 5)), batch.column(6), batch.column(7)):
                a, b = of(c, tc), of(m, tm)
                if more:
                    differ = np.setxor1d(a, b, assume_unique=True)
                    both = (len(a) + len(b) - len(differ)) // 2
                else:
                    both = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(similar(a, b, both, percent))
                size.append(len(a))
                apart.append(differ.view(np.int64) if more else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(ok, pa.bool_()), pa.array(size, pa.int64()), pa.array(apart, pa.list_(pa.int64()))], names)

    return judge


def _features(docs: DataFrame, id_col: str, text_col: str, ws: Workspace) -> DataFrame:
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))
    return ws.stage(
        docs.select(key.alias("id"), F.col(text_col).alias("text")).mapInArrow(
            releasing(_sketches, shingles.forget_words), "id long, n long, d1 long, d2 long, keys array<long>"
        ),
        "sketches",
    )


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """One row per input row: ``id, n_shingles, component_id`` (least identifier reachable), ``kept``."""
    small_batches(docs.sparkSession)
    ws = Workspace(docs.sparkSession, "minhash")
    features = _features(docs, id_col, text_col, ws)
    some = features.where("n > 0")
    classes = ws.stage(some.groupBy("d1", "d2", "n").agg(F.min("id").alias("rep"), F.count("*").alias("rows")).where("rows > 1").drop("rows"), "classes")
    rep = F.coalesce("rep", "id")
    members = ws.stage(
        some.join(classes, ["d1", "d2", "n"], "left").select("id", "n", rep.alias("rep"), F.when(F.col("id") == rep, F.col("keys")).alias("keys")), "members"
    )
    exploded = members.where("keys is not null").select("rep", "n", F.explode("keys").alias("key"))
    shared = ws.stage(exploded.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"), "shared")
    live = ws.stage(exploded.join(shared, "key").select("key", "rep", "n", "c"), "shared-rows")
    # A member's weight is how many others its buckets hold: the original of a family shares most.
    weights = ws.stage(live.groupBy("rep").agg(F.sum("c").alias("weight")), "weights")
    live = ws.stage(live.join(weights, "rep").select("key", "rep", "n", "weight", F.col("rep").alias("comp")), "buckets")
    reps = ws.stage(weights.select("rep"), "candidates")
    texts = ws.stage(
        docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("rep"), F.col(text_col).alias("text"))
        .where("text is not null")
        .join(id_side(reps), "rep", "left_semi"),
        "candidate-texts",
    )
    # Rows that repeat an identifier with another text are one document: their classes are linked beforehand.
    spread = members.groupBy("id").agg(F.min("rep").alias("src"), F.max("rep").alias("top")).where("src <> top").select("id", "src")
    same = ws.stage(members.join(spread, "id").select("src", F.col("rep").alias("dst")).distinct(), "repeated")
    labels = ws.stage(reps.unionAll(same.select("dst")).distinct().select("rep", F.col("rep").alias("comp")), "labels")
    if not same.isEmpty():
        labels = _relabel(ws, labels, same)
        live = live.drop("comp").join(labels, "rep")
    found = ws.stage(_compare(_stars(ws, live), texts, percent), "stars")
    labels = _merge(ws, labels, found)
    family = ws.stage(found.where("apart is not null").select("centre", "member", "n", "nc", "apart"), "families")
    prefixes = _prefixes(ws, family, labels, percent)
    if not prefixes.isEmpty():
        found = ws.stage(_compare(_element_stars(ws, prefixes, percent), texts, percent), "rest")
        merged = _merge(ws, labels, found)
        if merged is not labels:  # prefixes hold for any components that are unions of those they were taken under
            labels = merged
            prefixes = ws.stage(prefixes.drop("comp").join(labels.withColumnRenamed("rep", "member"), "member"), "prefixes-again")
        found = ws.stage(_compare(_element_pairs(ws, prefixes, percent), texts, percent), "rest")
        labels = _merge(ws, labels, found)
    final = members.groupBy("id").agg(F.min("rep").alias("rep")).join(labels, "rep", "left")
    out = features.select("id", "n").join(final.select("id", F.coalesce("comp", "rep").alias("comp")), "id", "left")
    plain = lambda c: F.nullif(c, F.lit(NULL_ID))
    component = F.coalesce("comp", "id")
    return out.select(
        plain(F.col("id")).alias("id"),
        F.col("n").alias("n_shingles"),
        plain(component).alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )


def _stars(ws: Workspace, live: DataFrame) -> DataFrame:
    """Pairs of the centre and each other member of every bucket; ``more`` where the bucket has others."""
    centre = F.max(F.struct("weight", (F.lit(-1) - F.col("rep")).alias("least"), "rep", "comp")).alias("c")
    centres = live.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"), centre)
    centres = ws.stage(centres.where("lo <> hi").select("key", "size", "c"), "centres")
    star = live.join(centres, "key").where(F.col("rep") != F.col("c.rep"))
    pairs = star.select(F.col("c.rep").alias("centre"), F.col("rep").alias("member"), "n", F.col("c.comp").alias("cc"), F.col("comp").alias("cm"), (F.col("size") > 2).alias("more"))
    return ws.stage(pairs.groupBy("centre", "member").agg(*[F.max(c).alias(c) for c in ("n", "cc", "cm", "more")]), "star-pairs")


def _compare(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    one, two = texts.select(F.col("rep").alias("centre"), F.col("text").alias("tc")), texts.select(F.col("rep").alias("member"), F.col("text").alias("tm"))
    # Pairs grow with the corpus: they are sorted to their texts at any size, never broadcast.
    both = pairs.join(one.hint("merge"), "centre").join(two.hint("merge"), "member").select("centre", "member", "n", "cc", "cm", "more", "tc", "tm")
    return both.mapInArrow(releasing(_judge(percent), shingles.forget_words), JUDGED)


def _prefixes(ws: Workspace, family: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """First elements of the members' differences from their centre, where a member is outside the centre's component.

    ``d`` is the size of a member's difference, ``pos`` an element's place in it, ``out`` whether the
    member is outside, and ``short`` the prefix that suffices to meet a member outside.  Elements that a
    single member has take their places, but are no rows: nothing meets there.
    """
    # Similar: |A ^ B| (100 + percent) <= (100 - percent) (|A| + |B|).
    whole, loose = 100 + percent, 100 - percent
    home = labels.select(F.col("rep").alias("centre"), F.col("comp").alias("home"))
    placed = family.join(labels.withColumnRenamed("rep", "member"), "member").join(home, "centre")
    mixed = placed.where("comp <> home").select("centre").distinct()
    placed = ws.stage(
        placed.join(mixed, "centre", "left_semi").select("centre", "member", "n", "nc", "comp", (F.col("comp") != F.col("home")).alias("out"), F.size("apart").cast("long").alias("d"), "apart"), "placed"
    )
    elements = placed.select("centre", "member", "n", "nc", "comp", "out", "d", F.explode("apart").alias("token"))
    counts = ws.stage(elements.groupBy("centre", "token").agg(F.count_if("out").alias("k"), (F.count("*") > 1).alias("met")).where("k > 0"), "elements")
    # One member's elements are one row: as many as its text and the centre's have shingles at most.
    ordered = elements.join(counts, ["centre", "token"]).groupBy("centre", "member", "n", "nc", "comp", "out", "d").agg(F.array_sort(F.collect_list(F.struct("k", "token", "met"))).alias("t"))
    # A member shares at least ``least`` elements with one outside, and the latter ``fewest`` with any.
    least = F.ceil((whole * F.col("d") + loose * (F.col("nc") - F.col("n")) + 1) / (2 * whole))
    fewest = F.greatest(F.lit(1), F.ceil((whole * F.col("d") - loose * (F.col("n") + F.col("nc"))) / (whole + loose)))
    none = F.col("d") - F.size("t")  # elements that no member outside has come first
    short = F.col("d") - least + 1
    length = F.when(F.col("out"), F.col("d") - fewest + 1).otherwise(short) - none
    first = ordered.select("centre", "member", "n", "comp", "out", "d", short.alias("short"), none.alias("none"), F.slice("t", F.lit(1), F.greatest(length, F.lit(0)).cast("int")).alias("t"))
    placed_first = F.transform("t", lambda e, i: F.struct(e["token"].alias("token"), e["met"].alias("met"), (F.col("none") + i).alias("pos")))
    first = first.select("centre", "member", "n", "comp", "out", "d", "short", F.explode(F.filter(placed_first, lambda e: e["met"])).alias("e"))
    return ws.stage(first.select("centre", F.col("e.token").alias("token"), "member", "n", "comp", "out", "d", "short", F.col("e.pos").alias("pos")), "prefixes")


def _may_be_similar(a: str, b: str, percent: int) -> Column:
    """Whether rows ``a`` and ``b`` of one element, the first that they share, leave room for the similarity."""
    of = lambda side, c: F.col(f"{side}.{c}")
    n = of(a, "n") + of(b, "n")
    overlap = (of(a, "d") + of(b, "d") - F.floor((100 - percent) * n / (100 + percent))) / 2
    follow = F.least(of(a, "d") - of(a, "pos"), of(b, "d") - of(b, "pos"))
    # A member outside is met by the short prefix of the other.
    reach = (of(a, "out") & (of(b, "pos") < of(b, "short"))) | (of(b, "out") & (of(a, "pos") < of(a, "short")))
    return (of(a, "comp") != of(b, "comp")) & reach & (follow >= overlap) & (100 * F.least(of(a, "n"), of(b, "n")) >= percent * F.greatest(of(a, "n"), of(b, "n")))


def _as_pairs(ws: Workspace, met: DataFrame, a: str, b: str) -> DataFrame:
    first = F.col(f"{a}.member") < F.col(f"{b}.member")
    pick = lambda x, y, c: F.when(first, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}"))
    ends = [pick(a, b, "member").alias("centre"), pick(b, a, "member").alias("member"), pick(b, a, "n").alias("n"), pick(a, b, "comp").alias("cc"), pick(b, a, "comp").alias("cm")]
    return ws.stage(met.select(*ends).distinct().withColumn("more", F.lit(False)), "rest-pairs")


def _element_stars(ws: Workspace, prefixes: DataFrame, percent: int) -> DataFrame:
    """Members of an element against the one of the largest difference."""
    row = F.struct("member", "n", "comp", "out", "d", "short", "pos")
    tops = prefixes.groupBy("centre", "token").agg(F.max(F.struct("d", F.lit(-1) - F.col("member"), row.alias("row"))).alias("top"), F.bool_or("out").alias("some"), F.count("*").alias("c"))
    tops = ws.stage(tops.where("some and c > 1").select("centre", "token", F.col("top.row").alias("b")), "tops")
    met = prefixes.select("centre", "token", row.alias("a")).join(tops, ["centre", "token"]).where(_may_be_similar("a", "b", percent))
    return _as_pairs(ws, met, "a", "b")


def _element_pairs(ws: Workspace, prefixes: DataFrame, percent: int) -> DataFrame:
    """Members outside the centre's component against all that their elements leave room for."""
    row = F.struct("member", "n", "comp", "out", "d", "short", "pos")
    one, two = prefixes.select("centre", "token", row.alias("a")), prefixes.where("out").select("centre", "token", row.alias("b"))
    met = one.join(two, ["centre", "token"]).where(_may_be_similar("a", "b", percent) & (~F.col("a.out") | (F.col("a.member") < F.col("b.member"))))
    return _as_pairs(ws, met, "a", "b")


def _merge(ws: Workspace, labels: DataFrame, found: DataFrame) -> DataFrame:
    links = ws.stage(found.where("ok and cc <> cm").select(F.col("cc").alias("src"), F.col("cm").alias("dst")).distinct(), "links")
    return labels if links.isEmpty() else _relabel(ws, labels, links)


def _relabel(ws: Workspace, labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after merging the components that ``links`` connect."""
    merged = ws.stage(connected_components(links).select(F.col("node").alias("comp"), F.col("component").alias("into")), "merged")
    moved = labels.join(merged, "comp", "left").select("rep", F.coalesce("into", "comp").alias("comp"))
    return ws.stage(moved, "labels")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """``docs`` with one document of each component; columns unchanged."""
    ws = Workspace(docs.sparkSession, "near-dropped")
    found = near_components(docs, id_col, text_col, percent)
    lost = ws.stage(found.where("not kept").select(F.col("id").alias("_tf_id")).distinct(), "dropped")
    left = docs.join(id_side(lost), docs[id_col].cast("long").eqNullSafe(F.col("_tf_id")), "left_anti")
    unique = docs.groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    return left if unique else left.dropDuplicates([id_col])


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_components(docs).withColumnRenamed("id", "doc_id")


#: All pairs that share a shingle are counted, then components are closed round by round.
SQL: dict[str, str] = {
    "op4_minhash_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
            FROM w
        ), sizes AS MATERIALIZED (SELECT doc_id, len(s) AS n FROM sets),
        shingles AS MATERIALIZED (SELECT doc_id, hash(x) AS h, md5(x) AS x FROM (SELECT doc_id, unnest(s) AS x FROM sets)),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
            FROM shingles a JOIN shingles b ON a.h = b.h AND a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2
        ), links AS MATERIALIZED (
            SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * shared >= 85 * (p.n + q.n - shared)
        ), arcs AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM sizes
            UNION
            SELECT reach.doc_id, arcs.b FROM reach JOIN arcs ON arcs.a = reach.other
        )
        SELECT doc_id, n AS n_shingles, least_id AS component_id, doc_id = least_id AS kept
        FROM sizes JOIN (SELECT doc_id, min(other) AS least_id FROM reach GROUP BY doc_id) USING (doc_id)
    """
}
