"""Exact dedup by a log-structured merge index of digests (native operators only).

* Memtable: one input partition.  Its rows' digests are sorted in the task and
  flushed as a run, a Parquet file with a Bloom filter on the digest, without any
  shuffle.  Runs hold 32 bytes of SHA-256 and an identifier, never texts.
* Compaction merges the runs by digest (map-side combined) into one entry per
  digest: the identifier that stays and the number of rows.  Its table has as many
  files as the runs fill partitions, however many partitions the merge has.
* A hit, a digest with more than one row, is not believed: the least and the
  greatest text of its members are compared byte by byte, and are equal only if
  all are.  Texts that differ under one digest are grouped again by the whole text.

The contract of the query keeps the *largest* identifier of equal texts; the
index takes either end as a parameter.

Defined results: a null text counts as empty; all empty texts are equal; a null
identifier ranks below all others; rows repeated with the same identifier are
rows of their own, of which exactly one is kept; an empty table gives an empty
result.  Other columns, whatever their names, are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.llm import joins
from tomeflow.workspace import Workspace

#: So many compacted entries (a digest of 32 bytes and three numbers each) are broadcast at most.
BROADCAST_ENTRIES = 200_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null gives the empty string."""
    text = F.coalesce(text, F.lit(""))
    # In an ASCII text lower() changes A-Z only, and is many times faster.
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


class DigestIndex:
    """Sorted digest runs of rows ``(digest, id, uid)`` and their compaction."""

    def __init__(self, spark: SparkSession, keep: str = "largest", digest_bits: int = 256):
        if keep not in ("largest", "smallest"):
            raise ValueError("keep must be 'largest' or 'smallest'")
        self.spark, self.keep, self.digest_bits = spark, keep, digest_bits
        self.ws = Workspace(spark, "digest-index")
        self.runs: list[DataFrame] = []

    def digest(self, text: Column) -> Column:
        full = F.unhex(F.sha2(text, 256))
        return full if self.digest_bits == 256 else F.substring(full, 1, max(1, self.digest_bits // 8))

    def flush(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Flush every partition of ``docs`` as one sorted run."""
        folded = fold_ascii(F.col(text_col))
        rows = docs.select(
            F.col(id_col).cast("long").alias("id"),
            F.unhex(F.sha2(folded, 256)).alias("sha"),
            F.monotonically_increasing_id().alias("uid"),
        ).withColumn("digest", F.col("sha") if self.digest_bits == 256 else F.substring("sha", 1, max(1, self.digest_bits // 8)))
        run = self.ws.stage(
            rows.sortWithinPartitions("digest"),
            "run",
            **{"parquet.bloom.filter.enabled#digest": "true", "parquet.bloom.filter.expected.ndv#digest": "200000"},
        )
        self.runs.append(run)
        return run

    def entries(self) -> DataFrame:
        out = self.runs[0]
        for run in self.runs[1:]:
            out = out.unionByName(run)
        return out

    def compact(self) -> DataFrame:
        """Merge all runs: ``(digest, keep_id, keep_uid, group_size)``, only digests with two rows or more.

        Digests of one row need no entry: no other row looks them up.
        """
        pick = F.max if self.keep == "largest" else F.min
        entries = self.entries()
        merged = (
            entries.groupBy("digest")
            .agg(pick(F.struct("id", "uid")).alias("top"), F.count("*").alias("group_size"))
            .where("group_size > 1")
            .select("digest", F.col("top.id").alias("keep_id"), F.col("top.uid").alias("keep_uid"), "group_size")
        )
        # Every file costs the writer a few child processes on a local disk, and the readers a request.
        files = max(self.spark.sparkContext.defaultParallelism, entries.rdd.getNumPartitions())
        return self.ws.stage(merged.coalesce(files), "compacted")


def _bounded(side: DataFrame, rows: int, limit: int) -> DataFrame:
    """A side of a join that goes to the other one up to a counted number of rows; beyond it both are shuffled and sorted."""
    return F.broadcast(side) if rows <= limit else side.hint("merge")


def _verified(index: DigestIndex, docs: DataFrame, digests: DataFrame, hits: int, id_col: str, text_col: str) -> DataFrame | None:
    """Texts that share one of ``digests`` with a different text, regrouped by text; None if there are none.

    Only documents of hit digests pass the join.  Their least and greatest text are found on the map side first, so that
    a digest of very many rows sends two texts a task, and nothing but colliding digests is written.
    """
    ws = index.ws
    hit_ids = index.entries().join(digests, "digest", "left_semi").select("id")
    folded = fold_ascii(F.col("_tf_text"))
    texts = (
        docs.select(F.col(id_col).cast("long").alias("_tf_id"), F.col(text_col).alias("_tf_text"))
        .join(_bounded(hit_ids, hits, joins.BROADCAST_IDS), F.col("_tf_id").eqNullSafe(F.col("id")), "left_semi")
        .select(F.col("_tf_id").alias("id"), folded.alias("text"))
        .withColumn("digest", index.digest(F.col("text")))
    )
    ends = texts.groupBy("digest").agg(F.min("text").alias("least"), F.max("text").alias("greatest"))
    wrong = ws.stage(ends.where("least <> greatest").select("digest"), "collisions")
    if wrong.isEmpty():
        ws.drop(wrong)
        return None
    if index.digest_bits == 256:
        raise ValueError("two different texts have one SHA-256; nothing was dropped")
    pick = F.max if index.keep == "largest" else F.min
    clash = texts.join(wrong, "digest", "left_semi").select("id", F.sha2("text", 256).alias("sha"), "text", "digest")
    return ws.stage(
        clash.groupBy("digest", "text").agg(pick("id").alias("keep_id"), F.count("*").alias("group_size"), F.first("sha").alias("sha")),
        "regrouped",
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "largest",
    digest_bits: int = 256,
) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, sha`` (SHA-256 of the folded text, binary).

    ``digest_bits`` below 256 truncates the digest, to force collisions in tests.
    """
    index = DigestIndex(docs.sparkSession, keep, digest_bits)
    entries = index.flush(docs, id_col, text_col)
    compacted = index.compact()
    groups, hits = compacted.agg(F.count("*"), F.coalesce(F.sum("group_size"), F.lit(0))).first()
    digests = _bounded(compacted.select("digest"), groups, BROADCAST_ENTRIES)
    compacted = _bounded(compacted, groups, BROADCAST_ENTRIES)
    regrouped = _verified(index, docs, digests, hits, id_col, text_col) if groups else None
    if regrouped is None:
        joined = entries.join(compacted, "digest", "left")
        lone = F.col("group_size").isNull()
        return joined.select(
            "id",
            F.when(lone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
            (lone | (F.col("uid") == F.col("keep_uid"))).alias("kept"),
            "sha",
        )
    # Some digests are shared by different texts: theirs are told apart by the whole text's own hash.
    exact = regrouped.select(F.unhex("sha").alias("sha"), "digest")
    by_text = (
        entries.join(exact, ["digest", "sha"])
        .groupBy("sha")
        .agg((F.max if keep == "largest" else F.min)(F.struct("id", "uid")).alias("top"), F.count("*").alias("n"))
        .select(F.col("sha"), F.col("top.id").alias("x_id"), F.col("top.uid").alias("x_uid"), "n")
    )
    joined = entries.join(compacted, "digest", "left").join(by_text, "sha", "left")
    size = F.coalesce("n", "group_size", F.lit(1).cast("long"))
    uid = F.when(F.col("n").isNotNull(), F.col("x_uid")).otherwise(F.col("keep_uid"))
    return joined.select(
        "id",
        F.when(F.col("n").isNotNull(), F.col("x_id")).when(F.col("group_size").isNotNull(), F.col("keep_id")).otherwise(F.col("id")).alias("keep_id"),
        size.alias("group_size"),
        (uid.isNull() | (F.col("uid") == uid)).alias("kept"),
        "sha",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """``docs`` without the rows that an equal text stands for; columns unchanged."""
    dropped = exact_groups(docs, id_col, text_col, keep).where("not kept").select(
        F.col("id").alias("_tf_id"), F.col("sha").alias("_tf_sha"), F.col("keep_id").alias("_tf_keep")
    )
    ws = Workspace(docs.sparkSession, "exact-dropped")
    dropped = ws.stage(dropped, "dropped")
    # A row repeated with one identifier loses all but one of its repeats.
    repeats = dropped.where(F.col("_tf_id").eqNullSafe(F.col("_tf_keep")))
    lost = dropped.where(~F.col("_tf_id").eqNullSafe(F.col("_tf_keep"))).select("_tf_id", "_tf_sha").distinct()
    if repeats.isEmpty():
        # An identifier has one row here, unless texts of one identifier differ: the digest tells them apart.
        shared = lost.groupBy("_tf_id").count().where("count > 1").isEmpty()
        if shared and docs.groupBy(id_col).count().where("count > 1").isEmpty():
            return docs.join(joins.id_side(lost.select("_tf_id")), docs[id_col].cast("long").eqNullSafe(F.col("_tf_id")), "left_anti")
    tagged = docs.withColumn("_tf_hash", F.unhex(F.sha2(fold_ascii(F.col(text_col)), 256)))
    left = tagged.join(
        lost,
        F.col(id_col).cast("long").eqNullSafe(F.col("_tf_id")) & (F.col("_tf_hash") == F.col("_tf_sha")),
        "left_anti",
    )
    return left.dropDuplicates(["_tf_hash"]).drop("_tf_hash")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_groups(docs).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


SQL = {
    "op3_exact_dedup": """
        WITH n AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM n
    """
}
