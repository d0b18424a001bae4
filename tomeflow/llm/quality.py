"""Quality classifier: random Fourier features over document statistics, ridge scores, isotonic calibration.

1. A pass over the whole texts gives each document a short vector of statistics
   (classes of characters, words, lines, repetition).  Labels, language, source and
   identifier are no inputs.
2. Cosines of random projections approximate a Gaussian kernel on the standardised
   statistics.  Every partition of labelled rows sums its normal equations, one set
   for each of three folds; sums are added in two levels, so the driver gets at most
   ``SUMMED`` fixed-size rows however many partitions there are.
3. The ridge solution of all folds scores documents.  Scores of a fold by the
   solution of the other folds, counted in ``BINS`` bins, fit the isotonic curve that
   turns a score into a probability.

Defined results: a null or empty text has the statistics of no characters and a score
like any other; labels without a quality are ignored, of several for a document the
largest counts; without labels, or with one class only, every score is the share of
good labels (1/2 without any); a null identifier is never held out; rows that repeat an
identifier are scored one by one; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.llm.batches import small_batches
from tomeflow.llm.joins import id_side
from tomeflow.workspace import Workspace

FOURIER = 320
BANDWIDTH = 6.0
RIDGE = 2.0
FOLDS = 3
BINS = 4096
SUMMED = 16
SEED = 20250117

OTHER, LOWER, UPPER, DIGIT, SPACE, NEWLINE, STOP, PUNCT, SYMBOL, ACCENT = range(10)


def _class_of(c: str) -> int:
    kind = unicodedata.category(c)
    if c == "\n":
        return NEWLINE
    if c.isspace():
        return SPACE
    if c in ".!?…。":
        return STOP
    if c in ",;:'\"()-–—’‘“”«»¿¡":
        return PUNCT
    if kind[0] in "PS":
        return SYMBOL
    if kind[0] == "N":
        return DIGIT
    if kind == "Lu":
        return UPPER
    if kind[0] == "L":
        return LOWER if c.isascii() else ACCENT
    return OTHER


_CLASSES = np.array([_class_of(chr(i)) for i in range(0x3100)], np.uint8)
_CLASSES = np.append(_CLASSES, np.uint8(ACCENT))  # all above

STATISTICS = (
    "log_chars log_words word_length word_length_sd upper digit space stop punct symbol accent other exclamation bar "
    "symbol_words capital_words stop_words short_words long_words distinct_words top_word log_lines line_words repeated_lines "
    "worst_symbol_line worst_capital_line symbol_lines capital_lines bar_lines longest_run"
).split()


def _spread(share: float) -> float:
    """Shares on a scale that tells small ones apart."""
    return float(np.log1p(100 * share))


def statistics(text: str | None) -> np.ndarray:
    """The statistics of a whole text."""
    out = np.zeros(len(STATISTICS), np.float32)
    if not text:
        return out
    code = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    kind = _CLASSES[np.minimum(code, len(_CLASSES) - 1)]
    n = len(code)
    count = np.bincount(kind, minlength=10)
    words = text.split()
    letters = max(1, count[LOWER] + count[UPPER] + count[ACCENT])
    v = [np.log1p(n), np.log1p(len(words))]
    white = (kind == SPACE) | (kind == NEWLINE)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], white, [True])).view(np.int8)))
    begin, end = edge[::2], edge[1::2]
    m = max(1, len(begin))
    length = end - begin
    v += [length.mean() if len(length) else 0, length.std() if len(length) else 0]
    v += [_spread(count[UPPER] / letters), *(_spread(count[k] / n) for k in (DIGIT, SPACE, STOP, PUNCT, SYMBOL, ACCENT, OTHER))]
    v += [_spread(np.count_nonzero(code == 33) / n), _spread(np.count_nonzero(code == 124) / n)]
    if len(begin):
        def per_word(mask: np.ndarray) -> np.ndarray:
            total = np.concatenate(([0], np.cumsum(mask)))
            return total[end] - total[begin]

        symbols, capitals = per_word(kind == SYMBOL), per_word(kind == UPPER)
        alphabetic = capitals + per_word((kind == LOWER) | (kind == ACCENT))
        shouted = (capitals > 1) & (2 * capitals > alphabetic)
        v += [_spread((symbols > 0).sum() / m), _spread(shouted.sum() / m), _spread((kind[end - 1] == STOP).sum() / m)]
        v += [_spread((length <= 3).sum() / m), _spread((length >= 14).sum() / m)]
    else:
        symbols = shouted = np.zeros(0, np.int64)
        v += [0.0] * 5
    tally: dict[str, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    v += [len(tally) / max(1, len(words)), _spread(max(tally.values(), default=0) / max(1, len(words)))]
    lines = [line for line in text.split("\n") if line.strip()]
    v += [np.log1p(len(lines)), np.log1p(len(words) / max(1, len(lines))), _spread(1 - len({*lines}) / max(1, len(lines)))]
    if len(begin):
        breaks = np.concatenate(([0], np.cumsum(kind == NEWLINE)))[begin]  # line of each word
        first = np.flatnonzero(np.diff(breaks, prepend=-1))
        size = np.diff(np.append(first, len(begin)))
        symbolic = np.add.reduceat((symbols > 0).astype(np.int64), first) / size
        loud = np.add.reduceat(shouted.astype(np.int64), first) / size
        barred = np.add.reduceat((code[begin] == 124).astype(np.int64), first) / size
        enough = size >= 4
        v += [symbolic[enough].max(initial=0), loud[enough].max(initial=0)]
        weight = size / size.sum()
        v += [_spread(weight[symbolic > 0.3].sum()), _spread(weight[loud > 0.5].sum()), _spread(weight[barred > 0.15].sum())]
    else:
        v += [0.0] * 5
    change = np.flatnonzero(np.diff(code))
    v.append(np.log1p(np.diff(np.concatenate(([-1], change, [n - 1]))).max()))
    out[:] = v
    return out


def _statistics_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [statistics(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float32()))], ["id", "x"])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, x``: the statistics of every row."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_statistics_rows, "id long, x array<float>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


class Features:
    """Standardised statistics, their Fourier features and a constant."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.project = rng.standard_normal((len(mean), FOURIER)) / BANDWIDTH
        self.phase = rng.uniform(0, 2 * np.pi, FOURIER)
        self.size = FOURIER + len(mean) + 1

    def __call__(self, x: np.ndarray) -> np.ndarray:
        s = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack((np.sqrt(2 / FOURIER) * np.cos(s @ self.project + self.phase), 0.1 * s, np.ones((len(s), 1))))


def _summed(df: DataFrame, sums, size: int) -> np.ndarray:
    """Add the arrays that ``sums`` makes of a partition's batches: in the tasks, then in a tree, then here.

    Every task of the tree adds about ``SUMMED`` arrays, and the driver gets as many at most, however many partitions there are.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            part = sums(batch)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([total.tobytes()], pa.binary())})

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for part in batch.column(0):
                total += np.frombuffer(part.as_py())
        yield pa.RecordBatch.from_pydict({"part": pa.array([total.tobytes()], pa.binary())})

    n = df.rdd.getNumPartitions()
    parts = df.mapInArrow(first, "part binary")
    while n > SUMMED:
        n = -(-n // SUMMED)
        parts = parts.repartition(n).mapInArrow(second, "part binary")
    return sum((np.frombuffer(r["part"]) for r in parts.collect()), np.zeros(size))


def pool_adjacent_violators(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence of least weighted squares."""
    blocks: list[list[float]] = []
    for value, w in zip(y, weight):
        blocks.append([value, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w2, n = blocks.pop()
            last = blocks[-1]
            last[0] = (last[0] * last[1] + v * w2) / (last[1] + w2)
            last[1] += w2
            last[2] += n
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.zeros(0)


class Classifier:
    """Ridge weights and a calibration curve; scores texts anywhere."""

    def __init__(self, features: Features | None, weights: np.ndarray | None, knots: np.ndarray, curve: np.ndarray):
        self.features, self.weights, self.knots, self.curve = features, weights, knots, curve

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.curve[0])
        raw = self.features(x) @ self.weights
        # A thousandth of a strictly increasing curve keeps the order of documents within the flat parts.
        return 0.999 * np.interp(raw, self.knots, self.curve) + 0.001 / (1 + np.exp(-4 * (np.clip(raw, -5, 5) - 0.5)))


def _bin(raw: np.ndarray) -> np.ndarray:
    return np.clip(((raw + 1) / 3 * BINS).astype(np.int64), 0, BINS - 1)


def fit(training: DataFrame) -> Classifier:
    """Fit on ``x, y`` (statistics, label 0 or 1) and ``fold`` (0 to FOLDS - 1)."""
    d = len(STATISTICS)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x, y = _matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
        return np.concatenate(([len(x), y.sum()], x.sum(axis=0), (x * x).sum(axis=0)))

    training = training.select("x", "y", "fold")
    total = _summed(training, moments, 2 + 2 * d)
    n, good = total[:2]
    if not n or good in (0, n):
        share = good / n if n else 0.5
        return Classifier(None, None, np.zeros(1), np.array([share]))
    mean = total[2 : 2 + d] / n
    scale = np.sqrt(np.maximum(total[2 + d :] / n - mean * mean, 1e-6))
    features = Features(mean, scale)
    p = features.size

    def equations(batch: pa.RecordBatch) -> np.ndarray:
        z, y, fold = features(_matrix(batch.column(0))), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
        out = np.zeros((FOLDS, p, p + 1))
        for k in range(FOLDS):
            mine = z[fold == k]
            out[k, :, :p] = mine.T @ mine
            out[k, :, p] = mine.T @ y[fold == k]
        return out.ravel()

    sums = _summed(training, equations, FOLDS * p * (p + 1)).reshape(FOLDS, p, p + 1)
    ridge = RIDGE * np.eye(p)
    ridge[-1, -1] = 1e-6

    def solve(s: np.ndarray) -> np.ndarray:
        return np.linalg.solve(s[:, :p] + ridge, s[:, p])

    weights = solve(sums.sum(axis=0))
    others = [solve(sums.sum(axis=0) - sums[k]) for k in range(FOLDS)]

    def counted(batch: pa.RecordBatch) -> np.ndarray:
        z, y, fold = features(_matrix(batch.column(0))), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
        out = np.zeros((3, BINS))
        raw = np.choose(fold, [z @ w for w in others])
        at = _bin(raw)
        np.add.at(out[0], at, 1)
        np.add.at(out[1], at, y)
        np.add.at(out[2], at, raw)
        return out.ravel()

    count, hits, raw = _summed(training, counted, 3 * BINS).reshape(3, BINS)
    used = count > 0
    curve = pool_adjacent_violators(hits[used] / count[used], count[used])
    return Classifier(features, weights, raw[used] / count[used], curve)


def held_out(doc_id) -> F.Column:
    """Whether a row belongs to the third that the fit never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(statistics_of: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Classifier:
    """Fit on the labelled rows that are not held out; folds follow the identifier."""
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).cast("double").alias("y"))
    known = known.where(~held_out(F.col("id")))
    fold = F.pmod(F.xxhash64("id"), F.lit(FOLDS)).cast("long")
    return fit(Workspace(labels.sparkSession, "quality").stage(statistics_of.join(known, "id").select("x", "y", fold.alias("fold")), "training"))


def score_statistics(statistics_of: DataFrame, classifier: Classifier) -> DataFrame:
    """``id, score`` of every row of ``id, x``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = classifier(_matrix(batch.column(1))) if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], ["id", "score"])

    return statistics_of.select("id", "x").mapInArrow(score, "id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; columns unchanged."""
    from pyspark.sql.pandas.functions import arrow_udf
    from pyspark.sql.types import BooleanType

    known = Workspace(docs.sparkSession, "quality").stage(labels.select(F.col(id_col).alias("_tf_id")).distinct(), "labelled")
    labelled = docs.join(id_side(known), docs[id_col] == F.col("_tf_id"), "left_semi")
    classifier = train(document_statistics(labelled, id_col, text_col), labels, id_col)

    @arrow_udf(BooleanType())
    def good(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            x = [statistics(t.as_py()) for t in texts]
            yield pa.array(classifier(np.array(x, np.float64)) >= threshold if x else [], pa.bool_())

    return docs.where(good(F.col(text_col)))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = Workspace(spark, "quality").stage(document_statistics(docs), "statistics")
    scored = score_statistics(rows, train(rows, labels))
    return scored.select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


SQL: dict[str, str] = {}
