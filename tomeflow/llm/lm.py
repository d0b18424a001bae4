"""Document scores by masked pseudo-likelihood.

A small network, written in numpy, predicts a token from the two tokens before and the
two after it; a document's score is the sum of the conditional log-probabilities of all
its tokens, each predicted from both sides.

1. Word counts of the whole corpus, written as a table, give the vocabulary: the most
   frequent words are tokens, every other word belongs to a token by its hash.
2. Documents are tokenised once, into a written table of their tokens and of the words
   that have no token of their own; training and scoring read that.
3. Training: in each of ``ROUNDS`` rounds every partition starts from the shared weights
   and takes gradient steps over its own documents, with every ``ROUNDS``-th token hidden
   (which ones follows from the text and the round), so that over the rounds every token
   of the corpus is predicted once; the weights are averaged by tokens.
   Sums are added in a tree, so a task adds ``SUMMED`` fixed-size rows and the driver
   gets as many at most, however many partitions there are.
4. Scoring is a pass over the tokens with the weights, of fixed size, in hand, which
   gives P(token | context).  A word without a token of its own has the probability
   P(token | context) * P(word | token), the latter its count among those of the token's
   words.  The counts of the ``COMMON`` most frequent words go to every task; documents'
   other distinct words are joined with the table of counts.  A word that the
   corpus lacks shares one count with as many words as a token has on average.

The softmax is factored: a token is a class and a place in it, 32 x 32 values.

Defined results: a null or empty text has no tokens, the score 0 and a perplexity of 1;
texts are scored whole, in blocks of bounded size; repeated rows and null identifiers
are scored one by one and alike; the weights follow from how documents are dealt to partitions, as each takes
steps of its own, so another partitioning gives slightly other scores; words are told apart by 64 bits of hash; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.llm import shingles
from tomeflow.llm.batches import small_batches
from tomeflow.workspace import Workspace

CLASSES, PLACES = 32, 32
VOCABULARY = CLASSES * PLACES
FREQUENT = 768  # the rest of the vocabulary are hash classes
SIDE = 2
PAD = VOCABULARY
TOKEN = np.dtype("<i2")  # numpy sorts these by radix
EMBEDDING, HIDDEN = 8, 24
ROUNDS = 2
STEP = 512
RATE = 0.08
SUMMED = 16
BLOCK = 4096
COMMON = 200_000  # words whose counts are held in the tasks, 16 bytes each
WORD_TABLE = 100_000
COUNTED, COUNT_ROWS = 200_000, 20_000
SPREAD = 60.0  # exp(-60) and sums of it are normal 32-bit floats


class Words(dict):
    """Token of each word; unknown words are remembered up to a bound."""

    def __init__(self, frequent: list[str]):
        super().__init__((w.encode(), i) for i, w in enumerate(frequent))
        self.frequent = dict(self)

    def __missing__(self, word: bytes) -> int:
        if len(self) > WORD_TABLE:
            self.clear()
            self.update(self.frequent)
            if word in self:
                return self[word]
        token = self[word] = FREQUENT + zlib.crc32(word) % (VOCABULARY - FREQUENT)
        return token

    def tokens(self, text: str | None) -> np.ndarray:
        return self.of(shingles.split_words(text))

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), TOKEN, len(words))


class Vocabulary(list):
    """The words that are tokens, and the counts of all words of the corpus."""

    def __init__(self, frequent: list[str], counts: np.ndarray, counted: DataFrame, totals: np.ndarray, others: int, common: tuple[np.ndarray, np.ndarray]):
        super().__init__(frequent)
        self.counts = counts
        self.common = common  # hashes of the most frequent words, ascending, and the logarithms of their counts
        self.counted = counted  # word, n; grows with the corpus and stays a table
        self.totals = totals  # tokens of each hash class
        self.others = others  # distinct words that are no tokens


class Index(dict):
    """A place for each word, in the order in which they are met."""

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        return at


class Table:
    """What is known of the words that a task has met: token, hash and log count, or that the count is to be joined."""

    def __init__(self, frequent: list[str], common: tuple[np.ndarray, np.ndarray]):
        self.frequent = [w.encode() for w in frequent]
        self.known, self.logs = common
        self.clear()

    def clear(self) -> None:
        self.index = Index((w, i) for i, w in enumerate(self.frequent))
        n = len(self.index)
        self.token, self.hash, self.log, self.join = np.arange(n, dtype=TOKEN), np.zeros(n, np.int64), np.zeros(n), np.zeros(n, bool)

    def places(self, words: Iterator[bytes], count: int) -> np.ndarray:
        """Place of each word; the table is emptied beforehand when it holds too many."""
        if len(self.index) > WORD_TABLE + len(self.frequent):
            self.clear()
        places = np.fromiter(map(self.index.__getitem__, words), np.int32, count)
        new = list(itertools.islice(self.index, len(self.token), None))
        if new:
            token = np.fromiter((FREQUENT + zlib.crc32(w) % (VOCABULARY - FREQUENT) for w in new), TOKEN, len(new))
            # The hash of Spark's ``xxhash64``.
            hashes = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in new), np.uint64, len(new)).view(np.int64)
            log, join = np.zeros(len(new)), np.ones(len(new), bool)
            if len(self.known):
                at = np.searchsorted(self.known, hashes)
                join = self.known.take(at, mode="clip") != hashes
                log[~join] = self.logs[at[~join]]
            self.token, self.hash = np.append(self.token, token), np.append(self.hash, hashes)
            self.log, self.join = np.append(self.log, log), np.append(self.join, join)
        return places


def contexts(tokens: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """The tokens around each place (or some places), nearest document ends padded."""
    edge = np.full(SIDE, PAD, TOKEN)
    padded = np.concatenate((edge, tokens, edge))
    places = (np.arange(len(tokens)) if at is None else at) + SIDE
    return np.stack([padded[places + k] for k in range(-SIDE, SIDE + 1) if k], axis=1)


class Network:
    """Embeddings, one hidden layer, class and place outputs."""

    SHAPES = (
        (VOCABULARY + 1, EMBEDDING),
        (2 * SIDE * EMBEDDING, HIDDEN),
        (HIDDEN,),
        (HIDDEN, CLASSES),
        (CLASSES,),
        (CLASSES, HIDDEN, PLACES),
        (CLASSES, PLACES),
    )
    SIZE = sum(math.prod(s) for s in SHAPES)

    def __init__(self, flat: np.ndarray):
        self.flat = np.array(flat, np.float32)
        self.parts, start = [], 0
        for shape in self.SHAPES:
            n = math.prod(shape)
            self.parts.append(self.flat[start : start + n].reshape(shape))
            start += n

    @classmethod
    def start(cls, counts: np.ndarray, seed: int = 11) -> Network:
        """Random weights; the output biases are the corpus frequencies."""
        rng = np.random.default_rng(seed)
        out = cls(rng.normal(0, 0.1, cls.SIZE))
        share = (counts + 1.0).reshape(CLASSES, PLACES)
        out.parts[2][:] = 0
        out.parts[4][:] = np.log(share.sum(axis=1) / share.sum())
        out.parts[6][:] = np.log(share / share.sum(axis=1, keepdims=True))
        return out

    def _hidden(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = self.parts[0].take(context, axis=0, mode="clip").reshape(len(context), -1)
        return x, np.tanh(x @ self.parts[1] + self.parts[2])

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        """Softmax of each row, in place; rows have their own maximum taken off only where values lie far apart."""
        if z.size:
            top = z.max()
            z -= top if top - z.min() < SPREAD else z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        z /= (z @ np.ones(z.shape[1], z.dtype))[:, None]
        return z

    @staticmethod
    def _log_softmax_at(z: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Logarithm of each row's softmax at one place; a row's value does not depend on the rows beside it."""
        picked = z[np.arange(len(z)), at]
        across = np.ascontiguousarray(z.T)
        top = across.max(axis=0, initial=-np.inf)
        across -= top
        np.exp(across, out=across)
        return picked - top - np.log(across.sum(axis=0))

    def _by_class(self, target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Rows in the order of their classes, and ``(class, from, to)``."""
        kind = target // PLACES
        order = np.argsort(kind, kind="stable")
        edge = np.searchsorted(kind[order], np.arange(CLASSES + 1)).tolist()
        return order, [(c, a, b) for c, (a, b) in enumerate(zip(edge, edge[1:])) if a < b]

    def _places(self, h: np.ndarray, kind: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
        """Logits of the places within each row's class; rows are in the order of their classes."""
        z = self.parts[6].take(kind, axis=0, mode="clip")
        for c, a, b in spans:
            z[a:b] += h[a:b] @ self.parts[5][c]
        return z

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        _, h = self._hidden(context)
        out = self._log_softmax_at(h @ self.parts[3] + self.parts[4], target // PLACES)
        order, spans = self._by_class(target)
        sorted_target = target[order]
        out[order] += self._log_softmax_at(self._places(h.take(order, axis=0), sorted_target // PLACES, spans), sorted_target % PLACES)
        return out

    def gradient(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Mean gradient of the log-probability."""
        grad = Network(np.zeros(self.SIZE, np.float32))
        n = len(target)
        row = np.arange(n)
        order, spans = self._by_class(target)
        context, target = context[order], target[order]
        kind = target // PLACES
        x, h = self._hidden(context)
        d = -self._softmax(h @ self.parts[3] + self.parts[4])
        d[row, kind] += 1
        grad.parts[3][:], grad.parts[4][:] = h.T @ d, d.sum(axis=0)
        dh = d @ self.parts[3].T
        e = -self._softmax(self._places(h, kind, spans))
        e[row, target % PLACES] += 1
        for c, a, b in spans:
            grad.parts[5][c] = h[a:b].T @ e[a:b]
            dh[a:b] += e[a:b] @ self.parts[5][c].T
        if spans:
            grad.parts[6][[c for c, _, _ in spans]] = np.add.reduceat(e, [a for _, a, _ in spans], axis=0)
        dz = dh * (1 - h * h)
        grad.parts[1][:], grad.parts[2][:] = x.T @ dz, dz.sum(axis=0)
        dx = (dz @ self.parts[1].T).reshape(-1, EMBEDDING)
        flat = context.ravel()
        by_token = np.argsort(flat, kind="stable")
        in_order = flat[by_token]
        first = np.append(0, np.flatnonzero(in_order[1:] != in_order[:-1]) + 1)
        grad.parts[0][in_order[first]] = np.add.reduceat(dx.take(by_token, axis=0), first, axis=0)
        return grad.flat / n

    def score(self, tokens: np.ndarray) -> float:
        """Sum of the log-probabilities of all tokens, each given its neighbours."""
        total = 0.0
        for at in range(0, len(tokens), BLOCK):
            places = np.arange(at, min(at + BLOCK, len(tokens)))
            total += float(self.log_probabilities(contexts(tokens, places), tokens[places]).sum(dtype=np.float64))
        return total

    def scores(self, documents: list[np.ndarray]) -> np.ndarray:
        """Scores of several documents, whose tokens share blocks."""
        out = np.zeros(len(documents))
        held: list[int] = []
        size = 0

        def flush() -> None:
            if held:
                context = np.concatenate([contexts(documents[k]) for k in held])
                target = np.concatenate([documents[k] for k in held])
                p = self.log_probabilities(context, target).astype(np.float64)
                edge = np.cumsum([0] + [len(documents[k]) for k in held])
                out[held] = [p[a:b].sum() for a, b in zip(edge, edge[1:])]

        for k, tokens in enumerate(documents):
            if len(tokens) > BLOCK:
                out[k] = self.score(tokens)
            elif len(tokens):
                held.append(k)
                size += len(tokens)
                if size > BLOCK:
                    flush()
                    held.clear()
                    size = 0
        flush()
        return out


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, n`` over the whole corpus; tasks count their own words first, in tables of bounded size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter[bytes] = Counter()

        def rows() -> Iterator[pa.RecordBatch]:
            for part in itertools.batched(tally.items(), COUNT_ROWS):
                words, counts = zip(*part)
                yield pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for w in words], pa.string()), pa.array(counts, pa.int64())], ["word", "n"])
            tally.clear()

        for batch in batches:
            for text in batch.column(0):
                tally.update(shingles.split_words(text.as_py()))
            if len(tally) > COUNTED:
                yield from rows()
        yield from rows()

    return docs.select(text_col).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def hidden_places(tokens: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """Places to predict in a round; each place is in one round, the text's own hash is the offset."""
    return np.arange((zlib.crc32(tokens.tobytes()) + turn) % rounds, len(tokens), rounds)


def _train_partition(flat: np.ndarray, turn: int, rounds: int):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(flat)
        speed = np.full(Network.SIZE, 1e-3, np.float32)
        context, target, held, seen = [], [], 0, 0

        def step() -> None:
            g = net.gradient(np.concatenate(context), np.concatenate(target))
            np.add(speed, g * g, out=speed)
            net.flat += RATE * g / np.sqrt(speed)

        for batch in batches:
            for tokens in batch.column(0):
                tokens = np.frombuffer(tokens.as_buffer(), TOKEN)
                if not len(tokens):
                    continue
                at = hidden_places(tokens, turn, rounds)
                if not len(at):
                    continue
                context.append(contexts(tokens, at))
                target.append(tokens[at])
                held += len(at)
                seen += len(at)
                if held >= STEP:
                    step()
                    context.clear()
                    target.clear()
                    held = 0
        if held:
            step()
        yield pa.RecordBatch.from_pydict({"part": pa.array([np.append(net.flat.astype(np.float64) * seen, seen).tobytes()], pa.binary())})

    return train


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(Network.SIZE + 1)
    for batch in batches:
        for part in batch.column(0):
            total += np.frombuffer(part.as_py())
    yield pa.RecordBatch.from_pydict({"part": pa.array([total.tobytes()], pa.binary())})


def tokenised(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A written table: ``key, id, n_tokens, tokens``, and of a row's words without a token of their own ``common``, the sum of the
    common ones' log counts, and the others' hashes with how often the row has each."""
    frequent, common = list(vocabulary), vocabulary.common

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(frequent, common)
        for batch in batches:
            split = [shingles.split_words(t.as_py()) for t in batch.column(2)]
            size = np.array([len(w) for w in split], np.int64)
            places = table.places(itertools.chain.from_iterable(split), int(size.sum()))
            row = np.repeat(np.arange(len(size)), size)
            sums = np.bincount(row, table.log[places], len(size))
            left = table.join[places]
            pairs, times = np.unique(row[left] << 32 | places[left], return_counts=True)
            edge = pa.array(np.append(0, np.cumsum(np.bincount(pairs >> 32, minlength=len(size)))), pa.int32())
            hashes = table.hash[pairs & 0xFFFFFFFF]
            raw, ends = table.token[places].tobytes(), np.append(0, np.cumsum(size * TOKEN.itemsize)).tolist()
            tokens = [raw[a:b] for a, b in itertools.pairwise(ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size), pa.array(tokens, pa.binary()), pa.array(sums, pa.float64()), pa.ListArray.from_arrays(edge, pa.array(hashes)), pa.ListArray.from_arrays(edge, pa.array(times, pa.int64()))],
                ["key", "id", "n_tokens", "tokens", "common", "words", "times"],
            )

    small_batches(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return Workspace(docs.sparkSession, "tokens").stage(rows.mapInArrow(tokenise, "key long, id long, n_tokens long, tokens binary, common double, words array<long>, times array<long>"), "documents")


def vocabulary_of(docs: DataFrame, text_col: str = "text") -> Vocabulary:
    """The words that are tokens, and the counts of all words, from all documents."""
    small_batches(docs.sparkSession)
    counted = Workspace(docs.sparkSession, "words").stage(word_counts(docs, text_col), "counts")
    # The most frequent words: as many rows as the vocabulary has places.
    top = counted.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    # The next most frequent ones by their hash: those above the least count that COMMON words at most reach.
    step = F.floor(F.log2("n") * 8)
    least, size = None, 0
    for r in sorted(counted.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect(), reverse=True):
        size += r["words"]
        if size > COMMON:
            break
        least = r["step"]
    common = counted.where(step >= least if least is not None else F.lit(False)).select(F.xxhash64("word").alias("word"), "n").toArrow()
    hashes, n = common["word"].to_numpy(), common["n"].to_numpy()
    order = np.lexsort((-n, hashes))
    first = np.append(True, np.diff(hashes[order]) != 0)[: len(order)]
    order = order[first]
    classes = VOCABULARY - FREQUENT
    totals, others = np.zeros(classes), -len(top)
    for r in counted.groupBy((F.crc32(F.col("word").cast("binary")) % classes).alias("kind")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        totals[r["kind"]] = r["n"]
        others += r["words"]
    for r in top:
        totals[zlib.crc32(r["word"].encode()) % classes] -= r["n"]
    return Vocabulary([r["word"] for r in top], np.array([r["n"] for r in top], float), counted, totals, others, (hashes[order], np.log(n[order])))


def train(tokens: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Network:
    """The network, from all documents of a table of tokens."""
    counts = np.zeros(VOCABULARY)
    counts[: len(vocabulary)] = vocabulary.counts
    counts[FREQUENT:] = vocabulary.totals
    net = Network.start(counts)
    for turn in range(rounds):
        parts = tokens.select("tokens").mapInArrow(_train_partition(net.flat, turn, rounds), "part binary")
        total = sum((np.frombuffer(r["part"]) for r in _summed(parts).collect()), np.zeros(Network.SIZE + 1))
        if total[-1] > 0:
            net = Network(total[:-1] / total[-1])
    return net


def _summed(parts: DataFrame) -> DataFrame:
    """At most ``SUMMED`` sums of all parts: each level of the tree adds ``SUMMED`` rows in a task."""
    n = parts.rdd.getNumPartitions()
    while n > SUMMED:
        n = -(-n // SUMMED)
        parts = parts.repartition(n).mapInArrow(_add, "part binary")
    return parts


def score_documents(tokens: DataFrame, net: Network, vocabulary: Vocabulary) -> DataFrame:
    """``id, n_tokens, log_likelihood, perplexity`` of every row of a table of tokens."""
    flat = net.flat
    # A class has one count more than its words, for words that the corpus lacks.
    shares = np.concatenate((np.zeros(FREQUENT), -np.log(vocabulary.totals + 1)))
    unseen = -float(np.log(vocabulary.others / len(vocabulary.totals) + 1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network(flat)
        for batch in batches:
            held = [np.frombuffer(t.as_buffer(), TOKEN) for t in batch.column(3)]
            part = network.scores(held) + [shares[t].sum() for t in held] + batch.column(4).to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(part)], ["key", "id", "n_tokens", "part"])

    scored = tokens.select("key", "id", "n_tokens", "tokens", "common").mapInArrow(score, "key long, id long, n_tokens long, part double")
    held = tokens.select("key", F.explode(F.arrays_zip("words", "times")).alias("w")).select("key", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    known = vocabulary.counted.select(F.xxhash64("word").alias("word"), F.log("n").alias("log_n")).groupBy("word").agg(F.max("log_n").alias("log_n"))
    parts = held.join(known, "word", "left").select("key", F.lit(None).cast("long").alias("id"), F.lit(0).cast("long").alias("n_tokens"), (F.col("times") * F.coalesce("log_n", F.lit(unseen))).alias("part"))
    whole = scored.unionByName(parts).groupBy("key").agg(F.max("id").alias("id"), F.sum("n_tokens").alias("n_tokens"), F.sum("part").alias("log_likelihood"))
    return whole.select("id", "n_tokens", "log_likelihood", F.exp(-F.col("log_likelihood") / F.greatest("n_tokens", F.lit(1))).alias("perplexity"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    vocabulary = vocabulary_of(docs)
    tokens = tokenised(docs, vocabulary)
    return score_documents(tokens, train(tokens, vocabulary), vocabulary).withColumnRenamed("id", "doc_id")


SQL: dict[str, str] = {}
