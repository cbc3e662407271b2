"""Language-model scores of texts: smoothed unigrams, and a log-bilinear neural model.

Tokens are lower-cased words and one end per text. The neural model knows the ``CLASSES`` most frequent
words, the end, and one class for all other words; a word of that class gets the class's probability
times its smoothed share of the class, so the probabilities of all words (one unseen word included)
sum to one. The class after two given ones is scored by ``(C1 q[c1] + C2 q[c2]) . r[c] + b[c]``.

Training covers every training document: Spark counts all class trigrams, cuts the count of each into
parts of at most the mean count and deals the parts out, so that frequent trigrams come up in as many
batches as their counts ask for. In each round every task goes through its own parts with
noise-contrastive estimation in numpy, from the same parameters; the results are averaged by weight.
Scoring normalises over all classes: one matrix product per block of distinct contexts.

Bounded by parameters, not by the data: the at most ``HEAD`` most frequent words, whose counts every task
holds, and the model. Counts of all other words are joined, so every word has its exact count.

Defined cases: a null text is empty (one token, its end); a null id is no held-out one; rows with a
repeated id are rows of their own; without training documents all counts are zero; other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoalgrid.llm.common import chunks, map_arrow, stage, text_of, texts_of
from shoalgrid.operators.skew import lookup

CLASSES = 1024
RARE, END, BEGIN, FIRST = 0, 1, 2, 3
HEAD = 65_536
WIDTH = 32
NOISE = 64
BATCH = 4096
#: Step size of each round of training.
RATES = (0.05, 0.03, 0.02)
#: Distinct words that a task counts before it passes them on.
_FULL = 400_000


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def held_out(id_column) -> F.Column:
    """Ids whose CRC-32 leaves 2 when divided by 7; a null id is none."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    for batch in chunks(batches, "text"):
        for text in texts_of(batch.column("text")):
            counts.update(words_of(text))
        if len(counts) > _FULL:
            yield out()
            counts.clear()
    if counts:
        yield out()


class Vocabulary:
    """Counts of the most frequent words, and the class of those that the model knows."""

    def __init__(self, head: list[tuple[bytes, int]], texts: int, tokens: int, distinct: int, classes: int):
        self.place = {w: i for i, (w, _) in enumerate(head)}
        self.count = np.array([n for _, n in head] or [0], dtype=np.float64)
        known = min(len(head), classes - FIRST)
        self.classes = FIRST + known
        self.class_of = np.where(np.arange(max(len(head), 1)) < known, np.arange(max(len(head), 1)) + FIRST, RARE)
        self.texts, self.tokens, self.distinct = texts, tokens, distinct
        own = float(self.count[:known].sum())
        self.rare_tokens, self.rare_words = tokens - texts - own, max(distinct - (1 if texts else 0) - known, 0)
        share = np.zeros(self.classes)
        share[RARE], share[END] = self.rare_tokens + 1, texts + 1
        share[FIRST:] = self.count[:known] + 1
        self.share = share / share.sum()

    def places(self, texts: list[list[bytes]]) -> np.ndarray:
        """Place of each word in the head, -1 for others, all texts in a row."""
        get = self.place.get
        return np.array([get(w, -1) for words in texts for w in words], dtype=np.int64)

    def sequence(self, places: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(two classes before, class before, class) of every token, the end of each text included."""
        ends = np.cumsum(sizes + 3)
        line = np.full(int(ends[-1]) if len(ends) else 0, BEGIN, dtype=np.int64)
        token = np.ones(len(line), dtype=bool)
        token[ends - sizes - 3] = token[ends - sizes - 2] = False
        end = np.zeros(len(line), dtype=bool)
        end[ends - 1] = True
        line[end] = END
        line[token & ~end] = np.where(places < 0, RARE, self.class_of[np.maximum(places, 0)])
        at = np.flatnonzero(token)
        return line[at - 2], line[at - 1], line[at]


def _trigrams(shared) -> Callable:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        m = vocabulary.classes
        codes, amounts, waiting = [], [], 0

        def out():
            code, place = np.unique(np.concatenate(codes), return_inverse=True)
            n = np.bincount(place, weights=np.concatenate(amounts)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], names=["code", "n"])

        for batch in chunks(batches, "text"):
            texts = [words_of(t) for t in texts_of(batch.column("text"))]
            a, b, c = vocabulary.sequence(vocabulary.places(texts), np.array([len(t) for t in texts], dtype=np.int64))
            code, n = np.unique((a * m + b) * m + c, return_counts=True)
            codes.append(code)
            amounts.append(n)
            waiting += len(code)
            if waiting > 1_000_000:
                yield out()
                codes, amounts, waiting = [], [], 0
        if codes:
            yield out()

    return step


class Model:
    """Parameters of the log-bilinear model; ``r`` has the bias as its last column."""

    def __init__(self, q, r, c1, c2):
        self.parts = [np.asarray(x, dtype=np.float32) for x in (q, r, c1, c2)]

    @staticmethod
    def start(share: np.ndarray, width: int, seed: int = 7) -> Model:
        rng = np.random.default_rng(seed)
        m = len(share)
        r = rng.normal(0, 0.02, (m, width + 1))
        r[:, -1] = np.log(np.maximum(share, 1e-12))
        near = np.eye(width)
        return Model(rng.normal(0, 0.3, (m, width)), r, 0.3 * near, near)

    def rows(self) -> np.ndarray:
        """All parameters as rows of equal width."""
        q, r, c1, c2 = self.parts
        return np.concatenate([r, *[np.c_[x, np.zeros(len(x))] for x in (q, c1, c2)]])

    def of_rows(self, rows: np.ndarray) -> Model:
        m, width = self.parts[0].shape
        return Model(rows[m: 2 * m, :-1], rows[:m], rows[2 * m: 2 * m + width, :-1], rows[2 * m + width:, :-1])

    def log10(self, a: np.ndarray, b: np.ndarray, c: np.ndarray, block: int = 4096) -> np.ndarray:
        """Normalised log10 probabilities of classes ``c`` after ``a``, ``b``: a matrix product per block of contexts."""
        q, r, c1, c2 = self.parts
        m = len(q)
        far, near = q @ c1, q @ c2
        bias = r[:, -1].copy()
        bias[BEGIN] = -np.inf
        context, place = np.unique(a * m + b, return_inverse=True)
        order = np.argsort(place, kind="stable")
        ends = np.searchsorted(place[order], np.arange(0, len(context) + block, block))
        out = np.empty(len(c), dtype=np.float64)
        for i, first in enumerate(range(0, len(context), block)):
            own = context[first: first + block]
            scores = (far[own // m] + near[own % m]) @ r[:, :-1].T
            scores += bias
            top = scores.max(axis=1)
            at = order[ends[i]: ends[i + 1]]
            row = place[at] - first
            given = scores[row, c[at]]
            scores -= top[:, None]
            np.exp(scores, out=scores)
            whole = np.log(scores.sum(axis=1, dtype=np.float64)) + top
            out[at] = given - whole[row]
        return out / np.log(10)


def _add_rows(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the rows of ``values`` by their place."""
    order = np.argsort(at, kind="stable")
    places, first = np.unique(at[order], return_index=True)
    return places, np.add.reduceat(values[order], first, axis=0)


class Training:
    """One pass of noise-contrastive estimation over weighted trigrams, with one Adagrad state for all its batches.

    ``unit`` is the weight of a full batch: what a trigram counts does not depend on what shares its batch.
    """

    def __init__(self, model: Model, share: np.ndarray, unit: float, seed: int, rate: float):
        self.parts = [x.copy() for x in model.parts]
        self.sums = [np.full_like(x, 1e-6) for x in self.parts]
        self.share, self.unit, self.rate = share, unit, rate
        self.rng = np.random.default_rng(seed)
        self.noise_log = np.log(NOISE * np.maximum(share, 1e-12)).astype(np.float32)

    def model(self) -> Model:
        return Model(*self.parts)

    def _step(self, part, seen, places, grad):
        seen[places] += grad * grad
        part[places] -= self.rate * grad / np.sqrt(seen[places])

    def add(self, a, b, c, weight: np.ndarray) -> None:
        q, r, c1, c2 = self.parts
        noise_log = self.noise_log
        order = self.rng.permutation(len(c))
        for first in range(0, len(order), BATCH):
            at = order[first: first + BATCH]
            ia, ib, ic = a[at], b[at], c[at]
            w = (weight[at] / self.unit).astype(np.float32)
            noise = self.rng.choice(len(self.share), NOISE, p=self.share)
            qa, qb = q[ia], q[ib]
            hidden = qa @ c1 + qb @ c2
            full = np.c_[hidden, np.ones(len(at), dtype=np.float32)]
            true = 1 / (1 + np.exp(-np.clip((full * r[ic]).sum(axis=1) - noise_log[ic], -30, 30)))
            false = 1 / (1 + np.exp(-np.clip(full @ r[noise].T - noise_log[noise], -30, 30)))
            g_true, g_false = (w * (true - 1))[:, None], w[:, None] * false
            g_hidden = g_true * r[ic][:, :-1] + g_false @ r[noise][:, :-1]
            g_r = np.concatenate([g_true * full, g_false.T @ full])
            g_q = np.concatenate([g_hidden @ c1.T, g_hidden @ c2.T])
            every = slice(None)
            for part, seen, (places, grad) in zip(
                self.parts, self.sums,
                (_add_rows(g_q, np.concatenate([ia, ib])), _add_rows(g_r, np.concatenate([ic, noise])), (every, qa.T @ g_hidden), (every, qb.T @ g_hidden)),
            ):
                self._step(part, seen, places, grad.astype(np.float32))


def _round(shared, unit: float, number: int, rate: float) -> Callable:
    """Train on the parts of one task; its parameters as rows, times its weight."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, share = shared.value
        m, total = len(share), 0.0
        training = Training(model, share, unit, number, rate)
        for batch in batches:
            code, n = (np.asarray(batch.column(i)) for i in range(2))
            if len(code):
                training.add(code // m // m, code // m % m, code % m, n)
                total += float(n.sum())
        if total:
            rows = training.model().rows().astype(np.float64) * total
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(rows))), pa.array(np.full(len(rows), total)), *[pa.array(rows[:, i]) for i in range(rows.shape[1])]],
                names=["row", "weight", *[f"v{i}" for i in range(rows.shape[1])]])

    return step


def dealt(grams: DataFrame) -> tuple[DataFrame, float]:
    """Equal parts (code, n) of each trigram, none above the mean count, mixed over all tasks; and the mean weight of a part."""
    total, distinct = grams.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    mean = total / max(distinct, 1)
    parts = F.ceil(F.col("n") / F.lit(mean)).cast("int")  # at most twice as many rows as trigrams in all
    rows = grams.select("code", (F.col("n") / parts).alias("n"), F.explode(F.sequence(F.lit(1), parts)).alias("part"))
    mixed = rows.select("code", "n", F.xxhash64("code", "part").alias("h")).repartition("h").sortWithinPartitions("h", "code")
    out = stage(mixed.select("code", "n"), "parts") if distinct else rows.select("code", "n")
    return out, total / max(out.count(), 1)


def fit(grams: DataFrame, vocabulary: Vocabulary, width: int = WIDTH, rates: tuple[float, ...] = RATES) -> Model:
    """Rounds of training on all tasks at once; only sums of parameters come to the driver."""
    spark = grams.sparkSession
    model = Model.start(vocabulary.share, width)
    parts, mean = dealt(grams)
    names = [f"v{i}" for i in range(width + 1)]
    schema = "row long, weight double, " + ", ".join(f"{v} double" for v in names)
    for number, rate in enumerate(rates):
        shared = spark.sparkContext.broadcast((model, vocabulary.share))  # size fixed by CLASSES and WIDTH
        sums = map_arrow(parts, _round(shared, BATCH * mean, number, rate), schema).groupBy("row").agg(F.sum("weight").alias("w"), *[F.sum(v).alias(v) for v in names])
        found = sorted(sums.select("row", *[(F.col(v) / F.col("w")).alias(v) for v in names]).collect())
        if found:
            model = model.of_rows(np.array(found)[:, 1:])
        shared.unpersist()
    return model


def _score(shared) -> Callable:
    """Per text what the head and the model say, and its words outside the head with their numbers."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, model = shared.value
        logs = np.log10(vocabulary.count + 1)
        end_log, end_known = float(np.log10(vocabulary.texts + 1)), int(vocabulary.texts > 0)
        for batch in chunks(batches, "text"):
            texts = [words_of(t) for t in texts_of(batch.column("text"))]
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            doc = np.repeat(np.arange(len(texts)), sizes)
            places = vocabulary.places(texts)
            a, b, c = vocabulary.sequence(places, sizes)
            own = np.repeat(np.arange(len(texts)), sizes + 1)
            total = lambda d, v: np.bincount(d, weights=v, minlength=len(texts)).astype(np.float64)  # noqa: E731  (whole numbers if empty)
            inside = places >= 0
            log = np.where(inside, logs[np.maximum(places, 0)], 0.0)
            rare = ~inside | (vocabulary.class_of[np.maximum(places, 0)] == RARE)
            outside = np.flatnonzero(~inside)
            first = np.cumsum(sizes) - sizes
            tails: list[Counter] = [Counter() for _ in texts]
            for i, d in zip(outside.tolist(), doc[outside].tolist()):
                tails[d][texts[d][i - first[d]]] += 1
            offsets = np.r_[0, np.cumsum([len(t) for t in tails])]
            entries = pa.StructArray.from_arrays(
                [pa.array([w for t in tails for w in t], pa.binary()).cast(pa.string()), pa.array([n for t in tails for n in t.values()], pa.int64())], names=["word", "n"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(sizes + 1), pa.array(total(doc, inside).astype(np.int64) + end_known),
                 pa.array(total(doc, log) + end_log), pa.array(total(doc[rare], log[rare])), pa.array(total(doc, rare).astype(np.int64)),
                 pa.array(total(own, model.log10(a, b, c))), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)],
                names=["doc_id", "held_out", "n_tokens", "known", "logs", "rare_logs", "n_rare", "class_score", "tail"])

    return step


def vocabulary_of(training: DataFrame, head: int, classes: int) -> tuple[Vocabulary, DataFrame]:
    """Vocabulary of the training texts (``text``), and the exact counts (word, c) of all words."""
    counts = stage(map_arrow(training, _count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("c")), "words")
    texts = training.count()
    tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # the highest classes of counts that hold at most ``head`` words together: no task and no driver sorts more
    level = F.floor(F.log2("c") * 16)
    least, room = None, head
    for at, n in sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), reverse=True):
        if n > room:
            break
        least, room = at, room - n
    found = counts.where(level >= least).collect() if least is not None else []
    top = sorted(found, key=lambda r: (-r["c"], r["word"]))
    return Vocabulary([(r["word"].encode(), r["c"]) for r in top], texts, tokens + texts, distinct + (1 if texts else 0), classes), counts


def score_texts(docs: DataFrame, head: int = HEAD, classes: int = CLASSES, width: int = WIDTH, rates: tuple[float, ...] = RATES,
                id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities of the text)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("doc_id"), held_out(F.col(id_column)).alias("held_out"), text_of(text_column).alias("text"))
    training = rows.where("not held_out").select("text")
    vocabulary, counts = vocabulary_of(training, head, classes)
    shared = spark.sparkContext.broadcast(vocabulary)  # size bounded by ``head``
    grams = stage(map_arrow(training, _trigrams(shared), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")), "trigrams")
    model = fit(grams, vocabulary, width, rates)
    both = spark.sparkContext.broadcast((vocabulary, model))
    kinds = T.StructType([
        *rows.schema.fields[:2], T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()), T.StructField("logs", T.DoubleType()),
        T.StructField("rare_logs", T.DoubleType()), T.StructField("n_rare", T.LongType()), T.StructField("class_score", T.DoubleType()),
        T.StructField("tail", T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])))])
    scored = stage(map_arrow(rows, _score(both), kinds).withColumn("row", F.monotonically_increasing_id()), "scored")
    tail = lookup(scored.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.n"), counts, ["word"], "inner")
    sums = tail.groupBy("row").agg(F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more_logs"))
    found = scored.drop("tail").join(sums, "row", "left")
    more = F.coalesce("more_logs", F.lit(0.0))
    whole = float(np.log10(vocabulary.tokens + vocabulary.distinct + 1))
    rare_whole = float(np.log10(vocabulary.rare_tokens + vocabulary.rare_words + 1))
    return found.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0).cast("long"))).alias("n_known"),
        F.lit(int(vocabulary.tokens)).cast("long").alias("train_tokens"), (F.col("logs") + more - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("class_score") + F.col("rare_logs") + more - F.col("n_rare") * rare_whole).alias("score"))
