"""Quality rules: counts of a text, and a hashed n-gram logistic regression with calibrated probabilities.

Features are the relative frequencies of hashed words and of hashed 3-, 4- and 5-byte grams. The model
is fitted in numpy on a bounded sample of the labelled rows (``SAMPLE`` rows with the least hash of
their id); a quarter of the sample is kept out of the fit and calibrates the score (Platt's method).
All texts are then scored in Arrow batches: one pass of array operations over the bytes of a batch.

Defined cases: a null text is empty (and fails the base rules); a null quality is no label; an id with
several labels counts as the lowest of them; without labels of both classes there is no model, the
probability is null and the base rules decide alone; rows with a null id are scored, not learnt from;
other columns are ignored by ``quality_rows`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoalgrid.llm.common import SPACES, chunks, map_arrow, stage, text_of, texts_of

#: Most labelled rows that the model is fitted on.
SAMPLE = 3000
#: Documents with a lower calibrated probability of good quality are rejected.
THRESHOLD = 0.5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
BITS = 16
GRAMS = (3, 4, 5)
SYMBOLS = b"#*$%&|<>"
_SCALE = 30.0
#: Features that the fit works on at once: beside the features themselves, it needs memory for these only.
_PIECE = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACES)] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_BASE = np.uint64(0x5851F42D4C957F2D)
_STRIPE = 1 << 16


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _M1
    x ^= x >> np.uint64(31)
    x *= _M2
    x ^= x >> np.uint64(30)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, total: int | None = None) -> np.ndarray:
    """A 64-bit hash of each span of bytes: polynomial sums up to the span's ends, mixed with its length.

    It depends on the length of all bytes; ``total`` gives the hashes that the span has among so many bytes.
    """
    n = len(data)
    powers = np.cumprod(np.full(n + 1, _BASE, dtype=np.uint64)) * np.uint64(pow(int(_BASE), -1, 1 << 64))
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
    # equal spans differ by a power of the base: bring all to the place of the last byte
    own = (sums[ends] - sums[starts]) * powers[n - starts]
    if total is not None:
        own *= np.uint64(pow(int(_BASE), total - n, 1 << 64))
    return _mix(own ^ _mix((ends - starts).astype(np.uint64)))


def _copies_in_doc(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value: is it a repeat of an earlier one of its document; does it occur twice or more."""
    key = _mix(value + _mix(doc.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    later, twice = np.zeros(len(key), dtype=bool), np.zeros(len(key), dtype=bool)
    later[order[1:][same]] = True
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return later, twice


class Batch:
    """Words, lines and hashed grams of some texts, as arrays over their joined bytes (a line feed after each).

    ``total``: length of the joined bytes of the batch that these texts are a part of, if not a batch of their own.
    """

    def __init__(self, texts: list[bytes], total: int | None = None):
        self.count = len(texts)
        joined = b"\n".join([*texts, b""])
        self.data = np.frombuffer(joined, dtype=np.uint8)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=self.count)
        self.end = np.cumsum(sizes + 1) - 1
        self.start = self.end - sizes
        space = _SPACE[self.data]
        edge = np.diff(np.r_[True, space, True].astype(np.int8))
        self.word_start, self.word_end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.word_doc = np.searchsorted(self.end, self.word_start)
        self.word_hash = span_hashes(self.data, self.word_start, self.word_end, total)
        self.space = space

    def per_doc(self, doc: np.ndarray, value: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(doc, weights=value, minlength=self.count)

    def base(self) -> dict[str, np.ndarray]:
        """The counts of the base rules, one array per column."""
        inside = np.r_[0, np.cumsum(~self.space & ((self.data & 0xC0) != 0x80))]
        symbols = np.r_[0, np.cumsum(_SYMBOL[self.data])]
        feeds = np.flatnonzero(self.data == 10)
        line_start, line_end = np.r_[0, feeds[:-1] + 1], feeds
        words_before = np.searchsorted(self.word_start, np.stack([line_start, line_end]))
        full = words_before[0] < words_before[1]
        line_start, line_end = line_start[full], line_end[full]
        line_doc = np.searchsorted(self.end, line_start)
        later, _ = _copies_in_doc(line_doc, span_hashes(self.data, line_start, line_end))
        n = len(self.word_hash)
        repeated = np.zeros(n, dtype=bool)
        if n >= 5:
            window = np.zeros(n - 4, dtype=np.uint64)
            for j in range(5):
                window = _mix(window + self.word_hash[j: n - 4 + j] + np.uint64(j))
            whole = self.word_doc[4:] == self.word_doc[:-4]
            at = np.flatnonzero(whole)
            _, twice = _copies_in_doc(self.word_doc[at], window[at])
            for j in range(5):
                repeated[at[twice] + j] = True
        return {
            "n_words": self.per_doc(self.word_doc).astype(np.int64),
            "word_chars": inside[self.end] - inside[self.start],
            "n_symbols": symbols[self.end] - symbols[self.start],
            "n_dup_lines": self.per_doc(line_doc[later]).astype(np.int64),
            "n_repeat_words": self.per_doc(self.word_doc[repeated]).astype(np.int64),
        }

    def grams(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(block, first bytes, buckets): hashed words, then the grams of each length inside one document."""
        yield 0, self.word_start, (self.word_hash >> np.uint64(64 - BITS)).astype(np.int64)
        n = len(self.data)
        for block, size in enumerate(GRAMS, 1):
            if n < size:
                continue
            value = np.zeros(n - size + 1, dtype=np.uint64)
            for j in range(size):
                value |= self.data[j: n - size + 1 + j].astype(np.uint64) << np.uint64(8 * j)
            first = np.arange(n - size + 1)
            doc = np.searchsorted(self.end, first) if self.count > 1 else np.zeros(len(first), dtype=np.int64)
            ok = first + size <= self.end[np.minimum(doc, self.count - 1)]
            yield block, first[ok], (_mix(value[ok] + np.uint64(size)) >> np.uint64(64 - BITS)).astype(np.int64)

    def features(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per document: buckets of all blocks and their scaled relative frequencies."""
        doc, bucket, weight = [], [], []
        for block, first, own in self.grams():
            d = np.searchsorted(self.end, first)
            doc.append(d)
            bucket.append(own + (block << BITS))
            weight.append(_SCALE / self.per_doc(d)[d])
        doc, bucket, weight = map(np.concatenate, (doc, bucket, weight))
        key, place = np.unique(doc * np.int64((1 + len(GRAMS)) << BITS) + bucket, return_inverse=True)
        value = np.bincount(place, weights=weight, minlength=len(key))
        ends = np.searchsorted(key, np.arange(1, self.count + 1) * np.int64((1 + len(GRAMS)) << BITS))
        parts = np.split(np.arange(len(key)), ends[:-1])
        return [((key[p] % ((1 + len(GRAMS)) << BITS)).astype(np.int32), value[p].astype(np.float32)) for p in parts]

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Sum over the features of each document, without making them: means of looked-up weights."""
        total = np.zeros(self.count)
        for block, first, own in self.grams():
            values = weights[own + (block << BITS)]
            sums = np.r_[0.0, np.cumsum(values, dtype=np.float64)]
            a, b = np.searchsorted(first, self.start), np.searchsorted(first, self.end)
            total += _SCALE * (sums[b] - sums[a]) / np.maximum(b - a, 1)
        return total


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, id_column: str, text_column: str, label_column: str) -> DataFrame:
    """(doc_id, label, text) of at most ``rows`` labelled documents, the same ones at every run."""
    own = labels.select(F.col(id_column).alias("doc_id"), F.col(label_column).alias("label")).where("doc_id is not null and label is not null")
    own = own.groupBy("doc_id").agg(F.min("label").alias("label"))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    return texts.join(F.broadcast(own), "doc_id").dropDuplicates(["doc_id"])  # at most ``rows`` short rows are sent out


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of each text as of its batch, made for a few texts at a time: they take some 250 times the bytes of these."""
    for batch in chunks(batches, "text"):
        total = sum(map(len, texts_of(batch.column("text")))) + batch.num_rows
        for part in chunks(iter([batch]), "text", _STRIPE):
            own = Batch(list(texts_of(part.column("text"))), total).features()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.string()), part.column("label").cast(pa.int32()),
                 pa.array([x.tobytes() for x, _ in own], pa.binary()), pa.array([x.tobytes() for _, x in own], pa.binary())],
                names=["doc_id", "label", "buckets", "amounts"])


def fit(labels: np.ndarray, buckets: list[np.ndarray], amounts: list[np.ndarray], rounds: int = 60) -> tuple[np.ndarray, float, float] | None:
    """Weights, and slope and offset of the calibration; every fourth row is only calibrated on. None with one class."""
    if len(labels) < 8 or not 0 < labels.sum() < len(labels):
        return None
    held = np.arange(len(labels)) % 4 == 3
    order = np.argsort(held, kind="stable")  # the rows to learn from, then those to calibrate on
    labels, learnt = labels[order], int((~held).sum())
    if not 0 < labels[:learnt].sum() < learnt:
        return None
    size = (1 + len(GRAMS)) << BITS
    pieces = list(_pieces(order, buckets))  # (first, last) of rows in the new order

    def scores(first, last):
        own = order[first: last]
        row = np.repeat(np.arange(last - first), [len(buckets[i]) for i in own])
        at, value = np.concatenate([buckets[i] for i in own]), np.concatenate([amounts[i] for i in own])
        return row, at, value, np.bincount(row, weights=w[at] * value, minlength=last - first)

    y = labels[:learnt]
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / learnt
    w, bias = np.zeros(size, dtype=np.float32), 0.0
    m, s = np.zeros(size), np.zeros(size)
    for step in range(1, rounds + 1):
        g, total = 1e-6 * w.astype(np.float64), 0.0
        for first, last in pieces:
            last = min(last, learnt)
            if first < last:
                row, at, value, z = scores(first, last)
                error = (balance[first: last] * (1 / (1 + np.exp(-np.clip(z + bias, -30, 30))) - y[first: last])).astype(np.float32)
                g += np.bincount(at, weights=error[row] * value, minlength=size)
                total += float(error.sum())
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        w -= (0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        bias -= 0.5 * total
    z, y = np.concatenate([scores(*piece)[3] for piece in pieces])[learnt:], labels[learnt:]
    slope, offset = platt(z, y) if 0 < y.sum() < len(y) else (1.0, bias)
    return w, slope, offset


def _pieces(order: np.ndarray, buckets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``_PIECE`` features each, one row at least."""
    first, size = 0, 0
    for k, i in enumerate(order, 1):
        size += len(buckets[i])
        if size >= _PIECE or k == len(order):
            yield first, k
            first, size = k, 0


def platt(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability 1 / (1 + exp(-(slope * score + offset))), by Newton's method with smoothed targets."""
    good = labels.sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (len(labels) - good + 2))
    centre, width = scores.mean(), scores.std() or 1.0
    x = np.stack([(scores - centre) / width, np.ones(len(scores))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * (beta - [1.0, 0.0]))
        beta -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
    return float(beta[0] / width), float(beta[1] - beta[0] * centre / width)


def fit_on(sample: DataFrame) -> tuple[np.ndarray, float, float] | None:
    """Model of a bounded sample (doc_id, label, text); only hashed features come to the driver."""
    # fetched part by part: the driver's JVM never holds the features of all rows
    staged = stage(map_arrow(sample, _sample_features, "doc_id string, label int, buckets binary, amounts binary"), "features")
    found = sorted(staged.toLocalIterator(), key=lambda x: x["doc_id"])
    labels = np.array([1 if x["label"] > 0 else 0 for x in found])
    return fit(labels, [np.frombuffer(x["buckets"], np.int32) for x in found], [np.frombuffer(x["amounts"], np.float32) for x in found])


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(texts: list[bytes], model, threshold: float) -> dict[str, np.ndarray]:
    """Base counts, base verdict, probability (NaN without a model) and verdict of some texts."""
    batch = Batch(texts)
    out = batch.base()
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEATED_PERCENT * out["n_words"])
    if model is None:
        return out | {"probability": np.full(len(texts), np.nan), "kept": ~out["base_failed"]}
    weights, slope, offset = model
    chance = 1 / (1 + np.exp(-np.clip(slope * batch.scores(weights) + offset, -60, 60)))
    return out | {"probability": chance, "kept": ~out["base_failed"] & (chance >= threshold)}


def _judged(model, threshold: float) -> Callable:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", _STRIPE * 8):
            found = judge(list(texts_of(batch.column("text"))), model, threshold)
            chance = pa.array(found["probability"], mask=np.isnan(found["probability"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(found[f].astype(np.int64)) for f in FIELDS], pa.array(found["base_failed"]), pa.array(found["kept"]), chance],
                names=["doc_id", *FIELDS, "base_failed", "kept", "probability"])

    return step


def quality_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD, id_column: str = "doc_id",
                 text_column: str = "text", label_column: str = "quality") -> DataFrame:
    """Counts, verdicts and probability of every row, keyed by ``doc_id``."""
    model = fit_on(labelled_sample(docs, labels, sample, id_column, text_column, label_column))
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    kinds = T.StructType([
        rows.schema["doc_id"], *[T.StructField(f, T.LongType()) for f in FIELDS], T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()), T.StructField("probability", T.DoubleType())])
    return map_arrow(rows, _judged(model, threshold), kinds)


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD, id_column: str = "doc_id",
              text_column: str = "text", label_column: str = "quality") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, in one pass without a shuffle."""
    model = fit_on(labelled_sample(docs, labels, sample, id_column, text_column, label_column))
    kinds = docs.schema

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text_column, _STRIPE * 8):
            yield batch.filter(pa.array(judge(list(texts_of(pa.compute.fill_null(batch.column(text_column), ""))), model, threshold)["kept"]))

    return map_arrow(docs, step, kinds)
