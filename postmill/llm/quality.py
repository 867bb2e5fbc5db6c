"""Quality classifier: a factorisation machine over hashed words and structure.

Features of a text: its words, hashed to WORD_SLOTS and weighted by frequency to length 1; bins of
structure statistics (shares of upper case, digits, symbols, repeated words, ..); and bins of its
metadata: length in bytes, words, lines. A pair of features i, j adds <v_i, v_j> x_i x_j to the
score. The sum over all pairs is half of (sum v x)^2 - sum v^2 x^2 per factor, so scoring takes time
linear in the features. The machine is fitted by AdaGrad on a bounded sample of labelled rows
(``SAMPLE``, chosen by hash of the id); labels, lang, source and doc_id are never features.

Null and empty texts have structure bins only and get the score those give. Repeated labels of one
id count once, with the larger value. Without labelled rows of both kinds the score is the share of
label 1, or 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, packed
from .lm import remainder
from .words import NOT_SPACE, named, raw, slices, text_in, words

HELD_OUT = (5, 0)
SAMPLE = 8000
THRESHOLD = 0.3
WORD_SLOTS = 1 << 16
BINS = 16
FACTORS = 8
EPOCHS, STEPS = 12, 1500  # at least so many passes, and so many steps of BATCH rows
BATCH = 64
RATE = 0.05
DECAY = 1e-4
SEED = 7

LETTERS = (slice(65, 91), slice(97, 123))
SYMBOLS = b"!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~"
STATISTICS = (
    "upper", "digit", "symbol", "stop", "comma", "bang", "bar", "other", "space", "high",
    "distinct", "doubled", "word_length", "line_words", "bytes", "words", "lines",
)
SLOTS = WORD_SLOTS + BINS * len(STATISTICS)


def _binned(value: np.ndarray, top: float) -> np.ndarray:
    """Bins that are finer near 0."""
    return np.minimum(BINS * np.sqrt(np.clip(value / top, 0, 1)), BINS - 1).astype(np.int64)


def statistics(texts: pa.Array, n_words: np.ndarray, n_distinct: np.ndarray, n_doubled: np.ndarray) -> np.ndarray:
    """The slots of each text's structure and metadata bins, one row a text."""
    body, at = raw(texts)
    n_docs, sizes = len(at) - 1, np.diff(at)
    doc = np.repeat(np.arange(n_docs) * 256, sizes)
    count = np.bincount(doc + body, minlength=n_docs * 256).reshape(n_docs, 256).astype(np.float64)
    size, n = np.maximum(sizes, 1), np.maximum(n_words, 1)
    upper, lower = count[:, LETTERS[0]].sum(1), count[:, LETTERS[1]].sum(1)
    symbols = count[:, list(SYMBOLS)]
    values = [
        (upper / np.maximum(upper + lower, 1), 1.0),
        (count[:, 48:58].sum(1) / size, 0.5),
        (symbols.sum(1) / n, 4.0),
        (count[:, 46] / n, 1.0),
        (count[:, 44] / n, 1.0),
        (count[:, 33] / n, 2.0),
        (count[:, 124] / n, 1.0),
        ((symbols.max(1) if n_docs else size) / n, 3.0),
        (count[:, [9, 10, 11, 12, 13, 32]].sum(1) / size, 0.5),
        (count[:, 128:].sum(1) / size, 1.0),
        (n_distinct / n, 1.0),
        (n_doubled / n, 1.0),
        (size / n, 32.0),
        (n_words / (count[:, 10] + 1), 256.0),
        (np.log1p(sizes) ** 2, 400.0),
        (np.log1p(n_words) ** 2, 300.0),
        (np.log1p(count[:, 10]) ** 2, 100.0),
    ]
    return WORD_SLOTS + np.stack([k * BINS + _binned(v, top) for k, (v, top) in enumerate(values)], axis=1)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots, values, and where each text's features begin (with the end last)."""
    w = words(texts, NOT_SPACE)
    n_docs = len(w.first) - 1
    entry, times = np.unique(w.doc() * WORD_SLOTS + (w.hash % np.uint64(WORD_SLOTS)).astype(np.int64), return_counts=True)
    doc, weight = entry // WORD_SLOTS, np.sqrt(times)
    length = np.sqrt(np.bincount(doc, weights=weight * weight, minlength=n_docs))
    found = np.bincount(doc, minlength=n_docs)
    own = w.doc()
    doubled = np.bincount(own[1:][(w.hash[1:] == w.hash[:-1]) & (own[1:] == own[:-1])], minlength=n_docs)
    fixed = statistics(texts, np.diff(w.first), found, doubled)
    width = fixed.shape[1]
    first = np.concatenate(([0], np.cumsum(found + width)))
    slot, value = np.empty(first[-1], np.int32), np.empty(first[-1], np.float32)
    place = np.arange(len(entry)) + doc * width
    slot[place], value[place] = entry % WORD_SLOTS, weight / length[doc]
    at = (first[1:] - width)[:, None] + np.arange(width)
    slot[at], value[at] = fixed, 1 / np.sqrt(width)
    return slot, value, first


class Machine:
    """Bias ``b``, weights ``w`` and factors ``v``."""

    def __init__(self, bias: float):
        random = np.random.default_rng(SEED)
        self.b = bias
        self.w = np.zeros(SLOTS, dtype=np.float32)
        self.v = random.normal(0, 0.05, (SLOTS, FACTORS)).astype(np.float32)

    def sums(self, slot: np.ndarray, value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Raw scores, and per text the sums of v x, by the sum-of-squares identity."""
        vx = self.v[slot] * value[:, None]
        begin = first[:-1]  # every text has structure bins, so none is empty
        total = np.add.reduceat(vx, begin, axis=0)
        squares = np.add.reduceat((vx * vx).sum(1), begin)
        linear = np.add.reduceat(self.w[slot] * value, begin)
        return self.b + linear + 0.5 * ((total * total).sum(1) - squares), total

    def score(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        raw_score, _ = self.sums(*features(texts))
        return 1 / (1 + np.exp(-np.clip(raw_score.astype(np.float64), -30, 30)))


def fitted(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> Machine:
    """AdaGrad on the logistic loss."""
    label = np.array([r[2] for r in rows], dtype=np.float32)
    good = float(label.mean()) if len(rows) else 0.5
    machine = Machine(float(np.log(max(good, 1e-3) / max(1 - good, 1e-3))))
    if len(set(label.tolist())) < 2:
        machine.v[:] = 0
        return machine
    random = np.random.default_rng(SEED)
    squared_w, squared_v = np.full(SLOTS, 1e-6, np.float32), np.full((SLOTS, FACTORS), 1e-6, np.float32)
    # The rarer label counts more, by the root of how much rarer it is.
    rare = float(np.clip(np.sqrt(good / (1 - good)), 0.2, 5))
    weight = np.where(label > 0, 1.0, rare).astype(np.float32)
    batches = max(1, len(rows) // BATCH)
    for _ in range(max(EPOCHS, -(-STEPS // batches))):
        order = random.permutation(len(rows))
        for chunk in np.array_split(order, batches):
            slot = np.concatenate([rows[i][0] for i in chunk])
            value = np.concatenate([rows[i][1] for i in chunk])
            sizes = np.array([len(rows[i][0]) for i in chunk])
            first = np.concatenate(([0], np.cumsum(sizes)))
            raw_score, total = machine.sums(slot, value, first)
            error = (1 / (1 + np.exp(-np.clip(raw_score, -30, 30))) - label[chunk]) * weight[chunk] / np.sqrt(len(chunk))
            each = np.repeat(error, sizes)
            machine.b -= RATE * float(error.mean())
            at, back = np.unique(slot, return_inverse=True)
            step = each * value
            grad_w = np.bincount(back, weights=step, minlength=len(at)) + DECAY * machine.w[at]
            grad_v = step[:, None] * (np.repeat(total, sizes, axis=0) - machine.v[slot] * value[:, None])
            grad_v = np.stack([np.bincount(back, weights=grad_v[:, f], minlength=len(at)) for f in range(FACTORS)], axis=1) + DECAY * machine.v[at]
            squared_w[at] += grad_w**2
            squared_v[at] += grad_v**2
            machine.w[at] -= RATE * grad_w / np.sqrt(squared_w[at])
            machine.v[at] -= RATE * grad_v / np.sqrt(squared_v[at])
    return machine


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            slot, value, first = features(named(part, "text"))
            cut = list(zip(first[:-1], first[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array([slot[a:b].tobytes() for a, b in cut], pa.binary()), pa.array([value[a:b].tobytes() for a, b in cut], pa.binary()), named(part, "quality")],
                names=["slot", "value", "quality"],
            )


FINE = 1 << 53  # steps in which a share of rows is chosen


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """A machine from at most about ``sample`` labelled rows, features extracted by Spark."""
    known = labels.where(F.col("quality").isin(0, 1)).where(remainder("doc_id", HELD_OUT[0]) != HELD_OUT[1])
    known = known.groupBy(F.col("doc_id").alias("l_id")).agg(F.max("quality").cast("int").alias("quality"))
    count = known.count()
    share = min(1.0, sample / max(count, 1))
    picked = known.where(F.pmod(F.xxhash64(F.lit(SEED), "l_id"), F.lit(FINE)) < int(FINE * share))
    texts = docs.select("doc_id", "text").join(picked, F.col("doc_id") == F.col("l_id")).select("text", "quality")
    rows = texts.mapInArrow(_described, "slot binary, value binary, quality int").collect()
    decoded = [(np.frombuffer(r.slot, np.int32), np.frombuffer(r.value, np.float32), r.quality) for r in rows]
    return fitted(sorted(decoded, key=lambda r: (r[2], r[0].tobytes(), r[1].tobytes())))


def _judged(machine):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                names = [n for n in part.schema.names if n != "_text"]
                score = machine.value.score(text_in(part))
                yield pa.RecordBatch.from_arrays([named(part, n) for n in names] + [pa.array(score, pa.float64())], names=[*names, "score"])

    return judge


def judged(docs: DataFrame, labels: DataFrame, kept: list[str] | None = None) -> DataFrame:
    """``row`` (all columns of ``docs``, or those ``kept``), ``score`` and ``predicted``."""
    bounded_batches(docs.sparkSession)
    machine = docs.sparkSession.sparkContext.broadcast(learned(docs, labels))
    # A whole row holds its text already.
    texts = [F.col("text").alias("_text")] if kept else []
    rows = docs.select(packed(docs.select(kept or "*")).alias("row"), *texts)
    shape = f"row {rows.schema['row'].dataType.simpleString()}, score double"
    return rows.mapInArrow(_judged(machine), shape).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that the classifier rejects."""
    good = judged(docs, labels).where(F.col("predicted") == 1)
    return good.select(*[F.col(f"row.`{name}`").alias(name) for name in docs.columns])


def op1(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = judged(docs, labels, kept=["doc_id"]).select(F.col("row.doc_id").alias("doc_id"), "score", "predicted")
    return found.select("doc_id", (remainder("doc_id", HELD_OUT[0]) == HELD_OUT[1]).alias("held_out"), "score", "predicted")
