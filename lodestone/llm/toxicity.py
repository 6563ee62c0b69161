"""Toxicity: FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Features of a text are the distinct hashed word unigrams (whole, and their first four
and five bytes, which inflected forms share), bigrams and skip-grams (two words with one
or two words between) it contains, A-Z lower-cased, punctuation at word edges ignored.
Training visits a bounded sample of labelled rows, those with the smallest hash of id,
and of each the ``TRAIN_FEATURES`` buckets with the smallest hash.  FTRL-proximal keeps a learning rate per coordinate and an L1
threshold, so all but a few thousand weights are exactly zero and the model is a short
list of (bucket, weight) that travels with the scoring task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

BITS = 20
#: Labelled rows used for training, at most.
TRAIN_ROWS = 6_000
#: Distinct buckets of one labelled row that are learned from, at most: with TRAIN_ROWS this
#: bounds what the driver holds, whatever the length of the texts.
TRAIN_FEATURES = 20_000
#: Word beginnings, in bytes, that stand for a word's inflected forms.
STEMS = (4, 5)
#: Text bytes whose features are held at a time, many times their size.
PIECE_BYTES = 1 << 20

_PUNCT = np.zeros(256, bool)
_PUNCT[[ord(c) for c in ".,;:!?\"'()[]{}"]] = True


@dataclass(frozen=True)
class Model:
    """Bias and the non-zero weights."""

    bias: float
    index: np.ndarray
    weight: np.ndarray

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float32)
        out[self.index] = self.weight
        return out


def feature_pairs(buf: np.ndarray, offs: np.ndarray, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, bucket) pairs of a batch; ``keep`` masks the buckets of interest."""
    buf = C.ascii_lower(buf)
    starts, ends, first = C.word_spans(buf, offs)
    for _ in range(3):  # strip up to three marks from either end of a word
        wide = ends - starts > 1
        ends = ends - (wide & _PUNCT[buf[np.maximum(ends - 1, 0)]])
        wide = ends - starts > 1
        starts = starts + (wide & _PUNCT[buf[np.minimum(starts, max(len(buf) - 1, 0))]])
    h = C.span_hashes(buf, starts, ends)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    docs, slots = [], []

    def add(d, x):
        x = (x >> C.U64(64 - BITS)).astype(np.int64)
        if keep is not None:
            k = keep[x]
            d, x = d[k], x[k]
        docs.append(d)
        slots.append(x)

    add(doc, h)
    for size in STEMS:
        add(doc, C.mix(C.span_hashes(buf, starts, np.minimum(ends, starts + size)) + C.U64(size)))
    for gap in (1, 2, 3):
        if len(h) > gap:
            same = doc[gap:] == doc[:-gap]
            add(doc[gap:][same], C.mix(h[:-gap] * C._STEP[gap] + h[gap:])[same])
    code = np.unique((np.concatenate(docs) << BITS) | np.concatenate(slots))
    return code >> BITS, code & ((1 << BITS) - 1)


class FTRL:
    """FTRL-proximal for logistic loss with binary features."""

    def __init__(self, alpha: float = 0.1, beta: float = 1.0, l1: float = 6.0, l2: float = 1.0, bias_alpha: float = 0.5):
        self.alpha, self.beta, self.l1, self.l2, self.bias_alpha = alpha, beta, l1, l2, bias_alpha
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        self.bias_z = self.bias_n = 0.0

    def weights(self, x: np.ndarray) -> np.ndarray:
        z = self.z[x]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[x])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def bias(self) -> float:
        return -self.bias_z / ((self.beta + self.bias_n**0.5) / self.bias_alpha)

    def learn(self, x: np.ndarray, y: int) -> None:
        w = self.weights(x)
        b = self.bias()
        p = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35)))
        g = p - y
        self.z[x] += g - (np.sqrt(self.n[x] + g * g) - np.sqrt(self.n[x])) / self.alpha * w
        self.n[x] += g * g
        self.bias_z += g - ((self.bias_n + g * g) ** 0.5 - self.bias_n**0.5) / self.bias_alpha * b
        self.bias_n += g * g

    def model(self) -> Model:
        every = np.arange(1 << BITS)
        w = self.weights(every)
        at = np.flatnonzero(w)
        return Model(float(self.bias()), at, w[at].astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, passes: int = 3, rows: int = TRAIN_ROWS) -> Model:
    """Fit on the ``rows`` labelled ids with the smallest hash; null labels are left out.

    ``labels(doc_id, toxic)``.  The sampled ids are few by construction and are broadcast,
    so no text is shuffled.  Without labelled rows every score is 0.5.
    """
    sample = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic")
        .limit(rows)
    )
    # a repeated id brings one text, so rows stay bounded
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    sample = texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    def features(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            buf, offs = C.text_buffer(table.column("text"))
            got = [np.empty(0, np.int32)] * table.num_rows
            for i, j, b, o in C.batches(buf, offs, PIECE_BYTES):
                doc, slot = feature_pairs(b, o)
                for d, part in enumerate(np.split(slot.astype(np.int32), np.searchsorted(doc, np.arange(1, j - i)))):
                    if len(part) > TRAIN_FEATURES:
                        part = part[np.argsort(C.mix(part.astype(np.uint64)), kind="stable")[:TRAIN_FEATURES]]
                    got[i + d] = part
            yield pa.RecordBatch.from_arrays([table.column("doc_id").combine_chunks(), table.column("toxic").combine_chunks(), pa.array([g.tobytes() for g in got], pa.binary())], names=["doc_id", "toxic", "slots"])

    got = sample.mapInArrow(C.tidy(features), "doc_id long, toxic int, slots binary").collect()
    rows_ = sorted(((r["doc_id"], r["toxic"], np.frombuffer(r["slots"], np.int32)) for r in got), key=lambda r: (r[0], r[1]))
    learner = FTRL()
    rng = np.random.default_rng(7)
    for _ in range(passes):
        for k in rng.permutation(len(rows_)):
            _, y, x = rows_[k]
            learner.learn(x, y)
    return learner.model()


def score_rows(docs: DataFrame, model: Model, name: str, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and the score as ``name``.

    Null and empty texts get the bias alone.  Repeated rows get equal scores.  The work
    is a map: nothing is shuffled.
    """
    C.bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.index, model.weight))

    def run(batches):
        bias, index, weight = shared.value
        dense = np.zeros(1 << BITS, np.float32)
        dense[index] = weight
        keep = dense != 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            buf, offs = C.text_buffer(table.column(text_col))
            total = np.full(table.num_rows, bias)
            for i, j, b, o in C.batches(buf, offs, PIECE_BYTES):
                doc, slot = feature_pairs(b, o, keep)
                total[i:j] += np.bincount(doc, weights=dense[slot], minlength=j - i)
            out = pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, name])

    return docs.mapInArrow(C.tidy(run), T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for every row: the probability that the text is toxic."""
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return score_rows(picked, model, "score").drop("text")


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is under the threshold.

    Null and empty texts have the bias alone, rows with null ids are scored like others
    and never learned from, repeated rows are decided alike; without any label all rows
    are kept; an empty table gives an empty result.
    """
    model = fit(docs, labels)
    if not model.bias and not len(model.index):
        return docs
    mark = C.unused("_toxicity", docs.columns)
    return score_rows(docs, model, mark).where(F.col(mark) < threshold).drop(mark)


def held_out(id_col: str = "doc_id"):
    """Rows never learned from: crc32 of the id as text, modulo 4, is 2."""
    return (F.crc32(F.col(id_col).cast("string").cast("binary")) % 4) == 2


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on labelled documents that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where(~held_out())
    return train(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), known)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    Null and empty texts get the score of the bias alone.  Rows with a null id are scored
    and never held out; repeated rows get equal scores.  Very long texts are taken in
    batches of whole documents.  Labels of unknown ids and null labels teach nothing;
    without any label every score is 0.5.  Other columns are ignored; an empty table
    gives an empty result.
    """
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
