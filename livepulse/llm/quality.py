"""Operator 6, quality classifier: supervised subword embeddings.

A text is a bag of features: its words, word pairs and byte n-grams of each size in
``sizes``, hashed into ``1 << bits`` buckets (a word followed by itself is one feature,
whatever the word). Every bucket has a learned vector; a text is the average of its
features' vectors, each kind of feature with the same weight, and a softmax layer turns
that into class probabilities. Training is plain numpy stochastic gradient descent over a bounded
sample of labelled rows (``sample_rows``, drawn by a hash of doc_id), in one Spark task
that sees the sample only. Because average and output layer are linear before the
softmax, the model collapses into one number per bucket; that table (4 bytes per
bucket, a fixed size) is broadcast, and every whole text is scored with it where it is read.

Defined cases: null and empty texts have no feature and get the score of the bias alone;
null labels and labels of unknown ids are ignored; several labels of one id count as
their maximum; a null ``doc_id`` is never learned from; without any usable label every score
is 0.5; very long texts are scored whole; other columns are ignored by ``score`` and kept
by ``keep_good``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_of, hash_spans, mix, padded, stored, text_blocks, words

SCORE = "doc_id long, score double"
ECHO = 7      # bucket of a word that follows itself


@dataclass
class Shape:
    bits: int = 18
    sizes: tuple[int, ...] = (2, 3, 4)
    dim: int = 8
    epochs: int = 4
    rate: float = 0.5
    seed: int = 11


def feature_parts(raw: np.ndarray, off: np.ndarray, shape: Shape) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, offsets of each text) for each kind of feature."""
    shift = np.uint64(64 - shape.bits)
    view = padded(raw)
    end = np.repeat(off[1:], np.diff(off))
    for n in shape.sizes:
        at = np.flatnonzero(np.arange(len(raw)) + n <= end)
        gram = view[at] & np.uint64((1 << 8 * n) - 1)
        h = (gram + np.uint64(n << 56)) * np.uint64(0x9E3779B97F4A7C15)
        yield ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> shift, np.searchsorted(at, off)
    starts, ends, first = words(raw, off)
    h = hash_spans(raw, starts, ends, seed=101)
    yield h >> shift, first
    text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    pair = np.flatnonzero(text_of[1:] == text_of[:-1])
    both = mix(h[pair] * np.uint64(3) + h[pair + 1]) >> shift
    yield np.where(h[pair] == h[pair + 1], np.uint64(ECHO), both), np.searchsorted(pair, first)


def bags(raw: np.ndarray, off: np.ndarray, shape: Shape) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: (distinct buckets, weight of each in the average)."""
    parts = list(feature_parts(raw, off, shape))
    out = []
    for i in range(len(off) - 1):
        own = [b[o[i]:o[i + 1]] for b, o in parts]
        weight = np.concatenate([np.full(len(x), 1 / (max(1, len(x)) * len(own))) for x in own])
        bucket, back = np.unique(np.concatenate(own), return_inverse=True)
        out.append((bucket, np.bincount(back, weight, len(bucket)).astype(np.float32)))
    return out


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], shape: Shape) -> np.ndarray:
    """Gradient descent; returns the collapsed model: a logit per bucket, the bias last.
    A step moves the average by rate * gradient whatever the length of the text."""
    rng = np.random.default_rng(shape.seed)
    embed = rng.uniform(-1 / shape.dim, 1 / shape.dim, (1 << shape.bits, shape.dim)).astype(np.float32)
    out = np.zeros((2, shape.dim), np.float32)
    bias = np.zeros(2, np.float32)
    steps, done = shape.epochs * len(samples), 0
    for _ in range(shape.epochs):
        for k in rng.permutation(len(samples)):
            bucket, share, label = samples[k]
            rate = shape.rate * (1 - done / steps)
            done += 1
            hidden = share @ embed[bucket] if len(bucket) else np.zeros(shape.dim, np.float32)
            logit = out @ hidden + bias
            p = np.exp(logit - logit.max())
            error = p / p.sum()
            error[label] -= 1
            back = error @ out
            out -= rate * np.outer(error, hidden)
            bias -= 0.1 * rate * error
            if len(bucket):
                embed[bucket] -= (rate * share / (share @ share))[:, None] * back
    line = out[1] - out[0]
    return np.append(embed @ line, bias[1] - bias[0]).astype(np.float32)


def score_block(model: np.ndarray, raw: np.ndarray, off: np.ndarray, shape: Shape) -> np.ndarray:
    total, kinds = np.zeros(len(off) - 1), 0
    for bucket, o in feature_parts(raw, off, shape):
        run = np.concatenate([[0.0], np.cumsum(model[bucket], dtype=np.float64)])
        total += (run[o[1:]] - run[o[:-1]]) / np.maximum(np.diff(o), 1)
        kinds += 1
    return 1 / (1 + np.exp(-(total / kinds + model[-1])))


def held_out(doc_id: Column, parts: int = 5, part: int = 0) -> Column:
    """crc32 of doc_id as text falls into ``part`` of ``parts``; false for a null id."""
    crc = F.crc32(doc_id.cast("long").cast("string").cast("binary"))
    return F.coalesce(crc % parts == part, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int) -> DataFrame:
    """text, label of about ``rows`` labelled documents (all, if there are fewer), drawn
    by a hash of doc_id. ``learn`` is a condition on the label table's doc_id."""
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("int").alias("_label"), learn.alias("_learn")) \
        .filter("_learn and _id is not null and _label is not null").groupBy("_id").agg(F.max("_label").alias("_label"))
    n = known.count()
    if n > rows:
        share = int(1_000_000 * rows / n)
        known = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < share)
    # at most about ``rows`` narrow rows: safe to broadcast at any input size
    return docs.select(F.col("doc_id").cast("long").alias("_doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .join(F.broadcast(known), F.col("_doc") == F.col("_id")) \
        .select("text", F.col("_label").alias("label"), F.col("_doc").alias("doc_id"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", learn: Column | None = None,
        sample_rows: int = 4000, shape: Shape | None = None) -> np.ndarray:
    """The collapsed model, learned from rows of ``labels`` for which ``learn`` holds."""
    shape = shape or Shape()
    sample = labelled_sample(docs, labels, label, F.lit(True) if learn is None else learn, sample_rows)

    def learn_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = []
        for part, raw, off in text_blocks(batches):
            samples += [(b, s, y, d) for (b, s), y, d in zip(bags(raw, off, shape), part.column("label").to_pylist(),
                                                             part.column("doc_id").to_pylist())]
        samples.sort(key=lambda x: (zlib.crc32(str(x[3]).encode()), x[3], x[2], len(x[0])))   # the same order on every run
        two = len({y for _, _, y, _ in samples}) == 2
        model = train([x[:3] for x in samples], shape) if two else np.zeros((1 << shape.bits) + 1, np.float32)
        yield batch_of("model binary", model=[model.tobytes()])

    model = stored(sample.repartition(1).mapInArrow(learn_task, "model binary"), "quality-model")
    row = model.first()      # none where no labelled document exists
    return np.frombuffer(row["model"], np.float32) if row else np.zeros((1 << shape.bits) + 1, np.float32)


def score(docs: DataFrame, model: np.ndarray, shape: Shape | None = None) -> DataFrame:
    """doc_id, score of every document: the probability of label 1."""
    shape = shape or Shape()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, off in text_blocks(batches):
            yield batch_of(SCORE, doc_id=part.column("doc_id"), score=score_block(shared.value, raw, off, shape))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, SCORE)


def keep_good(docs: DataFrame, model: np.ndarray, least: float = 0.3, shape: Shape | None = None) -> DataFrame:
    """Documents that score at least ``least``, all columns as they were."""
    shape = shape or Shape()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, off in text_blocks(batches):
            yield part.filter(pa.array(score_block(shared.value, raw, off, shape) >= least))

    return docs.mapInArrow(run, docs.schema)
