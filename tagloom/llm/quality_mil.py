"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage becomes a vector of style measures
and hashed words, then a hidden vector; a gated attention weighs the passages, and
the weighted sum is scored. Only documents have labels; the weights are learned
from them. Training is numpy on a bounded sample, scoring runs in Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import hash_spans, split_words, text_slices

#: Words of a passage.
PASSAGE = 128
HASHED = 32
STYLE = 11
WIDTH = STYLE + HASHED
HIDDEN = 16
ATTENTION = 8

_CLASSES = {
    "symbol": b"#*$%&|<>{}[]\\^~=+@_",
    "punctuation": b".,;:!?\"'()-",
    "upper": bytes(range(ord("A"), ord("Z") + 1)),
    "digit": b"0123456789",
    "newline": b"\n",
}


def _counts(raw: np.ndarray) -> dict[str, np.ndarray]:
    """Running counts of the bytes of each class."""
    out = {}
    for name, members in _CLASSES.items():
        table = np.zeros(256, np.int32)
        table[list(members)] = 1
        sums = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(table[raw], out=sums[1:])
        out[name] = sums
    sums = np.zeros(len(raw) + 1, np.int32)
    np.cumsum(raw >= 0xC0, out=sums[1:])
    return out | {"wide": sums}


def encode_passages(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of all passages, and of each text its first passage's index.

    A text without words has one passage of zeros.
    """
    starts, ends, first = split_words(raw, offsets)
    counts = np.diff(first)
    per_text = np.maximum(1, -(-counts // PASSAGE))
    bounds = np.concatenate([[0], np.cumsum(per_text)])
    vectors = np.zeros((bounds[-1], WIDTH), np.float32)
    if not len(starts):
        return vectors, bounds
    nth = np.arange(len(starts)) - np.repeat(first[:-1], counts)
    passage = np.repeat(bounds[:-1], counts) + nth // PASSAGE
    begin = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
    last = np.concatenate([begin[1:], [len(starts)]]) - 1
    words = (last - begin + 1).astype(np.float32)
    hashes = hash_spans(raw, starts, ends)
    chars = ends[last] - starts[begin]
    style = [np.log1p(words) / 5, np.log1p((ends - starts).cumsum()[last] - np.concatenate([[0], (ends - starts).cumsum()])[begin]) / 8]
    style += [np.minimum(3, (sums[ends[last]] - sums[starts[begin]]) / words) for sums in _counts(raw).values()]
    distinct = _distinct(passage, hashes, bounds[-1])
    style.append(distinct[passage[begin]] / words)
    again = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])])
    style.append(np.add.reduceat(again.astype(np.float32), begin) / words)
    style.append(chars / words / 10)
    at = passage[begin]
    vectors[at, :STYLE] = np.stack(style + [np.ones(len(at))] * (STYLE - len(style)), axis=1)
    sign = 1 - 2 * ((hashes >> np.uint64(40)) & np.uint64(1)).astype(np.float32)
    slot = passage * HASHED + (hashes % np.uint64(HASHED)).astype(np.int64)
    bag = np.bincount(slot, weights=sign, minlength=bounds[-1] * HASHED).reshape(-1, HASHED)
    vectors[at, STYLE:] = bag[at] / np.sqrt(words)[:, None]
    return vectors, bounds


def _distinct(passage: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct words of each passage."""
    key = np.sort((hashes >> np.uint64(24)) | (passage.astype(np.uint64) << np.uint64(40)))
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    return np.bincount((key[fresh] >> np.uint64(40)).astype(np.int64), minlength=n)


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]


def _forward(weights: dict[str, np.ndarray], x: np.ndarray, bounds: np.ndarray) -> tuple:
    hidden = np.tanh(x @ weights["W"] + weights["b"])
    left, right = np.tanh(hidden @ weights["V"]), 1 / (1 + np.exp(-hidden @ weights["U"]))
    energy = (left * right) @ weights["w"]
    sizes = np.diff(bounds)
    energy = np.exp(energy - np.repeat(np.maximum.reduceat(energy, bounds[:-1]), sizes))
    attention = energy / np.repeat(np.add.reduceat(energy, bounds[:-1]), sizes)
    pooled = np.add.reduceat(attention[:, None] * hidden, bounds[:-1], axis=0)
    score = 1 / (1 + np.exp(-np.clip(pooled @ weights["c"] + weights["d"], -30, 30)))
    return hidden, left, right, attention, pooled, score


def gradient(weights: dict[str, np.ndarray], x: np.ndarray, bounds: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Weighted log loss of documents and its slopes."""
    hidden, left, right, attention, pooled, score = _forward(weights, x, bounds)
    sizes = np.diff(bounds)
    error = (score - labels) * weight
    back = np.repeat(error, sizes)[:, None] * weights["c"]
    gain = (back * hidden).sum(axis=1)
    energy = attention * (gain - np.repeat(np.add.reduceat(attention * gain, bounds[:-1]), sizes))
    to_left, to_right = energy[:, None] * weights["w"] * right * (1 - left**2), energy[:, None] * weights["w"] * left * right * (1 - right)
    to_hidden = (attention[:, None] * back + to_left @ weights["V"].T + to_right @ weights["U"].T) * (1 - hidden**2)
    loss = -float((weight * (labels * np.log(score) + (1 - labels) * np.log(1 - score))).sum())
    return loss, {
        "W": x.T @ to_hidden, "b": to_hidden.sum(axis=0), "V": hidden.T @ to_left, "U": hidden.T @ to_right,
        "w": (left * right).T @ energy, "c": pooled.T @ error, "d": error.sum(),
    }


def train(x: np.ndarray, bounds: np.ndarray, labels: np.ndarray, epochs: int = 40, rate: float = 0.01, decay: float = 1e-4, seed: int = 3) -> Model:
    """Gated-attention MIL by Adam; classes weigh the same. Without both classes every score is 0.5."""
    rng = np.random.default_rng(seed)
    shape = {"W": (WIDTH, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION), "w": (ATTENTION,), "c": (HIDDEN,), "d": ()}
    zero = {k: np.zeros(s) for k, s in shape.items()}
    if len(labels) == 0 or labels.min() == labels.max():
        return Model(np.zeros(WIDTH), np.ones(WIDTH), zero)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = np.clip((x - mean) / scale, -8, 8)
    weights = {k: rng.normal(0, 1 / np.sqrt(max(1, s[0] if s else 1)), s) if k not in "bd" else np.zeros(s) for k, s in shape.items()}
    first, second = {k: v.copy() for k, v in zero.items()}, {k: v.copy() for k, v in zero.items()}
    class_weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    step, batch = 0, 256
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for begin in range(0, len(order), batch):
            docs = order[begin : begin + batch]
            sizes = np.diff(bounds)[docs]
            rows = np.repeat(bounds[docs] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
            own, part = np.concatenate([[0], np.cumsum(sizes)]), x[rows]
            step += 1
            for k, g in gradient(weights, part, own, labels[docs], class_weight[docs] / len(docs))[1].items():
                g = g + decay * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                weights[k] = weights[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, weights)


def score_passages(model: Model, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return _forward(model.weights, np.clip((x - model.mean) / model.scale, -8, 8), bounds)[5]


def held_out(doc_id):
    """Rows whose labels are never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(doc_id, text, label) of at most ``limit`` labelled documents, chosen by a hash of the id.

    Of several labels of one id the largest counts, and of several rows of one id the one
    of least text hash, so ``limit`` bounds the rows.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)  # at most ``limit`` rows, so it may be broadcast
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_docs: int = 4000) -> Model:
    """Learn from at most ``max_docs`` labelled documents; their passage vectors go to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, raw, offsets in text_slices(batch.column("text")):
                vectors, bounds = encode_passages(raw, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, stop - row), batch.column("label").slice(row, stop - row), pa.array([vectors[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())],
                    ["doc_id", "label", "vectors"],
                )

    sample = training_sample(docs, labels, label, max_docs).select(F.col("doc_id").cast("long"), "label", "text")
    rows = sample.mapInArrow(run, "doc_id long, label int, vectors binary").toArrow().sort_by([("doc_id", "ascending"), ("vectors", "ascending")])
    bags = [np.frombuffer(v, np.float32).reshape(-1, WIDTH) for v in rows.column("vectors").to_pylist()]
    bounds = np.concatenate([[0], np.cumsum([len(b) for b in bags])]).astype(np.int64)
    return train(np.concatenate(bags).astype(np.float64) if bags else np.zeros((0, WIDTH)), bounds, rows.column("label").to_numpy().astype(np.float64))


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row; only the text is looked at.

    Defined cases: of several labels of one doc_id the largest counts; null and
    empty texts are one passage of zeros and get a score like any other; every passage of a long text counts; null doc_ids and repeated
    rows are scored like others; other columns are ignored; an empty table gives
    an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, raw, offsets in text_slices(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, stop - row), pa.array(score_passages(shared.value, *encode_passages(raw, offsets)), pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
