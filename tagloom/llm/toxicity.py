"""Toxicity by a convolutional text classifier trained in numpy.

Words are embedded by hashes of the whole word and of its beginnings; filters of
several widths slide over the words, the largest response of each filter is kept,
and a linear layer scores them. A part of each embedding starts as the evidence
that the hash gives by itself, a lower bound of its log odds in the training texts,
so that few labels suffice. Thresholds are calibrated for each language that the
text itself suggests.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import hash_spans, text_slices
from tagloom.llm.decontaminate import folded_words
from tagloom.llm.quality_mil import training_sample

BUCKETS = 1 << 16
DIMENSION = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Bytes of a word's beginnings; with the whole word, the kinds of hashes of a word.
PREFIXES = (4, 6, 8)
KINDS = 1 + len(PREFIXES)
POOLED = FILTERS * len(WIDTHS)
#: The score of a text at its language's threshold.
DECISION = 0.7

# Function words by which a text's language is guessed.
LANGUAGE_WORDS = {
    "en": "the of and to in is that for was with on as are this by it from at".split(),
    "fr": "de la le les des et est un une du que qui dans pour au sur pas avec".split(),
    "de": "der die das und ist von zu den mit nicht ein eine auf im sich für dem als".split(),
    "es": "de la el los las y una por con para del se no es lo que en al".split(),
}


def text_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, slots of each word and its beginnings (a row per word), first word per text."""
    raw, inside = folded_words(raw)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins, closes = offsets[:-1][offsets[:-1] < len(raw)], offsets[1:][offsets[1:] > 0] - 1
    first[begins] |= inside[begins]
    last[closes] |= inside[closes]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    words = hash_spans(raw, starts, ends)
    kinds = [words, *(hash_spans(raw, starts, np.minimum(ends, starts + n)) for n in PREFIXES)]
    return words, np.stack([(h % np.uint64(BUCKETS)).astype(np.uint16) for h in kinds], axis=1), np.searchsorted(starts, offsets)


def _language_table() -> np.ndarray:
    """Bit k of entry h: a function word of language k has the low hash bits h."""
    table = np.zeros(1 << 16, np.uint8)
    for k, words in enumerate(LANGUAGE_WORDS.values()):
        for word in words:
            raw = np.frombuffer(word.encode(), np.uint8)
            table[int(hash_spans(raw, np.array([0]), np.array([len(raw)]))[0]) & 0xFFFF] |= 1 << k
    return table


_LANGUAGES = list(LANGUAGE_WORDS)
_TABLE = _language_table()


def guess_languages(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of the language with the most function words; of equals, the first."""
    marks = _TABLE[(words & np.uint64(0xFFFF)).astype(np.int64)]
    sums = np.zeros((len(_LANGUAGES), len(words) + 1), np.int32)
    for k in range(len(_LANGUAGES)):
        np.cumsum((marks >> k) & 1, out=sums[k, 1:])
    return (sums[:, first[1:]] - sums[:, first[:-1]]).argmax(axis=0)


class Model(NamedTuple):
    """Tables hold KINDS x BUCKETS vectors; the first KINDS places of a vector are evidence."""

    tables: np.ndarray
    filters: list[np.ndarray]
    biases: np.ndarray
    output: np.ndarray
    offset: float
    thresholds: np.ndarray


def slots_of_texts(slots: np.ndarray, first: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """By kind, (text, slot) of the slots that a text holds, each once."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    once = [np.unique(text * BUCKETS + slots[:, k]) for k in range(KINDS)]
    return [((pairs // BUCKETS).astype(np.int32), (pairs % BUCKETS).astype(np.uint16)) for pairs in once]


def _texts_per_slot(held: list[tuple[np.ndarray, np.ndarray]], chosen: np.ndarray) -> np.ndarray:
    """Texts among ``chosen`` (a flag of each text) that hold each slot, by kind."""
    return np.stack([np.bincount(slot[chosen[text]], minlength=BUCKETS) for text, slot in held])


def evidence(toxic: np.ndarray, clean: np.ndarray, all_toxic: int, all_clean: int, deviations: float = 1.5) -> np.ndarray:
    """Log odds of a slot in so many toxic and clean texts, as far as they surely differ from 0."""
    toxic, clean = np.maximum(toxic, 0) + 0.5, np.maximum(clean, 0) + 0.5
    odds = np.log(toxic / (all_toxic + 1)) - np.log(clean / (all_clean + 1))
    return (np.sign(odds) * np.maximum(0, np.abs(odds) - deviations * np.sqrt(1 / toxic + 1 / clean))).astype(np.float32)


def _embed(tables: np.ndarray, slots: np.ndarray) -> np.ndarray:
    x = tables[0][slots[:, 0]]
    for k in range(1, KINDS):
        x = x + tables[k][slots[:, k]]
    return x


def _convolve(filters: list[np.ndarray], biases: np.ndarray, x: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Rectified response of each filter at each word; none across the end of a text."""
    flat = x @ np.concatenate([f.transpose(1, 0, 2).reshape(DIMENSION, -1) for f in filters], axis=1)
    out = np.zeros((len(x), POOLED), x.dtype)
    column = 0
    for k, width in enumerate(WIDTHS):
        part = out[:, k * FILTERS : (k + 1) * FILTERS]
        n = len(x) - width + 1
        if n > 0:
            for j in range(width):
                part[:n] += flat[j : j + n, column + j * FILTERS : column + (j + 1) * FILTERS]
        part += biases[k * FILTERS : (k + 1) * FILTERS]
        for j in range(1, width):
            part[last[last >= j - 1] - (j - 1)] = 0
        column += width * FILTERS
    return np.maximum(out, 0, out=out)


def _pooled(model: Model, slots: np.ndarray, first: np.ndarray) -> np.ndarray:
    counts = np.diff(first)
    some = np.flatnonzero(counts)
    pooled = np.zeros((len(counts), POOLED), np.float32)
    if len(some):
        response = _convolve(model.filters, model.biases, _embed(model.tables, slots), first[1:][some] - 1)
        pooled[some] = np.maximum.reduceat(response, first[:-1][some], axis=0)
    return pooled


def _logit(model: Model, pooled: np.ndarray) -> np.ndarray:
    return np.clip(pooled @ model.output + model.offset, -30, 30)


class Gradient(NamedTuple):
    loss: float
    x: tuple[np.ndarray, np.ndarray]
    filters: list[np.ndarray]
    biases: np.ndarray
    output: np.ndarray
    offset: float


def gradient(filters: list[np.ndarray], biases: np.ndarray, output: np.ndarray, offset: float, x: np.ndarray, bounds: np.ndarray, labels: np.ndarray, weight: np.ndarray, keep: np.ndarray) -> Gradient:
    """Weighted log loss of texts (no empty one) and its slopes; ``x`` as (word, slope) of the words that pooling chose."""
    response = _convolve(filters, biases, x, bounds[1:] - 1)
    peak = np.stack([response[a:b].argmax(axis=0) + a for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
    pooled = np.take_along_axis(response, peak, axis=0)
    dropped = pooled * keep
    logit = np.clip(dropped @ output + offset, -30, 30)
    error = ((1 / (1 + np.exp(-logit)) - labels) * weight).astype(x.dtype)
    to_pool = error[:, None] * output * (pooled > 0) * keep
    places, slopes, to_filters = [], [], []
    for k, width in enumerate(WIDTHS):
        cut = slice(k * FILTERS, (k + 1) * FILTERS)
        slope, where = to_pool[:, cut], peak[:, cut]
        own = np.zeros_like(filters[k])
        for j in range(width):
            spot = np.minimum(where + j, bounds[1:][:, None] - 1)
            own[j] = np.einsum("nf,nfd->df", slope, x[spot])
            places.append(spot.ravel())
            slopes.append((slope[:, :, None] * filters[k][j].T[None]).reshape(-1, DIMENSION))
        to_filters.append(own)
    loss = float((weight * (np.logaddexp(0, logit) - labels * logit)).sum())
    return Gradient(loss, (np.concatenate(places), np.concatenate(slopes)), to_filters, to_pool.sum(axis=0), dropped.T @ error, float(error.sum()))


def _learn(slots: np.ndarray, first: np.ndarray, held: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, docs: np.ndarray, visits: int, rate: float, seed: int) -> Model:
    """Adagrad over ``docs``; a text is shown the evidence of the other texts only."""
    rng = np.random.default_rng(seed)
    among = np.isin(np.arange(len(labels)), docs)
    toxic, clean = int(labels[docs].sum()), int((1 - labels[docs]).sum())
    seen = _texts_per_slot(held, among & (labels == 1)), _texts_per_slot(held, among & (labels == 0))
    others = [evidence(seen[0] - y, seen[1] - (1 - y), toxic - y, clean - (1 - y)) for y in (0, 1)]
    # what only few texts hold keeps a vector without free places
    common = (seen[0] + seen[1] >= max(3, len(docs) // 500)).astype(np.float32)[:, :, None]
    tables = np.zeros((KINDS, BUCKETS, DIMENSION), np.float32)
    tables[:, :, KINDS:] = rng.normal(0, 0.05, (KINDS, BUCKETS, DIMENSION - KINDS)) * common
    filters = [rng.normal(0, 0.2, (w, DIMENSION, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:  # the first filter of a width begins as a reader of evidence
        f[0, :KINDS, 0] = 0.5
    biases, output = np.full(POOLED, 0.01, np.float32), rng.normal(0, 0.1, POOLED).astype(np.float32)
    output[::FILTERS], offset = 0.5, -1.0
    past = [np.full((KINDS, BUCKETS, 1), 1e-4, np.float32), [np.full_like(f, 1e-4) for f in filters], np.full(POOLED, 1e-4), np.full(POOLED, 1e-4), 1e-4]
    share = labels[docs].mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    counts = np.diff(first)
    for _ in range(int(np.clip(visits // len(docs), 2, 20))):
        order = rng.permutation(docs)
        for begin in range(0, len(order), 32):
            own = order[begin : begin + 32]
            own = own[counts[own] > 0]
            if not len(own):
                continue
            sizes = counts[own]
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            at = np.repeat(first[own] - bounds[:-1], sizes) + np.arange(bounds[-1])
            words, is_toxic = slots[at], np.repeat(labels[own] == 1, sizes)
            x = _embed(tables, words)
            for k in range(KINDS):
                x[:, k] = np.where(is_toxic, others[1][k][words[:, k]], others[0][k][words[:, k]])
            keep = ((rng.random((len(own), POOLED)) < 0.8) / 0.8).astype(np.float32)
            g = gradient(filters, biases, output, offset, x, bounds, labels[own], weight[own] / len(own), keep)
            places, slopes = g.x
            slopes = slopes[:, KINDS:]
            for k in range(KINDS):
                rows, inverse = np.unique(words[places, k], return_inverse=True)
                total = np.zeros((len(rows), DIMENSION - KINDS), np.float32)
                np.add.at(total, inverse, slopes)
                total = (total + 1e-4 * tables[k][rows][:, KINDS:]) * common[k][rows]
                past[0][k][rows] += (total**2).mean(axis=1, keepdims=True)
                tables[k][rows, KINDS:] -= 0.3 * rate * total / np.sqrt(past[0][k][rows])
            for k, step in enumerate(g.filters):
                step = step + 1e-4 * filters[k]
                past[1][k] += step**2
                filters[k] -= rate * step / np.sqrt(past[1][k])
            step = g.output + 1e-4 * output
            past[2] += step**2
            output = (output - rate * step / np.sqrt(past[2])).astype(np.float32)
            past[3] += g.biases**2
            biases = (biases - 0.3 * rate * g.biases / np.sqrt(past[3])).astype(np.float32)
            past[4] += g.offset**2
            offset -= rate * g.offset / np.sqrt(past[4])
    whole = evidence(seen[0], seen[1], toxic, clean)
    for k in range(KINDS):
        tables[k, :, k] = whole[k]
    return Model(tables, filters, biases, output, offset, np.full(len(_LANGUAGES), 0.5))


def _raw_scores(model: Model, slots: np.ndarray, first: np.ndarray, docs: np.ndarray) -> np.ndarray:
    out = np.zeros(len(docs))
    for k, text in enumerate(docs):  # one by one: responses of all at once would fill the driver
        own = slice(first[text], first[text + 1])
        out[k] = 1 / (1 + np.exp(-_logit(model, _pooled(model, slots[own], np.array([0, own.stop - own.start])))[0]))
    return out


def train(slots: np.ndarray, first: np.ndarray, labels: np.ndarray, languages: np.ndarray, visits: int = 24_000, rate: float = 0.05, folds: int = 3, seed: int = 9) -> Model:
    """Thresholds from cross-fitted scores, then a model of all texts.

    Texts are visited about ``visits`` times for the model and as often for the
    ``folds`` models that score the texts they have not seen, each 2 to 20 times.
    Without two texts of each class, every score is 0.5, below DECISION.
    """
    if len(labels) == 0 or min(labels.sum(), (1 - labels).sum()) < 2:
        empty = [np.zeros((w, DIMENSION, FILTERS), np.float32) for w in WIDTHS]
        return Model(np.zeros((KINDS, BUCKETS, DIMENSION), np.float32), empty, np.zeros(POOLED, np.float32), np.zeros(POOLED, np.float32), 0.0, np.full(len(_LANGUAGES), DECISION))
    rng = np.random.default_rng(seed)
    fold = np.zeros(len(labels), int)
    for y in (0, 1):  # each class is dealt evenly
        own = rng.permutation(np.flatnonzero(labels == y))
        fold[own] = np.arange(len(own)) % min(folds, max(2, len(own)))
    held = slots_of_texts(slots, first)
    scores = np.zeros(len(labels))
    for f in range(fold.max() + 1):
        rest = np.flatnonzero(fold != f)
        if 0 < labels[rest].sum() < len(rest):
            own = np.flatnonzero(fold == f)
            scores[own] = _raw_scores(_learn(slots, first, held, labels, rest, visits // folds, rate, seed), slots, first, own)
    model = _learn(slots, first, held, labels, np.arange(len(labels)), visits, rate, seed)
    return model._replace(thresholds=_calibrate(scores, labels, languages))


def _best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the widest gap among thresholds of the best F1."""
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + labels.sum())
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    sorted_scores = np.append(scores[order], 0.0)
    gaps = sorted_scores[best] - sorted_scores[best + 1]
    k = best[gaps.argmax()]
    return float(np.clip((sorted_scores[k] + sorted_scores[k + 1]) / 2, 0.02, 0.98))


def _calibrate(scores: np.ndarray, labels: np.ndarray, languages: np.ndarray, strength: float = 20.0) -> np.ndarray:
    """A threshold per language, drawn to that of all texts as far as it has few toxic ones."""
    logit = lambda p: np.log(p / (1 - p))
    every = _best_threshold(scores, labels)
    out = np.full(len(_LANGUAGES), every)
    for k in range(len(_LANGUAGES)):
        own = languages == k
        if n := labels[own].sum():
            mixed = (n * logit(_best_threshold(scores[own], labels[own])) + strength * logit(every)) / (n + strength)
            out[k] = 1 / (1 + np.exp(-mixed))
    return out


def score_texts(model: Model, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Calibrated scores and guessed languages: a text at its threshold scores DECISION."""
    words, slots, first = text_words(raw, offsets)
    language = guess_languages(words, first)
    bar = model.thresholds[language]
    shift = np.log(DECISION / (1 - DECISION)) - np.log(bar / (1 - bar))
    return 1 / (1 + np.exp(-(_logit(model, _pooled(model, slots, first)) + shift))), language


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_docs: int = 12_000) -> Model:
    """Learn from at most ``max_docs`` labelled documents; the hashes of their words go to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, raw, offsets in text_slices(batch.column("text")):
                words, slots, first = text_words(raw, offsets)
                language = guess_languages(words, first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, stop - row), batch.column("label").slice(row, stop - row), pa.array(language.astype(np.int32)), pa.array([slots[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())],
                    ["doc_id", "label", "language", "slots"],
                )

    sample = training_sample(docs, labels, label, max_docs).select(F.col("doc_id").cast("long"), "label", "text")
    rows = sample.mapInArrow(run, "doc_id long, label int, language int, slots binary").toArrow().sort_by([("doc_id", "ascending"), ("slots", "ascending")])
    first = np.concatenate([[0], np.cumsum([len(v.as_py()) // (2 * KINDS) for v in rows.column("slots")])]).astype(np.int64)
    slots = np.frombuffer(b"".join(v.as_py() for v in rows.column("slots")), np.uint16).reshape(-1, KINDS)
    marks, languages = rows.column("label").to_numpy().astype(np.float64), rows.column("language").to_numpy()
    del rows  # as large as the slots
    return train(slots, first, marks, languages)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, language) of every row; only the text is looked at.

    A text at the threshold calibrated for its guessed language scores DECISION.
    Defined cases: of several labels of one doc_id the largest counts; null and
    empty texts hold no word and get the score of no response; a text shorter than a filter has no response of that filter; every
    word of a long text counts; null doc_ids and repeated rows are scored like
    others; other columns are ignored; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = np.array(_LANGUAGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, raw, offsets in text_slices(batch.column("text")):
                score, language = score_texts(shared.value, raw, offsets)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, stop - row), pa.array(score, pa.float64()), pa.array(names[language].tolist(), pa.string())], ["doc_id", "score", "language"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, language string")
