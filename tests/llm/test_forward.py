"""Whole scores of the classifiers, and words of the mix, against plain loops."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from tagloom.llm import mixing, quality_mil, toxicity

TEXTS = ["", "one", "the cat and the dog went to the river", "word, " * 300, "der Hund und die Katze " * 40 + "### 12 ###", "a b\nc\td"]


def joined(texts):
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    return raw, np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def test_quality_score_is_that_of_plain_loops():
    rng = np.random.default_rng(2)
    shapes = {"W": (quality_mil.WIDTH, quality_mil.HIDDEN), "b": (quality_mil.HIDDEN,), "V": (quality_mil.HIDDEN, quality_mil.ATTENTION), "U": (quality_mil.HIDDEN, quality_mil.ATTENTION), "w": (quality_mil.ATTENTION,), "c": (quality_mil.HIDDEN,), "d": ()}
    w = {k: rng.normal(0, 0.4, s) for k, s in shapes.items()}
    model = quality_mil.Model(rng.normal(0, 0.1, quality_mil.WIDTH), rng.uniform(0.5, 2, quality_mil.WIDTH), w)
    got = quality_mil.score_passages(model, *quality_mil.encode_passages(*joined(TEXTS)))
    for text, score in zip(TEXTS, got, strict=True):
        passages, bounds = quality_mil.encode_passages(*joined([text]))  # alone: the others must not matter
        assert len(passages) == bounds[1] == max(1, math.ceil(len(text.split()) / quality_mil.PASSAGE))
        hidden, energies = [], []
        for p in passages:
            x = [max(-8.0, min(8.0, (v - m) / s)) for v, m, s in zip(p, model.mean, model.scale, strict=True)]
            h = [math.tanh(sum(a * b for a, b in zip(x, column, strict=True)) + bias) for column, bias in zip(w["W"].T, w["b"], strict=True)]
            gate = lambda matrix, squash: [squash(sum(a * b for a, b in zip(h, column, strict=True))) for column in matrix.T]  # noqa: B023, E731
            energies.append(sum(a * b * c for a, b, c in zip(gate(w["V"], math.tanh), gate(w["U"], sigmoid), w["w"], strict=True)))
            hidden.append(h)
        total = sum(math.exp(e) for e in energies)
        pooled = [sum(math.exp(e) / total * h[k] for e, h in zip(energies, hidden, strict=True)) for k in range(quality_mil.HIDDEN)]
        assert score == pytest.approx(sigmoid(sum(a * b for a, b in zip(pooled, w["c"], strict=True)) + w["d"]), abs=1e-6)


def test_toxicity_score_is_that_of_plain_loops():
    rng = np.random.default_rng(3)
    T = toxicity
    model = T.Model(
        rng.normal(0, 0.5, (T.KINDS, T.BUCKETS, T.DIMENSION)).astype(np.float32), [rng.normal(0, 0.5, (n, T.DIMENSION, T.FILTERS)).astype(np.float32) for n in T.WIDTHS],
        rng.normal(0, 0.1, T.POOLED).astype(np.float32), rng.normal(0, 0.3, T.POOLED).astype(np.float32), -0.4, rng.uniform(0.2, 0.8, len(T._LANGUAGES)),
    )
    got, languages = T.score_texts(model, *joined(TEXTS))
    for text, score, language in zip(TEXTS, got, languages, strict=True):
        _, slots, _ = T.text_words(*joined([text]))
        vectors = [[sum(float(model.tables[k, own[k], j]) for k in range(T.KINDS)) for j in range(T.DIMENSION)] for own in slots]
        logit = model.offset
        for k, width in enumerate(T.WIDTHS):
            for f in range(T.FILTERS):
                places = range(len(vectors) - width + 1)
                responses = [sum(vectors[p + j][d] * float(model.filters[k][j, d, f]) for j in range(width) for d in range(T.DIMENSION)) + float(model.biases[k * T.FILTERS + f]) for p in places]
                logit += max([0.0, *responses]) * float(model.output[k * T.FILTERS + f])
        bar = model.thresholds[language]
        shift = math.log(T.DECISION / (1 - T.DECISION)) - math.log(bar / (1 - bar))
        assert score == pytest.approx(1 / (1 + math.exp(-(max(-30.0, min(30.0, logit)) + shift))), abs=1e-4)


def test_taken_words_are_those_of_the_spans(spark):
    """Blocks of a source's stream are whole, each is taken equally often but for one, and documents get their words of them."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 400))), f"s{i % 3}" if i % 7 else None) for i in range(90)] + [(5, "w " * 70, "s2"), (5, "w " * 70, "s2"), (200, None, "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = mixing.taken_words(docs).collect()
    spans = mixing.mix_spans(docs).collect()
    words, blocks, sizes = Counter(), defaultdict(Counter), Counter()
    for s in spans:
        words[s["doc_id"]] += s["n_words"]
        blocks[s["source"]][s["block"], s["out_shard"], s["slot"]] += s["n_words"]
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    by_doc = Counter()
    for r in taken:
        by_doc[r["doc_id"]] += r["taken"]
    assert by_doc == {d: words[d] for d in by_doc}
    for source, slots in blocks.items():
        last = (sizes[source] - 1) // 64
        assert all(n == (64 if block < last else sizes[source] - 64 * last) for (block, *_), n in slots.items())
        uses = Counter(block for block, *_ in slots)
        assert max(uses.values()) - min(uses[b] for b in range(last + 1)) <= 1
