"""Phrase collocations against brute force; the query itself is compared with its SQL in test_contracts."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tagloom.llm import collocations as C


def brute(rows, least=30, top=2000, covered=80):
    words_of, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            words_of[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    f[(lang, *words[i : i + m])] += 1
    out = {}
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    around = Counter()
    for p, a in candidates.items():
        for m in range(2, len(p) - 1):
            for i in range(1, len(p) - m + 1):
                inner = (p[0], *p[i : i + m])
                around[inner] = max(around[inner], a)
    for p, a in candidates.items():
        if around[p] and 100 * around[p] >= covered * a:
            continue
        cuts = [(2_000_000 * a // (f[p[:k]] + f[(p[0], *p[k:])]), k, f[p[:k]], f[(p[0], *p[k:])]) for k in range(2, len(p))]
        score, _, left, right = min(cuts)
        out.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), left, right))
    return sorted((lang, k + 1, phrase.decode(), -a, left, right, words_of[lang], -score) for lang, found in out.items() for k, (score, a, phrase, left, right) in enumerate(sorted(found)[:top]))


def result(frame):
    assert frame.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in frame.collect())


def test_prefixes_are_those_of_a_count():
    rng = np.random.default_rng(3)
    for _ in range(30):
        keys = rng.zipf(1.6, (400, 4)).clip(0, 30).astype(np.int32) - 1
        for row in keys:
            row[rng.integers(2, 5) :] = -1
        weights = rng.integers(1, 4, 400)
        want = Counter()
        for row, w in zip(keys, weights, strict=True):
            for depth in range(1, 5):
                if row[depth - 1] < 0:
                    break
                want[tuple(row[:depth])] += int(w)
        got = [(tuple(keys[row, :depth]), w) for row, depth, w in C.frequent_prefixes(keys, weights, 12)]
        assert len(got) == len(dict(got))
        assert dict(got) == {p: w for p, w in want.items() if w >= 12}


@pytest.mark.parametrize("held", [5, 10_000])
def test_suffixes_of_a_long_piece(monkeypatch, held):
    """Cut into stretches, and taken in parts, a text has the same suffixes."""
    monkeypatch.setattr(C, "STRETCH", 10)
    text = "Aa bb\tcc dd  ee ff gg hh ii jj kk ll mm, nn\noo " + "x" * 50 + " pp"
    parts = list(C.stretches(text))
    assert len(parts) > 4
    assert [w for words in parts for w in words if w not in (b"", b"\n")] == text.lower().replace(",", " ").encode().split()
    mine = C.Suffixes(C.WordTable(b"\xff" * 8192, b"\0" * 8192), "en")
    rows = []
    for words in parts:
        mine.add(words)
        if mine.held >= held:
            rows += mine.take(3, False)
    mine.end()
    rows += mine.take(3, True)
    found = Counter()
    for _, lead, *blob in rows:
        keys, weights, names = C._pointers([blob])
        assert lead == 2
        for key, n in zip(keys, weights, strict=True):
            found[b" ".join(names[k] for k in key if k >= 0)] += int(n)
    pieces = [re.findall(r"[^\x20\x09]+", p) for p in re.split("[,\n]", text.lower())]
    assert found == Counter(" ".join(p[i : i + 4]).encode() for p in pieces for i in range(len(p) - 1))


ROWS = [
    ("en", "New York City. new YORK city, the york; a\tb c d e " * 20, 1),
    ("en", "the the the the the the " * 30, 1),
    (None, "one two three " * 40, 2),
    ("de", None, 3),
    ("de", "", 3),
    ("fr", "a b", None),
    ("fr", "l'été là-bas! ÉTÉ là-bas " * 35, None),
]


@pytest.mark.parametrize("capacity", [C.CAPACITY, 40])
def test_rows_of_any_kind(spark, monkeypatch, capacity):
    """Hot words, flushed tasks and small buckets give the counts of brute force."""
    monkeypatch.setattr(C, "TASK_KEYS", 7)
    monkeypatch.setattr(C, "TASK_WORDS", 50)
    monkeypatch.setattr(C, "STRETCH", 64)
    rng = random.Random(capacity)
    vocabulary = ["the", "of", "and", "red", "fox", "runs", "far"] + [f"w{i}" for i in range(12)]
    rows = ROWS + [(rng.choice(["en", "fr"]), " ".join(rng.choice(vocabulary[: rng.choice([3, 7, 19])]) + rng.choice(["", "", "", ",", "."]) for _ in range(120)), 1) for _ in range(60)]
    rows += rows[-3:]
    docs = spark.createDataFrame(rows, "lang string, text string, phrase long").withColumn("n", docs_literal()).repartition(3)
    assert result(C.collocations(docs, capacity=capacity)) == brute([r[:2] for r in rows])
    assert result(C.collocations(docs, top=3, least=5, capacity=capacity)) == brute([r[:2] for r in rows], 5, 3)


def docs_literal():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert C.collocations(docs).collect() == []
    assert C.collocations(spark.createDataFrame([("en", None)], "lang string, text string")).collect() == []


def test_products_beyond_64_bits(spark):
    big = 6 * 10**18
    phrases = spark.createDataFrame([("en", "x y", 2, big)], "lang string, phrase string, words int, a long")
    words = spark.createDataFrame([("en", "x", big), ("en", "y", big + 1)], "lang string, word string, n long")
    assert [tuple(r) for r in C._scored(phrases, phrases, words, C.SCALE).collect()] == [("en", "x y", big, big, big + 1, 2_000_000 * big // (2 * big + 1))]


def test_ranks_are_settled_in_two_steps(spark):
    rows = spark.createDataFrame([("en", f"p {i}", 30 + i % 3, i % 7) for i in range(300)], "lang string, phrase string, a long, score long")
    got = [(r["rank"], r["phrase"]) for r in C._first(rows, 50, salts=8).orderBy("rank").collect()]
    want = sorted(range(300), key=lambda i: (-(i % 7), -(30 + i % 3), f"p {i}"))[:50]
    assert got == [(k + 1, f"p {i}") for k, i in enumerate(want)]
