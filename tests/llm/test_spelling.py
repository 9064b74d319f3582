"""Spelling variants against brute force."""

import itertools
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import pytest

from tagloom.llm import spelling
from tagloom.llm.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def brute_counts(rows, slip=199):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode()) & 0xFFFFFFFF
            if h % slip == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 6:
                counts[word] += 1
    return {w: n for w, n in counts.items() if n >= 5}


def brute(counts, ratio=5):
    near = {w: [] for w in counts}
    for a, b in itertools.combinations(counts, 2):
        if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(rows)


def result(frame):
    return sorted((tuple(r) for r in frame.collect()))


def test_acceptor_is_minimal_and_pairs_are_all():
    rng = random.Random(5)
    for _ in range(60):
        words = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(0, 7))) for _ in range(40)})
        machine = spelling.Acceptor(words)
        seen, todo = {}, [(0, "")]
        accepted = []
        while todo:
            state, text = todo.pop()
            seen[state] = True
            if machine.final[state]:
                accepted.append(text)
            todo += [(to, text + c) for c, to in machine.edges[state].items()]
        assert sorted(accepted) == words
        rights = {(machine.final[s], tuple(machine.edges[s].items())) for s in seen}
        assert len(rights) == len(seen)
        pairs = [tuple(sorted(p)) for p in spelling.near_pairs(words)]
        assert len(pairs) == len(set(pairs))
        assert set(pairs) == {p for p in itertools.combinations(words, 2) if one_edit(*p)}
        early = {p for p in pairs if next((i for i in range(len(p[0])) if p[0][i] != p[1][i : i + 1]), len(p[0])) < 2}
        assert {tuple(sorted(p)) for p in spelling.near_pairs(words, last=2)} == early


def test_long_words():
    long = "ab" * 20_000
    assert list(spelling.near_pairs(sorted([long, long[1:], long + "b"]))) != []


@pytest.mark.parametrize("limit", [8192, 12, 1])
def test_near_words_of_crowded_partitions(spark, limit):
    """However small the partitions are, every pair is found once."""
    rng = random.Random(7)
    words = {"".join(rng.choice("abà") for _ in range(rng.randrange(6, 10))) for _ in range(250)} | {"aaaaaa", "aaaaaaa", "aaaaaaaa", "aabaaa", "abcabc", "abcabcd", "zabcabc"}
    counts = {w: rng.randrange(5, 50) for w in words}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = [tuple(r) for r in spelling.near_words(frame, limit).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b, counts[b]) for a, b in itertools.permutations(words, 2) if one_edit(a, b)}


def test_a_hot_partition_is_dealt_out(spark):
    words = spark.createDataFrame([(f"common{chr(97 + i // 26 // 26)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}", 5) for i in range(3000)], "word string, n long")
    sizes = spelling._initial_states(words, 100).groupBy("state").count().agg({"count": "max"}).first()[0]
    assert sizes <= 100


def test_variants(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TASK_WORDS", 3)
    monkeypatch.setattr(spelling, "LONG_TEXT", 50)
    text = "spelling " * 700 + "speling " * 130 + "spellings " * 20 + "Spelng " * 25 + "speln " * 9 + "Élèves, élèves ÉLÈVES " * 6 + "abcdef abcdeg " * 5 + "straße×÷ "
    rows = [(1, text, 1), (2, "speling", 1), (2, "speling", 1), (3, None, None), (4, "", 2), (None, "spelling", 3), (5, "short words", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long").withColumnRenamed("n", "word")
    got = result(spelling.spelling_variants(docs))
    assert got == brute(brute_counts([(i, t) for i, t, _ in rows]))
    roots = {r[0]: r[2] for r in got}
    assert roots["speling"] == roots["spelng"] == "spelling"
    assert spelling.spelling_variants(docs.where("doc_id = 99")).collect() == []


def test_chain_of_forms(spark):
    counts = [("aaaaaaaa", 5), ("aaaaaaab", 25), ("aaaaaabb", 125), ("aaaaabbb", 625), ("aaaabbbb", 3125), ("aaabbbbb", 15_625), ("aabbbbbb", 78_125), ("abbbbbbb", 390_625)]
    forms = [(a, b) for (a, _), (b, _) in itertools.pairwise(counts)]
    roots = spelling._with_roots(spark.createDataFrame(forms, "word string, form string"), counts[-1][1], 5)
    assert dict(map(tuple, roots.collect())) == {w: counts[-1][0] for w, _ in counts[:-1]}


@pytest.mark.skipif(not DATA.exists(), reason="no tables")
def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_spelling_variants"](spark, str(DATA))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert result(got) == brute(brute_counts(rows))
