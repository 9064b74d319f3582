"""Training-data operators on small rows: nulls, empty and long texts, ties, repeated rows, extra columns."""

import itertools
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.llm import decontaminate, line_dedup, mixing, ngram_join, quality_mil, quality_rules, sharding, toxicity, url_filter, warc
from tagloom.llm.common import connected_components, gram_hashes, hash_spans, scratch_path, split_words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, quality string, digest string, key string, part int"
LONG = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, LONG, "en", "a", 1, "x", "x", "x", 0),
    (2, LONG, "en", "a", 1, "x", "x", "x", 0),
    (2, LONG, "en", "a", 1, "x", "x", "x", 0),
    (3, LONG.replace("w30", "other"), "en", "b", 1, "x", "x", "x", 0),
    (4, "", "en", None, 0, None, None, None, None),
    (5, None, None, None, None, None, None, None, None),
    (None, LONG, None, "b", None, None, None, None, None),
    (6, "one two", "en", "a", 7, "x", "x", "x", 0),
    (7, "one two", "en", "a", 7, "x", "x", "x", 0),
    (8, " \n\t ", "en", "a", 4, "x", "x", "x", 0),
    (9, "word " * 30_000, "en", "b", 150_000, "x", "x", "x", 0),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# ------------------------------------------------------------- shared helpers


def test_words_and_grams():
    raw = np.frombuffer(b"a bb\ta b c d e f", np.uint8)
    starts, ends, first = split_words(raw, np.array([0, 4, 5, len(raw)]))
    assert [bytes(raw[a:b]) for a, b in zip(starts, ends, strict=True)] == [b"a", b"bb", b"a", b"b", b"c", b"d", b"e", b"f"]
    assert first.tolist() == [0, 2, 2, 8]
    hashes = hash_spans(raw, starts, ends)
    assert hashes[0] == hashes[2]
    assert len(set(hashes.tolist())) == 7
    grams, bounds = gram_hashes(hashes, first, 5)
    assert bounds.tolist() == [0, 1, 1, 3]


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (200, 200)]
    found = dict(connected_components(spark.createDataFrame(edges, "src long, dst long"), "t").collect())
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


# --------------------------------------------------------------------- op 1


def test_warc_round_trip(spark):
    body = "x" * 2000
    pages = [(1, "http://a/", body), (2, "http://b/\r\nX: y", body), (3, None, body + "é"), (4, "u", None), (5, "u", "short"), (6, "u", "short"), (None, "u", body), (7, "u", "WARC/1.1\r\n\r\n" + body), (7, "u", "WARC/1.1\r\n\r\n" + body), (8, "u", "")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    found = warc.archive_pages(frame, scratch_path(spark, "w")).collect()
    got = sorted(((r["page_id"] if r["page_id"] is not None else -1), r["payload_bytes"], r["record_type"], r["refers_to"]) for r in found)
    assert got == [(-1, 2000, "revisit", 2), (1, 2000, "revisit", 2), (2, 2000, "response", None), (3, 2002, "response", None), (4, 0, "response", None), (5, 5, "response", None), (6, 5, "response", None), (7, 2012, "response", None), (7, 2012, "response", None), (8, 0, "response", None)]


def test_warc_index_reads_selected_records(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i} " * 100) for i in range(50)], "page_id long, url string, html string")
    path = scratch_path(spark, "w")
    warc.write_warc(warc.plan_records(pages), path)
    index = warc.index_warc(spark, path)
    assert index.count() == 50
    read = warc.read_records(index.where("url IN ('http://h/7', 'http://h/33')")).collect()
    assert {(r["record_id"], bytes(r["payload"]).decode()) for r in read} == {(str(i), f"page {i} " * 100) for i in (7, 33)}


def test_warc_empty(spark):
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string"), scratch_path(spark, "w")).count() == 0


# --------------------------------------------------------------------- op 2


def test_quality_rules(docs, none):
    found = {(r["doc_id"], r["n_chars"]): r["quality"] for r in quality_rules.with_quality(docs).collect()}
    assert (found[4, 0]["n_words"], found[5, None]["n_words"], found[5, None]["base_failed"]) == (0, 0, True)
    assert found[9, 150_000]["n_repeat_words"] == 30_000
    assert found[1, 1]["n_repeat_words"] == 0
    assert quality_rules.with_quality(none).count() == 0
    kept = quality_rules.keep_quality(docs)
    assert kept.columns == docs.columns


def test_clean_text_is_kept(spark):
    text = "the quick fox of the wood and its kin went to the river in the night for water that was cold and clear as glass."
    frame = spark.createDataFrame([(1, text), (2, text.replace(" ", " ### "))], "doc_id long, text string")
    assert [r["doc_id"] for r in quality_rules.keep_quality(frame).collect()] == [1]


# --------------------------------------------------------------------- op 3


def test_leaks_with_edits(spark, docs, none):
    item = LONG.split()[:40]
    edited = item.copy()
    for k in (5, 14, 23, 31):
        edited[k] = "changed"
    far = [w if i % 3 else "far" for i, w in enumerate(item)]
    texts = {20: "before " * 9 + " ".join(item).upper() + " after" * 9, 21: "x y z " + " ".join(edited), 22: " ".join(far), 23: " ".join(item[:20])}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (4, "too short"), (None, LONG)], "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"], r["edit_distance"], r["at_word"]) for r in decontaminate.find_leaks(frame, bench).collect()) == [(20, 1, 0, 9), (21, 1, 4, 3)]
    assert decontaminate.find_leaks(none, bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    hit = decontaminate.find_leaks(docs, bench).collect()
    assert [r["item_id"] for r in hit].count(1) == 5
    assert len(hit) == 10  # the item without an id is an item too
    assert {r["doc_id"] for r in hit} == {1, 2, 3, None}
    assert sorted(r["doc_id"] for r in decontaminate.drop_leaks(docs, bench).collect()) == [4, 5, 6, 7, 8, 9]


@pytest.mark.parametrize("kind", ["replace", "insert", "delete"])
def test_lsh_recall_at_the_threshold(kind):
    """Share of items found after so many of their words were replaced, deleted, or others inserted at random."""
    rng = np.random.default_rng(0)
    draw = lambda n: rng.integers(1, 1 << 62, n, dtype=np.uint64) | np.uint64(1)
    items = [(i, draw(int(rng.integers(13, 60)))) for i in range(200)]
    index = decontaminate.build_index(items, 4, 5, 3, 5)
    for rate, least in ((0.0, 1.0), (0.05, 0.99), (0.1, 0.98), (0.15, 0.95), (0.2, 0.9)):
        texts, first = [], [0]
        for _, words in items:
            copy = words.tolist()
            for _ in range(int(rate * len(words))):
                at = int(rng.integers(len(copy)))
                copy[at : at + (kind != "insert")] = [] if kind == "delete" else draw(1).tolist()
            texts += [draw(50), np.array(copy, np.uint64)]
            first.append(first[-1] + 50 + len(copy))
        found = decontaminate.search(index, np.concatenate(texts), np.array(first), 0.2 + 1e-9)
        assert sum((k, k) in found for k in range(len(items))) / len(items) >= least
        assert all(a == b for a, b in found)


def test_leaks_fold_case_and_punctuation_of_any_script(spark):
    item = "Вот пример строки из нашего набора и ещё слова для проверки того как ищет поиск"
    texts = [(1, item.upper()), (2, item.replace(" ", "—")), (3, "«" + item.replace(" ", " … ") + "»"), (4, "совсем другой текст")]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = decontaminate.find_leaks(spark.createDataFrame(texts, "doc_id long, text string"), bench).collect()
    assert sorted((r["doc_id"], r["edit_distance"]) for r in found) == [(1, 0), (2, 0), (3, 0)]


def test_exact_copies_of_every_length_are_found():
    rng = np.random.default_rng(3)
    draw = lambda n: rng.integers(1, 1 << 62, n, dtype=np.uint64) | np.uint64(1)
    items = [(i, draw(8 + i % 23)) for i in range(920)]
    index = decontaminate.build_index(items, 3, 4, 3, 5)
    texts, first = [], [0]
    for _, words in items:
        texts += [draw(20), words, draw(20)]
        first.append(first[-1] + 40 + len(words))
    found = decontaminate.search(index, np.concatenate(texts), np.array(first), 0.2 + 1e-9)
    assert found == {(i, i): (0, 20) for i in range(len(items))}


def test_short_and_unspaced_items_are_found(spark):
    items = {
        1: "Paris", 2: "capital of France", 3: "who wrote the old play", 4: "what is the largest known prime",
        5: "\u6c34\u7684\u5316\u5b66\u5f0f\u662f\u4ec0\u4e48\uff0c\u4e3a\u4ec0\u4e48\u51b0\u4f1a\u6d6e\u5728\u6c34\u9762\u4e0a", 6: "\u5929\u7a7a", 7: "...",
    }
    texts = {
        1: "to paris by train", 2: "the Capital of France, seen", 3: "the capital of old France", 4: "Who wrote that old play?", 5: "wrote the old play", 6: "who wrote one old song",
        7: "is what is the very largest known prime", 8: "\u8bf7\u95ee" + items[5].replace("\uff0c", "\u3002").replace("\u51b0", "\u96ea") + "\u5417", 9: "\u5929\u7a7aparis", 10: "...", 11: "",
    }
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    found = decontaminate.find_leaks(frame, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"], r["edit_distance"]) for r in found) == [(1, 1, 0), (2, 2, 0), (4, 3, 1), (5, 3, 1), (7, 4, 1), (8, 5, 1), (9, 1, 0), (9, 6, 0)]


def test_short_items_equal_brute_force():
    rng = np.random.default_rng(8)
    items = [(i, rng.integers(0, 6, int(rng.integers(1, 13))).astype(np.uint64) * np.uint64(2) + np.uint64(1)) for i in range(60)]
    texts = [rng.integers(0, 6, int(n)).astype(np.uint64) * np.uint64(2) + np.uint64(1) for n in rng.integers(0, 14, 80)]
    first = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    found = decontaminate.search(decontaminate.build_index(items, 3, 4, 3, 5), np.concatenate(texts), first, 0.2 + 1e-9)
    want = {}
    for i, words in items:
        for t, text in enumerate(texts):
            row = [0] * (len(text) + 1)
            for n, word in enumerate(words, 1):
                old, row = row, [n]
                for m, other in enumerate(text):
                    row.append(min(old[m] + int(word != other), old[m + 1] + 1, row[m] + 1))
            if min(row) <= int(len(words) * (0.2 + 1e-9)):
                want[t, i] = min(row)
    assert {k: v[0] for k, v in found.items()} == want


# --------------------------------------------------------------------- op 4


def test_url_parts_and_rules(spark):
    urls = ["http://A.Example.ORG?x", "https://example.org/en/17", "https://m.example.org/es/", "ftp://x.com/fr/a#b", "no url", None, "http://notexample.org/es/", "http://org", "x://a/b://c/d"]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id int, url string")
    rules = [url_filter.UrlRule("allow", "org/"), url_filter.UrlRule("block", "example.org/es/"), url_filter.UrlRule("block", "example.org/en/1"), url_filter.UrlRule("allow", "com/fr/"), url_filter.UrlRule("block", "com/fr/")]
    empty = spark.createDataFrame([], "url string, bad boolean")
    found = [(r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(frame, empty, rules).orderBy("page_id").collect()]
    assert found == [
        ("a.example.org", "", None, "allow"), ("example.org", "/en/17", "example.org/en/1", "block"), ("m.example.org", "/es/", "example.org/es/", "block"), ("x.com", "/fr/a", "com/fr/", "block"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("notexample.org", "/es/", "org/", "allow"), ("org", "", None, "allow"), ("a", "/b://c/d", None, "allow"),
    ]
    parts = frame.select("page_id", url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"))
    joined = url_filter.with_rule(parts, rules, inline=0).collect()
    assert {(r["page_id"], r["rule"], r["rule_verdict"]) for r in joined} == {(r["page_id"], r["rule"], r["rule_verdict"]) for r in url_filter.with_rule(parts, rules).collect()}


def test_equally_long_rules_fit_alike_on_both_paths(spark):
    rules = [url_filter.UrlRule(*r) for r in (("allow", "b.org/xy"), ("block", "org/xyzw"), ("allow", "a.b.org/"), ("block", "b.org/x"), ("allow", "b.org/x"), ("allow", "org/xyz/"))]
    parts = spark.createDataFrame([("a.b.org", p) for p in ("/xy", "/xyzw", "/", "/x", "/xyz/")] + [("c.org", "/xyzw"), ("", "")], "host string, path string")
    few, many = ({tuple(r) for r in url_filter.with_rule(parts, rules, inline=n).collect()} for n in (1000, 0))
    assert few == many
    assert ("a.b.org", "/xyzw", "org/xyzw", "block") in few  # as long as two allow rules
    assert ("a.b.org", "/x", "a.b.org/", "allow") in few


def test_mined_rules_are_those_of_brute_force(spark):
    """Every set of tokens of every URL, counted; the same bar; implied rules dropped."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(400):
        host, path = rng.choice(["a.com", "b.com", "c.net"]), rng.choice(["win", "day", "news"])
        rows.append((f"http://{host}/{path}/{i}", bool(rng.random() < (0.9 if (host, path) == ("b.com", "win") else 0.5 if host == "c.net" else 0.1))))
    frame = spark.createDataFrame(rows, "url string, bad boolean")
    bags = [(frozenset(r["t"]), r["bad"]) for r in frame.select(url_filter.url_tokens(F.col("url")).alias("t"), "bad").collect()]
    counts, hits = Counter(), Counter()
    for tokens, bad in bags:
        for k in range(1, len(tokens) + 1):
            for part in itertools.combinations(sorted(tokens), k):
                counts[part] += 1
                hits[part] += bad
    share = sum(b for _, b in bags) / len(bags)
    bar, z, want = min(share * 1.5, (1 + share) / 2), 2.6, {}
    for part, n in counts.items():
        p = hits[part] / n
        surely = (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        if hits[part] >= 20 and surely >= bar:
            want[part] = p
    want = {a: p for a, p in want.items() if not any(set(b) < set(a) and q >= p - 1e-12 for b, q in want.items())}
    got = {tuple(r["antecedent"]): r["confidence"] for r in url_filter.mine_rules(frame).collect()}
    assert got == pytest.approx(want)
    assert got


def test_rows_that_repeat_a_long_url(spark):
    """A url of 40 tokens on 25 rows is one item, not 2^40 combinations; each of its own tokens is a rule."""
    import time

    long = "http://" + ".".join(f"h{i}a" for i in "abcdefghij") + ".com/" + "/".join(f"p{i}b" for i in "abcdefghijklmnopqrstuvwxyzABC") + "?k=1"
    rows = [(long, True)] * 25 + [(f"http://good.com/{w}", False) for w in ("news", "day") * 40]
    frame = spark.createDataFrame(rows, "url string, bad boolean")
    began = time.time()
    got = [tuple(r["antecedent"]) for r in url_filter.mine_rules(frame).collect()]
    assert time.time() - began < 60  # a runaway search takes hours
    own = spark.createDataFrame([(long,)], "url string").select(url_filter.url_tokens(F.col("url"))).first()[0]
    assert sorted(got) == sorted((t,) for t in own if t not in ("scheme:http", "host:com"))


def test_mined_rules(spark):
    bad = [(f"http://s{i % 5}.casino.com/win/{i}", True) for i in range(60)]
    good = [(f"http://s{i % 5}.news.com/{'win' if i % 2 else 'day'}/{i}", False) for i in range(240)] + [(None, True), ("http://x.com/", None)]
    labelled = spark.createDataFrame(bad + good, "url string, bad boolean")
    pages = spark.createDataFrame([(1, "https://new.casino.com/win/9"), (2, "https://new.news.com/win/9"), (3, "https://casino.org/"), (4, None)], "page_id int, url string")
    found = {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(pages, labelled, []).collect()}
    assert found == {1: "block", 2: "allow", 3: "block", 4: "allow"}


# --------------------------------------------------------------------- op 5


def test_banding_meets_its_recall():
    bands, rows = ngram_join.choose_bands(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999
    assert bands * rows <= 128


def test_ngram_join_cases(docs, none):
    found = ngram_join.ngram_jaccard_join(docs).collect()
    assert len(found) == len(ROWS)
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], []).append((r["class_id"], r["n_links"], r["n_text_links"]))
    # five of the grams hold the changed word: 51 / 61 of them are shared
    assert by[1] == [(1, 4, 1)]
    assert by[2] == [(1, 4, 1)] * 2
    assert by[3] == [(1, 4, 1)]
    assert by[None] == [(1, 4, 1)]
    assert by[4] == [(4, 0, 0)]
    assert by[5] == [(5, 0, 0)]
    assert by[6] == by[7] == [(6, 1, 0)]
    assert ngram_join.ngram_jaccard_join(none).count() == 0
    kept = ngram_join.drop_near_duplicates(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5, 6, 8, 9]
    assert kept.columns == docs.columns
    alone = ngram_join.drop_near_duplicates(docs.where("doc_id is null or doc_id = 4"))
    assert {r["doc_id"] for r in alone.collect()} == {None, 4}
    assert ngram_join.drop_near_duplicates(docs.where("doc_id = 2")).count() == 1


def test_ngram_join_of_a_large_family_in_blocks(spark):
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join("v%d" % k if i == 3 + k else w for i, w in enumerate(words)) for k in range(90)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = ngram_join.ngram_jaccard_join(frame, block=16).collect()
    assert {(r["class_id"], r["n_links"], r["n_text_links"]) for r in found} == {(0, 89, 89)}


# ----------------------------------------------------------------- op 6, op 8


def test_quality_model_learns_and_scores(spark, docs, none):
    rng = np.random.default_rng(1)
    plain = [" ".join(rng.choice(["tree", "river", "stone", "cloud", "the", "of"], 150)) for _ in range(150)]
    junk = [p.replace(" ", "### ") for p in plain]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(plain + junk)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(300)] + [(None, 1), (400, None)], "doc_id long, quality int")
    model = quality_mil.fit(frame, labels)
    scores = dict(quality_mil.score_quality(frame, model).collect())
    assert np.mean([(scores[i] >= 0.5) == (i < 150) for i in scores]) > 0.98
    assert quality_mil.score_quality(docs, model).count() == len(ROWS)
    assert quality_mil.score_quality(none, model).count() == 0
    untrained = quality_mil.fit(frame, labels.limit(0))
    assert {r["score"] for r in quality_mil.score_quality(docs, untrained).collect()} == {0.5}


def test_attention_weights_sum_to_one():
    rng = np.random.default_rng(2)
    x, bounds = rng.normal(size=(10, quality_mil.WIDTH)), np.array([0, 3, 4, 10])
    model = quality_mil.train(x, bounds, np.array([0.0, 1.0, 0.0]), epochs=2)
    attention = quality_mil._forward(model.weights, x, bounds)[3]
    assert np.add.reduceat(attention, bounds[:-1]) == pytest.approx([1, 1, 1])


def test_toxicity_model_learns_and_scores(spark, docs, none):
    rng = np.random.default_rng(1)
    words = ["tree", "river", "stone", "cloud", "the", "of", "bird", "rain"]
    texts = []
    for i in range(600):
        own = list(rng.choice(words, 60))
        if i % 3 == 0:
            own[int(rng.integers(60))] = rng.choice(["idiot", "vile", "scumbag"])
        texts.append((i, " ".join(own)))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)], "doc_id long, toxic int")
    model = toxicity.fit(frame, labels)
    rows = toxicity.score_toxicity(frame, model).collect()
    assert np.mean([(r["score"] >= toxicity.DECISION) == (r["doc_id"] % 3 == 0) for r in rows]) > 0.97
    assert toxicity.score_toxicity(docs, model).count() == len(ROWS)
    assert toxicity.score_toxicity(none, model).count() == 0
    untrained = toxicity.fit(frame, labels.limit(0))
    assert {round(r["score"], 6) for r in toxicity.score_toxicity(docs, untrained).collect()} == {0.5}


def slopes_by_difference(loss, array, step=1e-6):
    out = np.zeros_like(array)
    for at in np.ndindex(array.shape):
        old = array[at]
        array[at] = old + step
        above = loss()
        array[at] = old - step
        out[at] = (above - loss()) / (2 * step)
        array[at] = old
    return out


def test_gradient_of_attention():
    rng = np.random.default_rng(1)
    bounds, labels, weight = np.array([0, 1, 4, 9]), np.array([1.0, 0.0, 1.0]), np.array([0.3, 0.5, 0.2])
    x = rng.normal(size=(9, quality_mil.WIDTH))
    shape = {"W": (quality_mil.WIDTH, 3), "b": (3,), "V": (3, 2), "U": (3, 2), "w": (2,), "c": (3,), "d": (1,)}
    weights = {k: rng.normal(0, 0.5, s) for k, s in shape.items()}
    slopes = quality_mil.gradient(weights, x, bounds, labels, weight)[1]
    for k in shape:
        expected = slopes_by_difference(lambda: quality_mil.gradient(weights, x, bounds, labels, weight)[0], weights[k])
        assert np.allclose(slopes[k], expected, atol=1e-6), k


def test_gradient_of_convolution():
    rng = np.random.default_rng(2)
    bounds, labels, weight = np.array([0, 2, 7, 19]), np.array([1.0, 0.0, 1.0]), np.array([0.3, 0.5, 0.2])
    x = rng.normal(size=(19, toxicity.DIMENSION))
    filters = [rng.normal(0, 0.3, (w, toxicity.DIMENSION, toxicity.FILTERS)) for w in toxicity.WIDTHS]
    biases, output, keep = rng.normal(0, 0.3, toxicity.POOLED), rng.normal(0, 0.3, toxicity.POOLED), (rng.random((3, toxicity.POOLED)) < 0.8) / 0.8
    run = lambda: toxicity.gradient(filters, biases, output, 0.1, x, bounds, labels, weight, keep)
    g = run()
    for k in range(len(filters)):
        assert np.allclose(g.filters[k], slopes_by_difference(lambda: run().loss, filters[k]), atol=1e-6)
    assert np.allclose(g.biases, slopes_by_difference(lambda: run().loss, biases), atol=1e-6)
    assert np.allclose(g.output, slopes_by_difference(lambda: run().loss, output), atol=1e-6)
    to_x = np.zeros_like(x)
    np.add.at(to_x, g.x[0], g.x[1])
    assert np.allclose(to_x, slopes_by_difference(lambda: run().loss, x), atol=1e-6)


def test_columns_of_any_name_pass_through(spark):
    extra = ["key", "row", "stays", "gone", "spans", "piece", "out_shard", "slot", "text_key", "quality", "_0"]
    text = "the quick fox of the wood and its kin went to the river in the night for water that was cold and clear as glass."
    rows = [(i, f"{text} {i}" * (1 + i % 2), "en", "a", 9, *range(len(extra))) for i in range(4)] + [(None, None, None, None, None, *range(len(extra)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` long" for n in extra))
    bench = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    for result in (quality_rules.keep_quality(frame), ngram_join.drop_near_duplicates(frame), decontaminate.drop_leaks(frame, bench), mixing.mix_documents(frame), line_dedup.dedup_lines(frame)):
        assert result.columns == frame.columns
        found = result.collect()
        assert found
        assert {tuple(r[n] for n in extra) for r in found} == {tuple(range(len(extra)))}


def test_rows_that_repeat_keep_their_own_columns(spark):
    """Rows of one doc_id and text: each gives its own spans in the mix; of near duplicates the first by its other columns stays."""
    text = " ".join(f"w{i}" for i in range(640))
    rows = [(1, text, "a", x, {"k": y}) for x, y in (("X", 1), ("Y", 2), ("Y", 2), ("Z", 3))] + [(2, text + " more", "a", "V", None), (None, "other " * 100, "a", "U", None), (None, "other " * 100, "a", "T", None)]
    schema = "doc_id long, text string, source string, extra string, m map<string,int>"
    for parts in (1, 3):
        frame = spark.createDataFrame(rows, schema).repartition(parts)
        mixed = mixing.mix_documents(frame, weights=(1,), share=1.0)
        words = Counter()
        for r in mixed.collect():
            words[r["doc_id"], r["extra"], r["m"]["k"] if r["m"] else None] += len(r["text"].split())
        assert words == {(1, "X", 1): 640, (1, "Y", 2): 1280, (1, "Z", 3): 640, (2, "V", None): 641, (None, "U", None): 100, (None, "T", None): 100}
        kept = ngram_join.drop_near_duplicates(frame)
        assert sorted((r["doc_id"] or 0, r["extra"], r["m"]["k"] if r["m"] else 0) for r in kept.collect()) == [(0, "T", 0), (1, "X", 1)]


def test_items_of_few_words_are_reported_but_drop_nothing(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat"), (2, "nothing here"), (3, "say one two three four five now")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "the"), (2, "cat sat"), (3, "one two three four five")], "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, bench).collect()) == [(1, 1), (1, 2), (3, 3)]
    assert sorted(r["doc_id"] for r in decontaminate.drop_leaks(docs, bench).collect()) == [1, 2]
    assert sorted(r["doc_id"] for r in decontaminate.drop_leaks(docs, bench, min_item_words=1).collect()) == [2]


def test_a_cap_is_a_whole_number(spark, docs):
    with pytest.raises(ValueError, match="whole number"):
        mixing.mix_documents(docs, cap=1.5)


def test_stages_on_empty_tables(spark, none):
    bench = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    for result in (quality_rules.keep_quality(none), ngram_join.drop_near_duplicates(none), decontaminate.drop_leaks(none, bench), mixing.mix_documents(none), line_dedup.dedup_lines(none)):
        assert result.columns == none.columns
        assert result.collect() == []


# --------------------------------------------------------------------- op 7


def test_store_compacts_and_keeps_versions(spark, docs, none):
    store = sharding.ShardStore(spark, scratch_path(spark, "s"), target_bytes=60_000, fanout=3)
    for k in range(7):
        store.append(docs.repartition(2))
    assert store.versions() == list(range(1, 8))
    before = store.manifest().count()
    store.compact_all()
    assert store.manifest().count() < before
    assert store.read().count() == 7 * len(ROWS)
    assert store.read(2).count() == 2 * len(ROWS)
    store.append(none)
    assert store.read().count() == 7 * len(ROWS)
    store.expire()
    assert len(store.versions()) == 1
    assert store.read().count() == 7 * len(ROWS)


def test_small_shards_merge_beside_a_large_one(spark):
    store = sharding.ShardStore(spark, scratch_path(spark, "s"), target_bytes=128_000_000)
    planned = lambda sizes: store._plan(spark.createDataFrame([(f"p{i}", 0, 1, n, i, i, 1) for i, n in enumerate(sizes)], sharding.MANIFEST)).collect()
    assert sorted(r["path"] for r in planned([60_000_000] + [1_000_000] * 59)) == sorted(f"p{i}" for i in range(1, 60))
    assert len(planned([60_000_000] + [10_000] * 3000)) == 3000
    assert planned([1, 2, 4, 8, 16, 32]) == []
    assert planned([1, 2, 4, 8, 16, 32, 32]) == []  # no tier holds four


def test_plan_is_that_of_brute_force(spark):
    """Runs within a tier, none above the target; due with fanout shards or half the target."""
    target, fanout = 1_000_000, 4
    store = sharding.ShardStore(spark, scratch_path(spark, "s"), target_bytes=target, fanout=fanout)
    rng = np.random.default_rng(4)
    sizes = [int(x) for x in 10 ** rng.uniform(2, 6.2, 120)] + [249_000] * 9 + [400_000] * 3
    tiers, want = {}, set()
    for i, n in enumerate(sizes):
        tier = max(0, math.ceil(math.log(target / n) / math.log(fanout)))
        if 2 * n < target:
            tiers.setdefault(tier, []).append((n, i))
    for own in tiers.values():
        cuts, before = {}, 0
        for n, i in sorted(own):
            cuts.setdefault(before // (target - max(own)[0]), []).append((n, i))
            before += n
        for run in cuts.values():
            if len(run) >= fanout or (len(run) > 1 and 2 * sum(n for n, _ in run) >= target):
                want.add(frozenset(f"p{i}" for _, i in run))
    plan = store._plan(spark.createDataFrame([(f"p{i}", 0, 1, n, i, i, 1) for i, n in enumerate(sizes)], sharding.MANIFEST)).collect()
    got = {}
    for r in plan:
        got.setdefault((r["lane"], r["run"]), set()).add(r["path"])
    assert {frozenset(x) for x in got.values()} == want
    assert max(sum(sizes[int(p[1:])] for p in run) for run in got.values()) <= target
    assert any(sum(sizes[int(p[1:])] for p in run) > 0.8 * target for run in got.values())


def test_a_store_without_appends(spark):
    store = sharding.ShardStore(spark, scratch_path(spark, "s"))
    assert (store.compact_all(), store.expire(), store.versions()) == (0, 0, [])
    assert store.read().collect() == []


def test_store_with_columns_of_its_own_names(spark):
    names = ["doc_id", "path", "shard", "tier", "run", "of_path", "shard_path", "bytes", "_0"]
    store = sharding.ShardStore(spark, scratch_path(spark, "s"), target_bytes=60_000, fanout=2)
    for k in range(3):
        store.append(spark.createDataFrame([tuple(10 * k + i for i in range(len(names)))], ", ".join(f"{n} long" for n in names)).coalesce(1))
    store.compact_all()
    assert store.manifest().count() == 1
    found = store.read()
    assert found.columns == [*names, "shard_", "tier_", "shard_rows", "shard_bytes"]
    assert sorted(r["shard"] for r in found.collect()) == [2, 12, 22]


def test_a_lost_race_leaves_nothing(spark, docs, monkeypatch):
    store = sharding.ShardStore(spark, scratch_path(spark, "s"), target_bytes=60_000, fanout=2)
    other = sharding.ShardStore(spark, store.root, target_bytes=60_000, fanout=2)
    for _ in range(3):
        store.append(docs.coalesce(1))
    known = store.versions
    folders = lambda kind: {s.getPath().getName() for s in store._context.util().listStatus(store._fs.Path(f"{store.root}/{kind}"))}
    held = folders("data")
    monkeypatch.setattr(store, "versions", lambda: known()[:-1])  # what the writer saw before another one committed
    with pytest.raises(sharding.CommitConflictError):
        store.compact()
    assert folders("data") == held
    assert folders("staged") == set()
    seen = iter([known()[:-1]])
    monkeypatch.setattr(store, "versions", lambda: next(seen, None) or known())
    store.append(docs.coalesce(1))  # comes second, and is committed on top
    assert other.read().count() == 4 * len(ROWS)


def test_small_arrivals_after_a_large_one(spark):
    schema = "doc_id long, text string"
    big = spark.createDataFrame(np.random.default_rng(0).integers(0, 1 << 62, (1500, 1)).tolist(), "doc_id long").withColumn("text", F.sha2(F.col("doc_id").cast("string"), 256))
    store = sharding.ShardStore(spark, scratch_path(spark, "s"), target_bytes=1, fanout=3)
    store.append(big.coalesce(1))
    store.target_bytes = store.manifest().first()["bytes"] * 2 + 2
    for k in range(6):
        store.append(spark.createDataFrame([(k, "small")], schema).coalesce(1))
    store.compact_all()
    assert store.manifest().count() == 2
    assert store.read().count() == 1506


def test_store_keeps_columns_of_any_append(spark):
    store = sharding.ShardStore(spark, scratch_path(spark, "s"), target_bytes=60_000, fanout=2)
    store.append(spark.createDataFrame([(1, "a")], "doc_id long, text string").coalesce(1))
    store.append(spark.createDataFrame([(2, "b", 7)], "doc_id long, text string, stars int").coalesce(1))
    store.append(spark.createDataFrame([(3, "x")], "doc_id long, site string").coalesce(1))
    want = [(1, "a", None, None), (2, "b", 7, None), (3, None, None, "x")]
    rows = lambda: sorted(tuple(r) for r in store.read().select("doc_id", "text", "stars", "site").collect())
    assert rows() == want
    store.compact_all()
    store.expire()
    assert store.manifest().count() == 1
    assert rows() == want


def test_store_refuses_a_version_twice(spark, docs):
    store = sharding.ShardStore(spark, scratch_path(spark, "s"))
    store.append(docs)
    with pytest.raises(sharding.CommitConflictError):
        store._commit(store.manifest(), 1)


def test_store_without_rows(spark, none):
    store = sharding.ShardStore(spark, scratch_path(spark, "s"))
    assert store.compact() is None
    store.append(none)
    assert store.read().count() == 0


# --------------------------------------------------------------------- op 9


def test_taken_words(docs, none):
    rows = mixing.taken_words(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert {r["size"] for r in rows if r["doc_id"] in (4, 5, 8)} == {0}
    assert mixing.taken_words(none).count() == 0


def test_mix_does_not_hang_on_partitions(spark):
    frame = spark.createDataFrame([(i, f"text {i} " * (i % 50), "abc"[i % 3]) for i in range(300)], "doc_id long, text string, source string")
    assert sorted(mixing.taken_words(frame).collect()) == sorted(mixing.taken_words(frame.repartition(7)).collect())


def test_index_permutation(spark):
    for n in (1, 2, 7, 100):
        found = [r["x"] for r in spark.range(n).select(mixing._permuted(F.col("id"), F.lit(n), F.lit(3)).alias("x")).collect()]
        assert sorted(found) == list(range(n))
    assert found != list(range(100))


def test_mixed_texts_are_the_spans(spark):
    frame = spark.createDataFrame([(i, " ".join(f"d{i}w{k}" for k in range(100)), "abc"[i % 3], 1) for i in range(30)], "doc_id long, text string, source string, n_chars long")
    words = {}
    for r in mixing.mix_documents(frame).collect():
        assert r["n_chars"] == len(r["text"])
        own = r["text"].split(" ")
        assert all(w.startswith(f"d{r['doc_id']}w") for w in own)
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(own)
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken_words(frame).collect() if r["taken"]}
    assert words == taken


# -------------------------------------------------------------------- op 10


def test_line_cases(spark, docs, none):
    base = "a line of some forty characters and more"
    texts = [(1, f"{base}\n\n{base[:-1]}"), (2, f"{base}!\nshort"), (None, "short"), (3, None), (4, ""), (5, base.replace("forty", "fifty") + "\n" + base[3:])]
    frame = spark.createDataFrame(texts, "doc_id long, text string").withColumn("line", F.lit("x"))
    found = {(r["doc_id"], r["line_no"]): (r["class_doc"], r["class_line"], r["kept"]) for r in line_dedup.line_classes(frame).collect()}
    assert found == {
        (1, 0): (1, 0, True), (1, 2): (1, 0, False), (2, 0): (1, 0, False), (2, 1): (2, 1, True), (None, 0): (2, 1, False), (5, 0): (1, 0, False), (5, 1): (5, 1, True),
    }
    assert line_dedup.line_classes(none).count() == 0
    assert line_dedup.line_classes(docs).count() == 8
    kept = dict(line_dedup.dedup_lines(frame).select("doc_id", "text").collect())
    assert kept == {1: f"{base}\n", 2: "short", None: "", 3: None, 4: "", 5: base[3:]}


def test_lines_in_blocks_equal_lines_in_one(spark):
    rng = np.random.default_rng(4)
    base = "the same long line that many texts share in slightly other forms"
    lines = set()
    while len(lines) < 80:
        spots = rng.choice(len(base), 2, replace=False)
        lines.add("".join(chr(97 + int(rng.integers(26))) if i in spots else c for i, c in enumerate(base)))
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(sorted(lines))], "doc_id long, text string")
    whole, cut = (sorted(line_dedup.line_classes(frame, block=b).drop("text_key").collect()) for b in (1000, 8))
    assert whole == cut
