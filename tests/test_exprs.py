"""Scalar expressions on literal rows."""

import math

import pytest
from pyspark.sql import functions as F

from tagloom.functions import exprs as X


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def text(value):
    return F.lit(value).cast("string")


@pytest.mark.parametrize(
    ("value", "delimiter", "tags"),
    [("a# b ##c", "#", ["a", "b", "c"]), ("a+b", r"\+", ["a", "b"]), ("  whole ", None, ["whole"]), ("", "#", []), (None, "#", []), ("10", None, ["10"])],
)
def test_split_tags(spark, value, delimiter, tags):
    assert one(spark, X.split_tags(text(value), delimiter)) == tags


def test_tokens(spark):
    assert one(spark, X.word_tokens(text("The big, BIG cat a"))) == ["the", "big", "big", "cat"]
    assert one(spark, X.phrase_tokens(text("one two three"))) == ["one two", "two three"]
    assert one(spark, X.phrase_tokens(text("one"))) == []
    assert one(spark, X.bigram_tokens(text("电视剧x节目"))) == ["电视", "视剧", "节目"]
    assert one(spark, X.word_tokens(text(None))) == []


def test_phrases_split_a_text_once(spark):
    words = [f"w{i}" for i in range(20_000)]
    assert one(spark, X.phrase_tokens(text(" ".join(words)))) == [f"{a} {b}" for a, b in zip(words, words[1:])]
    assert one(spark, X.phrase_tokens(text("one two three four"), 3)) == ["one two three", "two three four"]
    plan = spark.range(1).select(X.phrase_tokens(F.col("id").cast("string")).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all") == 1


def test_bigrams_of_a_long_run(spark):
    run = "".join(chr(0x4E00 + i) for i in range(20_000))
    assert one(spark, X.bigram_tokens(text(f"{run}a一b"))) == [run[i : i + 2] for i in range(len(run) - 1)]


@pytest.mark.parametrize(("title", "name"), [("show_12", "show"), ("show_x_3", "show"), ("show", None), ("show_x", None)])
def test_series_name(spark, title, name):
    assert one(spark, X.series_name(text(title))) == name


@pytest.mark.parametrize(("title", "clean"), [("名侦探第二季", "名侦探"), ("show season 2", "show"), ("节目 高清", "节目"), ("a b.c!", "abc"), ("ABC: News-Today", "ABCNewsToday")])
def test_clean_title(spark, title, clean):
    assert one(spark, X.clean_title(text(title))) == clean


def test_numbers(spark):
    assert one(spark, X.first_int(text("all 24 of 30"))) == 24
    assert one(spark, X.first_int(text("none"))) is None
    assert one(spark, X.suffix_number(text("x_7"))) == 7
    assert one(spark, X.suffix_number(text("x7"))) == 0
    assert one(spark, X.int_or_zero(text(""))) == 0
    assert one(spark, X.sigmoid(F.lit(0.0))) == 0
    assert one(spark, X.sigmoid(F.lit(1.0))) == pytest.approx(2 / (1 + math.exp(-2.3)) - 1)
    assert one(spark, X.log_weight(F.lit(1.0))) == pytest.approx(math.log(2))
    assert one(spark, X.decay(F.lit(0))) == 1.0
    assert one(spark, X.decay(F.lit(10))) == pytest.approx(10**-0.35)


def test_play_and_episode_weights(spark):
    assert one(spark, X.capped_play(F.lit(50.0), F.lit(10.0))) == 20.0
    assert one(spark, X.play_ratio(F.lit(5.0), F.lit(0.0))) == 0.2
    assert one(spark, X.play_ratio(F.lit(5.0), F.lit(10.0))) == 0.5
    assert one(spark, X.episode_weight(F.lit(3), F.lit(4))) == 0.75
    for number, latest in ((0, 4), (3, 0), (5, 4)):
        assert one(spark, X.episode_weight(F.lit(number), F.lit(latest))) == 0.2


def test_dates(spark):
    day = F.lit("2024-03-01").cast("date")
    assert one(spark, X.day_string(day, -1)) == "20240229"
    assert one(spark, X.last_days(day, 2)) == ["20240229", "20240228"]
    assert one(spark, X.last_days(day, 2, include_today=True)) == ["20240301", "20240229", "20240228"]
    assert one(spark, X.epoch_seconds(text("1970-01-02 00:00:00"))) == 86400
    assert one(spark, X.epoch_seconds(text("broken"))) is None


def test_lists(spark):
    values = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(w).alias("weight")) for i, w in (("b", 0.5), ("a", 0.5), ("c", 2.0))])
    assert [v["id"] for v in one(spark, X.top_of_list(values, 2))] == ["c", "a"]
    assert one(spark, X.format_list(values)) == "b:0.5000,a:0.5000,c:2.0000"
    parsed = one(spark, X.parse_list(text("a###1.5;b;###2;c###x")))
    assert [(v["id"], v["weight"]) for v in parsed] == [("a", 1.5), ("c", None)]
    assert [tuple(v) for v in one(spark, X.zip_tags(F.array(F.lit("a"), F.lit(""), F.lit("c")), F.array(F.lit("1"), F.lit("2"))))] == [("a", 1)]
    assert tuple(one(spark, X.parse_tag_mark(text("x##12")))) == ("x", 12, "curated")
    assert tuple(one(spark, X.parse_tag_mark(text("x_inner")))) == ("x", None, "inner")
    assert tuple(one(spark, X.parse_tag_mark(text("x")))) == ("x", None, "plain")


def test_lines(spark):
    assert one(spark, X.positional_line({1: F.lit("v"), 3: F.lit(None)}, 5)) == "-1\tv\t\t\t"
    assert one(spark, X.profile_line(F.lit(7), text(None), text("t:1"))) == "guid=7\tTAG:t:1"
    assert one(spark, X.profile_line(F.lit(7), text("1.2:3"), text("t:1"))) == "guid=7\tCAT_S2:1.2:3$TAG:t:1"


def test_decoding_and_predicates(spark):
    assert one(spark, X.decoded_json(F.base64(F.lit('{"a": 3}').cast("binary")), "a")) == "3"
    assert one(spark, X.decoded_json(text("%%%"), "a")) is None
    assert one(spark, X.is_number(text("1.5"), "int")) is False
    assert one(spark, X.is_number(text("1.5"), "double")) is True
    assert one(spark, X.in_set(text("z"), ("ALL",))) is True
    assert one(spark, X.is_normal(text(""), text("1512772"), text(""), text("x低端"))) is False
    assert one(spark, X.is_single(text("a#b"))) is False
    assert one(spark, X.id_kind(F.lit(5))) == "curated"
    assert one(spark, X.id_kind(F.lit(-5))) == "derived"


@pytest.mark.parametrize(
    ("code", "age", "first", "second", "fresh"),
    [(X.PERMANENT, 999, None, None, True), (X.SHORT, 1, None, None, True), (X.SHORT, 2, None, None, False), (X.NORMAL, 5, 7, 6, True), (X.NORMAL, 5, 7, 4, False), (X.NORMAL, 5, None, 6, False), ("other", 0, 9, 9, False)],
)
def test_fresh_class(spark, code, age, first, second, fresh):
    days = [F.lit(x).cast("int") for x in (first, second)]
    assert one(spark, X.is_fresh_class(text(code), F.lit(age), *days)) is fresh


def test_weights_are_printed_as_in_c(spark):
    values = [0.00015, 0.00025, 0.12345, 0.1, 2.0, 0.00005, 0.99995, 1.00005, 0.03125, 0.09375, 5e-324, 999_999.99995, 1e6, 12_345_678.00005, 0.0, -0.00015, -1e-9, math.nan, math.inf]
    values += [(2 * k + 1) / 20_000 for k in range(0, 4_000, 7)]
    frame = spark.createDataFrame([(v,) for v in values], "w double")
    got = frame.select(X.format_weight(F.col("w")).alias("four"), X.format_weight(F.col("w"), 3).alias("three")).collect()
    named = {"nan": "NaN", "inf": "Infinity"}
    assert [tuple(r) for r in got] == [tuple(named.get(t, t) for t in ("%.4f" % v, "%.3f" % v)) for v in values]
