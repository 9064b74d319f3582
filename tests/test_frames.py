"""DataFrame operators, sources and payloads on small rows."""

import math
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.operators import cosine as C
from tagloom.operators import frames as O
from tagloom.plans import items as I
from tagloom.plans import tags as T
from tagloom.plans import views as V
from tagloom.sources import payloads as K
from tagloom.sources import readers as S
from tagloom.sources.scratch import scratch_path


def rows(frame, *columns):
    return sorted(tuple(r) for r in (frame.select(*columns) if columns else frame).collect())


def test_top_k_breaks_ties_by_id(spark):
    frame = spark.createDataFrame([("g", "b", 1.0), ("g", "a", 1.0), ("g", "c", 2.0)], "g string, tag string, weight double")
    assert rows(O.top_k(frame, ["g"], 2), "tag") == [("a",), ("c",)]
    assert rows(O.top_k(frame, ["g"], 1, ascending=True), "tag") == [("a",)]


def test_norms(spark):
    frame = spark.createDataFrame([("g", 3.0), ("g", 4.0), ("h", 0.0)], "g string, weight double")
    assert rows(O.max_norm(frame, ["g"])) == [("g", 0.75), ("g", 1.0), ("h", 0.0)]
    assert rows(O.l2_norm(frame, ["g"])) == [("g", 0.6), ("g", 0.8)]


def test_unique_keys(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2)], "tag string, tag_id int")
    assert rows(O.unique_keys(frame, "tag", "tag_id")) == [("a", 1)]


def test_pool_does_not_multiply(spark):
    frame = spark.createDataFrame([(1,), (2,)], "item int")
    assert rows(O.restrict(frame, spark.createDataFrame([(1,), (1,)], "item int"), "item")) == [(1,)]


def test_ratio_of_sums(spark):
    frame = spark.createDataFrame([("a", 3, 4), ("a", 1, 4), ("b", 9, 2), ("c", 0, 1)], "item string, click int, exposure int")
    assert rows(O.ratio_of_sums(frame, ["item"], "click", "exposure", 2, 2)) == [("a", 4, 8, 0.5)]


def test_histogram_buckets(spark):
    frame = spark.createDataFrame([("k", n) for n in (0, 10, 11, 20, 21, 100, 101, 1000, 1001)], "kind string, n0 int")
    found = {b: n for _, b, n in rows(O.histogram(frame, "kind", "n0"))}
    assert found == {"0000": 1, "0010": 1, "(0010-0020]": 2, "(0020-0030]": 1, "(0090-0100]": 1, "(0100-0200]": 1, "(0900-1000]": 1, ">1000": 1}


def test_cosine_without_shared_feature_gives_no_row(spark):
    left = spark.createDataFrame([(1, "x", 1.0), (2, "y", 1.0)], "item int, idx string, val double")
    right = spark.createDataFrame([(9, "x", 2.0), (9, "z", 2.0)], "other int, idx string, val double")
    assert rows(C.cosine_pairs(left, right)) == [(1, 9, pytest.approx(0.707106781))]
    assert rows(I.best_collection(left, right), "item", "other") == [(1, 9)]


def test_cosines_of_blocks_are_those_of_one_block(spark):
    """Tags that all items have, ties, zero and negative values, against plain Python."""
    rng = np.random.default_rng(2)
    vectors = {}
    for i in range(60):
        own = {"all": 1.0} | {f"t{k}": float(rng.integers(-2, 3)) for k in rng.choice(9, 3, replace=False)}
        vectors[i] = own if i % 9 else {f"only{i}": 1.0}
    vectors[60], vectors[61] = {"all": 0.0}, dict(vectors[5])
    data = [(i, t, v) for i, own in vectors.items() for t, v in own.items()]
    left = spark.createDataFrame(data, "item long, idx string, val double")
    right = left.withColumnRenamed("item", "other")
    want = {}
    for a, x in vectors.items():
        for b, y in vectors.items():
            length = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
            if x.keys() & y.keys() and length:
                want[a, b] = sum(x[t] * y[t] for t in x.keys() & y.keys()) / length
    for block in (7, 1000):
        got = {(r["item"], r["other"]): r["cosine"] for r in C.cosine_pairs(left, right, block=block).collect()}
        assert got == pytest.approx(want, abs=1e-9)
        near = C.cosine_pairs(left, right, count=3, min_cosine=0.1, same=False, block=block).collect()
        best = {}
        for (a, b), c in sorted(want.items(), key=lambda x: (x[0][0], -round(x[1], 9), x[0][1])):
            if a != b and round(c, 9) > 0.1 and len(best.setdefault(a, [])) < 3:
                best[a].append(b)
        found = {}
        for r in sorted(near, key=lambda r: (r["item"], -r["cosine"], r["other"])):
            found.setdefault(r["item"], []).append(r["other"])
        assert found == {a: b for a, b in best.items() if b}


def test_tf_idf_modes(spark):
    frame = spark.createDataFrame([("c", 1, "a", 2.0), ("c", 1, "a", 2.0), ("c", 2, "b", 2.0)], "channel string, item int, tag string, channel_weight double")
    linear, squared = (dict((r[1], r[3]) for r in rows(T.tf_idf(frame, mode)) if r[2] == "a") for mode in ("linear", "per_occurrence"))
    assert squared[1] == pytest.approx(2 * linear[1])


def test_tf_idf_of_many_rows_is_that_of_few(spark, monkeypatch):
    """Frequent tags are broadcast and the rarer ones shuffled: same weights, in all channels, and none for null tags."""
    words = [(c, i, t, 2.0) for c in ("c", "d") for i in range(12) for t in ["all", "all", f"two{i // 2}", f"one{i}", None] + ["half"] * (i % 2)]
    frame = spark.createDataFrame(words, "channel string, item int, tag string, channel_weight double")
    want = rows(T.tf_idf(frame, "per_occurrence"), "channel", "item", "tag", "weight")
    assert len(want) == 2 * (12 * 3 + 6)
    monkeypatch.setattr(O, "BROADCAST_ROWS", 0)
    assert rows(T.tf_idf(frame, "per_occurrence"), "channel", "item", "tag", "weight") == want
    join_frequent = O.join_frequent
    for most in (0, 1, 4, 20):
        monkeypatch.setattr(O, "join_frequent", partial(join_frequent, most=most))
        assert rows(T.tf_idf(frame, "per_occurrence"), "channel", "item", "tag", "weight") == want


def test_texts_are_dealt_by_item_and_their_counts_not_shuffled_again(spark):
    texts = spark.createDataFrame([(1, "The big, BIG cat a"), (1, "cat 7"), (2, "cat"), (None, "öl cat"), (3, None), (4, "")], "id long, body string")
    counts = T.text_tags(texts, "id", "body", "text").groupBy("channel", "item", "tag").count()
    assert counts._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert {(r["item"], r["tag"], r["count"]) for r in counts.collect()} == {(1, "the", 1), (1, "big", 2), (1, "cat", 2), (2, "cat", 1), (None, "öl", 1), (None, "cat", 1)}
    # a key that would fill many tasks does not meet in one
    size = F.octet_length("body")
    assert O.dealt_by_size(texts, "id", size, task=1) is texts
    assert O.dealt_by_size(texts, "id", size, task=8).rdd.getNumPartitions() >= 4
    for none in (texts.where("false"), texts.where("body is null")):
        assert T.text_tags(none, "id", "body", "text").collect() == []


def test_cold_scope(spark):
    lists = spark.createDataFrame([("t", 1, 1.0), ("t", 2, 1.0)], "tag string, item int, weight double")
    log = spark.createDataFrame([(1, 3), (1, 3), (2, 1)], "item int, exposure int")
    published = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-01")], "item int, published string")
    from pyspark.sql import functions as F

    today = F.lit("2024-01-02").cast("date")
    assert rows(I.cold_lists(lists, log, published, today, 5, 7), "item") == [(1,), (2,)]
    assert rows(I.cold_lists(lists, log, published, today, 5, 7, "sum"), "item") == [(2,)]


def test_tsv_drops_short_lines_and_keeps_empty_cells(spark):
    path = scratch_path(spark, "t")
    spark.createDataFrame([("a\tb\t",), ("a\tb",), ("x\t\t",)], "value string").write.text(path)
    assert rows(S.read_tsv(spark, path, {"first": 0, "last": 2}, 3)) == [("a", ""), ("x", "")]


def test_ranked_lists_drop_elements_without_weight(spark):
    path = scratch_path(spark, "t")
    spark.createDataFrame([("k\ta,1;b;c,2",), ("nothing",)], "value string").write.text(path)
    assert rows(S.read_ranked_lists(spark, path)) == [("k", "a", 1.0), ("k", "c", 2.0)]


def test_latest_complete_path(spark):
    path = scratch_path(spark, "days")
    for day in ("20240101", "20240102"):
        spark.range(1).write.parquet(f"{path}/{day}")
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = fs.Path(path)
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(fs.Path(f"{path}/20240102/_SUCCESS"), False)
    assert S.latest_complete_path(spark, path) == f"{path}/20240101"
    for day, number in (("20240103", 2), ("20240104", 7)):  # a check file gives the number of the other files
        spark.createDataFrame([(str(number),)], "value string").coalesce(1).write.text(f"{path}/{day}/hour")
        hadoop = fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        folder = fs.Path(f"{path}/{day}/hour")
        for entry in hadoop.listStatus(folder):
            name = entry.getPath().getName()
            if name.startswith("part-"):
                hadoop.rename(entry.getPath(), fs.Path(folder, "files.check"))
            else:
                hadoop.delete(entry.getPath(), False)
        for k in range(2):
            hadoop.create(fs.Path(folder, f"data-{k}")).close()
    assert S.latest_complete_path(spark, path) == f"{path}/20240103"


def test_payload_modes(spark):
    lists = spark.createDataFrame([("k", [("a", 0.5), ("b", 1.0)])], "key string, values array<struct<id:string,weight:double>>")
    assert K.payload(lists, "key", "n", "p", 7).first()["values"] == ["b:7:1.0000", "a:7:0.5000"]
    gone = K.payload(lists, "key", "n", "p", -1, "delete").first()
    assert (gone["op"], gone["key"], gone["values"]) == ("delete", "n_p_k", [])
    with pytest.raises(ValueError, match="unknown mode"):
        K.payload(lists, "key", "n", "p", -1, "other")


def test_control_header_keeps_the_newer(spark):
    lists = spark.createDataFrame([(i, [("a", 1.0)], True, 10) for i in range(4)], "item int, values array<struct<id:string,weight:double>>, is_normal boolean, timestamp long")
    state = spark.createDataFrame([("n_p_1", "9#0"), ("n_p_2", "10#0"), ("n_p_3", "broken")], "key string, header string")
    found = {r["key"]: r["values"][0] for r in K.controlled_payload(lists, state, "n", "p", -1).collect()}
    assert found == {"n_p_0": "10#1", "n_p_1": "10#1", "n_p_2": "10#0", "n_p_3": "10#1"}


def test_top_k_of_a_hot_group(spark):
    """One tag on all items: the first stage is spread, and the result is that of one sort."""
    from pyspark.sql import functions as F

    frame = spark.range(40_000).select(F.lit("hot").alias("tag"), F.col("id").alias("item"), (F.col("id") % 997).cast("double").alias("weight"))
    order = [F.col("weight").desc(), F.col("item")]
    first = O.salted_top_k(frame, ["tag"], 1500, order, ["item"], salts=8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tasks = [r["count"] for r in first.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) > 1
    assert max(tasks) <= 8 * 1500 * 0.8
    got = [r["item"] for r in O.top_k(frame, ["tag"], 1500, tie=("item",)).orderBy(*order).collect()]
    assert got == sorted(range(40_000), key=lambda i: (-(i % 997), i))[:1500]


def test_long_lists_are_chunks(spark):
    """A hot key's elements go to numbered rows of a bounded size, and none is lost."""
    from pyspark.sql import functions as F

    data = spark.range(30_000).select(F.lit("hot").alias("k"), F.array(F.col("id") % 20_000, F.lit(7)).alias("v"))
    data = data.unionByName(spark.createDataFrame([("few", [3, 1, 3]), ("none", []), (None, [5])], "k string, v array<long>"))
    sets = O.flat_set(data, "k", "v", chunk=1000).collect()
    assert sorted(x for r in sets if r["k"] == "hot" for x in r["v"]) == list(range(20_000))
    assert [(r["chunk"], r["v"]) for r in sets if r["k"] == "few"] == [(0, [1, 3])]
    assert [r["v"] for r in sets if r["k"] is None] == [[5]]
    lists = O.flat_list(data, "k", "v", chunk=1000).collect()
    hot = [r for r in lists if r["k"] == "hot"]
    assert sorted(x for r in hot for x in r["v"]) == sorted([i % 20_000 for i in range(30_000)] + [7] * 30_000)
    for rows_of, most in ((sets, 1300), (hot, 4000)):
        assert all(r["v"] == sorted(r["v"]) for r in rows_of)
        assert max(len(r["v"]) for r in rows_of) <= most
    assert len({r["chunk"] for r in hot}) == len(hot)
    assert [r["v"] for r in lists if r["k"] == "few"] == [[1, 3, 3]]


def test_user_vectors_of_many_items(spark):
    from pyspark.sql import functions as F

    from tagloom.plans import users as U

    plays = spark.range(5000).select(F.lit("u").alias("user"), F.col("id").alias("item"), F.lit(0.5).alias("percent")).unionByName(spark.createDataFrame([("v", 1, 1.0), ("w", -1, 1.0)], "user string, item long, percent double"))
    tags = spark.range(5000).select(F.col("id").alias("item"), F.concat(F.lit("t"), F.col("id") % 10).alias("tag"), F.lit(2.0).alias("weight"))
    got = U.daily_vectors(plays, tags, chunk=500).collect()
    own = [r for r in got if r["user"] == "u"]
    assert sorted(i for r in own for i in r["items"]) == list(range(5000))
    assert max(len(r["items"]) for r in own) < 750
    assert sorted((t["id"], t["weight"]) for r in own for t in r["tags"]) == [(f"t{k}", 500.0) for k in range(10)]
    assert [(r["items"], [tuple(t) for t in r["tags"]]) for r in got if r["user"] == "v"] == [([1], [("t1", 2.0)])]
    assert not [r for r in got if r["user"] == "w"]


def test_rollup_is_sized_by_the_rows_it_makes(spark, monkeypatch):
    monkeypatch.setattr(O, "TASK_ROWS", 500)
    tags = spark.range(100).selectExpr("id as item", "explode(array('a', 'b', concat('t', id % 7))) as tag")
    members = spark.range(2000).selectExpr("id % 40 as collection", "id % 100 as item").distinct()
    own = spark.range(40).selectExpr("id as collection", "'own' as key_name", "'a' as tag")
    got = T.collection_rollup(tags, members, own)
    want = {(m["collection"], "items", t) for m in members.collect() for t in ("a", "b", f"t{m['item'] % 7}")} | {(c, "own", "a") for c in range(40)}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(want) and set(rows) == want
    assert max(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()) <= 500
    lines = got._jdf.queryExecution().executedPlan().toString().splitlines()
    made = next(i for i, line in enumerate(lines) if "REPARTITION_BY_NUM" in line)
    # rows are not aggregated between the join and their shuffle
    assert "Union" in lines[made + 1]


def test_month_is_cut_before_its_orders_join(spark):
    plan = V.month(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "o_orderkey" in next(line for line in plan.splitlines() if "Join" in line)


@pytest.mark.parametrize("entries", [1_000_000, 0])
def test_collections_are_sums_of_their_items(spark, entries):
    """By kinds of vectors or by items: equal vectors count once for each item."""
    vectors = {i: {f"t{i % 3}": 0.5 + i % 2, "all": 0.25} for i in range(40)}
    members = [(c, i) for i in range(40) for c in (7, i % 5)] + [(9, 99)]
    want = {}
    for c, i in set(members):
        for t, v in vectors.get(i, {}).items():
            want[c, t] = want.get((c, t), 0) + v
    rows = spark.createDataFrame([(i, t, v) for i, own in vectors.items() for t, v in own.items()], "item long, idx string, val double")
    got = I.collection_sums(rows, spark.createDataFrame(sorted(set(members)), "collection long, item long"), entries, task=10).collect()
    assert {(r["other"], r["idx"]): r["val"] for r in got} == want and len(got) == len(want)
