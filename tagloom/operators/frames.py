"""Reusable operators on DataFrames: normalising, ranking, merging, postings, pairs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import exprs as X

#: Tables of at most so many rows are broadcast; larger ones are shuffled.
BROADCAST_ROWS = 1_000_000
#: Rows of a group up to which Spark limits groups before the shuffle (its default), and parts of a group beyond.
GROUP_LIMIT, SALTS = 1000, 64
#: Rows of one task, about, where all of them stand in its memory.
TASK_ROWS = 500_000
#: Bytes of text of one task, about, where all its distinct words stand in memory; a key may fill so many tasks.
TASK_TEXT, TASKS_OF_KEY = 1 << 23, 16
#: The most frequent keys of a large table, of which so many are broadcast at most.
FREQUENT_KEYS = 200_000
#: Elements of one array, about; a longer list is several numbered ones.
CHUNK = 100_000


def small(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` with a broadcast hint if a count shows that it is small."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


# -------------------------------------------------------------- sets and joins


def restrict(rows: DataFrame, pool: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the pool; repeated pool ids do not multiply rows."""
    return rows.join(pool.select(key), key, "left_semi")


def exclude(rows: DataFrame, banned: DataFrame, key: str) -> DataFrame:
    return rows.join(banned.select(key), key, "left_anti")


def lookup(rows: DataFrame, table: DataFrame, key: str, value: str, default: Column, kind: tuple[str, str] = ("curated", "derived")) -> DataFrame:
    """``value`` of the row's key, else ``default``; ``tag_type`` says which."""
    found = rows.join(table.select(key, F.col(value).alias("__found")), key, "left")
    return found.withColumns({value: F.coalesce("__found", default), "tag_type": F.when(F.col("__found").isNotNull(), kind[0]).otherwise(kind[1])}).drop("__found")


def unique_keys(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with exactly one distinct value, and that value."""
    return pairs.select(key, value).distinct().groupBy(key).agg(F.count("*").alias("__n"), F.min(value).alias(value)).where("__n = 1").drop("__n")


def distinct_rows(rows: DataFrame, about: int, task: int = TASK_ROWS) -> DataFrame:
    """Distinct rows, of ``about`` so many, in tasks of about ``task`` rows however many there are.

    Spark would also look for equal rows before the shuffle, in tasks that are sized by what
    they read: a join that makes many long rows of few short ones fills them.
    """
    return rows.distinct() if about <= task else rows.repartition(-(-about // task), *rows.columns).distinct()


def dealt_by_size(rows: DataFrame, key: str, size: Column, task: int = TASK_TEXT) -> DataFrame:
    """``rows`` with those of a key in one task, in tasks of about ``task`` in all of ``size``.

    What is then grouped by the key and more needs no further shuffle. Where a single key
    would fill many tasks, the rows stay as they are, and Spark shuffles partial groups.
    """
    total, most = rows.groupBy(key).agg(F.sum(size).alias("__size")).agg(F.sum("__size"), F.max("__size")).first()
    if not total or most > task * TASKS_OF_KEY:
        return rows
    return rows.repartition(max(-(-total // task), rows.sparkSession.sparkContext.defaultParallelism), key)


def join_frequent(rows: DataFrame, table: DataFrame, keys: Sequence[str], count: str, most: int = FREQUENT_KEYS) -> DataFrame:
    """Inner join of ``rows`` with ``table``, one row per key, whose ``count`` says how many rows have the key.

    The most frequent keys, ``most`` of them at most, are broadcast, and their rows stay where
    they are; only rows of the rarer keys are shuffled. Both inputs are read more than once.
    """
    digits = F.length(F.bin(count))
    # a row per power of two
    sizes = dict(table.groupBy(digits.alias("digits")).agg(F.count("*").alias("n")).collect())
    least, frequent = max(sizes, default=0) + 1, 0
    while least > 1 and frequent + sizes.get(least - 1, 0) <= most:
        least -= 1
        frequent += sizes.get(least, 0)
    if least == 1:
        return rows.join(F.broadcast(table), list(keys))
    if not frequent:
        return rows.join(table, list(keys))
    hot, rare = F.broadcast(table.where(digits >= least)), table.where(digits < least)
    return rows.join(hot, list(keys)).unionByName(rows.join(hot.select(*keys), list(keys), "left_anti").join(rare, list(keys)))


def expand_ids(rows: DataFrame, collections: DataFrame, item_rule: Column) -> DataFrame:
    """``id`` to ``item``: an item stays, a collection becomes its items, another id goes."""
    items = rows.where(item_rule).withColumn("item", F.col("id"))
    members = rows.where(~item_rule).join(collections.select(F.col("collection").alias("id"), "item"), "id")
    return items.unionByName(members).drop("id")


def with_group_max(rows: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The largest value of the group on each of its rows."""
    return rows.join(rows.groupBy(*keys).agg(F.max(value).alias(name)), list(keys))


# ---------------------------------------------------------------- aggregations


def term_frequency(tags: DataFrame) -> DataFrame:
    return tags.groupBy("channel", "item", "tag").agg(F.count("*").alias("tf"))


def inverse_frequency(tf: DataFrame, items: DataFrame | None = None, with_df: bool = False) -> DataFrame:
    """(channel, tag, idf[, df]) with idf = ln((N + 1) / (df + 1)), N the rows of the channel."""
    of = tf if items is None else items
    sizes = of.select("channel", "item").distinct().groupBy("channel").agg(F.count("*").alias("n"))
    df = tf.groupBy("channel", "tag").agg(F.count("*").alias("df"))
    # a catalogue has a handful of channels, so the table of their sizes is small by construction
    return df.join(F.broadcast(sizes), "channel").select("channel", "tag", F.log((F.col("n") + 1) / (F.col("df") + 1)).alias("idf"), *(["df"] if with_df else []))


def sum_merge(rows: DataFrame, keys: Sequence[str], value: str = "weight", digits: int = 9) -> DataFrame:
    """Weights added up per key; rounded, so that ranks do not hang on the order of sums."""
    return rows.groupBy(*keys).agg(F.round(F.sum(value), digits).alias(value))


def _ranked(rows: DataFrame, group: Sequence[str], count: int, order: Sequence[Column]) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn("__rank", place).where(F.col("__rank") <= count).drop("__rank")


def salted_top_k(rows: DataFrame, group: Sequence[str], count: int, order: Sequence[Column], tie: Sequence[str], salts: int = SALTS) -> DataFrame:
    """The first ``count`` rows of each of ``salts`` parts of a group: among them are its first ``count``."""
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*tie), F.lit(salts)))
    return _ranked(salted, [*group, "__salt"], count, order).drop("__salt")


def top_k(rows: DataFrame, group: Sequence[str], count: int, value: str = "weight", tie: Sequence[str] = ("tag",), ascending: bool = False) -> DataFrame:
    """The ``count`` rows of largest value in each group; ties by id.

    Up to ``GROUP_LIMIT`` rows Spark cuts groups before it shuffles them. Above, a group
    is cut in parts first, so that a hot one does not meet in one task whole.
    """
    order = [F.col(value).asc() if ascending else F.col(value).desc(), *map(F.col, tie)]
    return _ranked(rows if count <= GROUP_LIMIT else salted_top_k(rows, group, count, order, tie), group, count, order)


def enrich(rows: DataFrame, table: DataFrame, key: str | Sequence[str], required: bool = False) -> DataFrame:
    """``rows`` with the columns of their key in ``table``: null where it has none, or without such rows if ``required``."""
    return rows.join(table, key, "inner" if required else "left")


def above(rows: DataFrame, least: float, value: str = "weight") -> DataFrame:
    """Rows of a value above ``least``."""
    return rows.where(F.col(value) > least)


def supported(rows: DataFrame, keys: Sequence[str], least: int, count: Column | None = None) -> DataFrame:
    """(keys, n) of keys with more than ``least`` rows, or a larger sum of ``count``."""
    return above(rows.groupBy(*keys).agg((F.count("*") if count is None else F.sum(count)).alias("n")), least, "n")


def max_norm(rows: DataFrame, group: Sequence[str], value: str = "weight", times: float = 1.0, hot: bool = False) -> DataFrame:
    """Values over the group's largest; 0 where that is 0.

    ``hot`` is for keys of which one may hold a large part of the rows: the largest
    values are aggregated first and joined, and AQE splits a skewed join, which it
    cannot do with a window. Rows without a key have no group then.
    """
    if hot:
        top = rows.groupBy(*group).agg(F.max(value).alias("__top"))
        share = F.try_divide(F.col(value), F.col("__top"))
        return rows.join(top, list(group)).withColumn(value, F.round(F.coalesce(share, F.lit(0.0)) * times, 9)).drop("__top")
    share = F.try_divide(F.col(value), F.max(value).over(Window.partitionBy(*group)))
    return rows.withColumn(value, F.round(F.coalesce(share, F.lit(0.0)) * times, 9))


def l2_norm(rows: DataFrame, group: Sequence[str], value: str = "weight") -> DataFrame:
    """Values over the group's Euclidean length; zero values are dropped."""
    length = F.sqrt(F.sum(F.col(value) * F.col(value)).over(Window.partitionBy(*group)))
    return rows.where(F.col(value) != 0).withColumn(value, F.col(value) / length)


def postings(rows: DataFrame, key: str, item: str, count: int | None = None, value: str = "weight") -> DataFrame:
    """Ranked list of (id, weight) per key, cut to ``count`` before it is collected.

    Without a ``count`` the keys must be known to have short lists, as items have tags.
    """
    ranked = rows if count is None else top_k(rows, [key], count, value, (item,))
    entry = F.struct((-F.col(value)).alias("o"), F.col(item).alias("id"), F.col(value).alias("weight"))
    lists = ranked.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("values"))
    return lists.select(key, F.transform("values", lambda x: F.struct(x["id"].alias("id"), x["weight"].alias("weight"))).alias("values"))


def weighted_merge(lists: DataFrame, key: str, count: int) -> DataFrame:
    """Several ranked lists per key to one: weights added, the largest ``count`` kept."""
    rows = lists.select(key, F.explode("values").alias("v")).select(key, F.col("v.id").alias("id"), F.col("v.weight").alias("weight"))
    return top_k(sum_merge(rows, [key, "id"]), [key], count, tie=("id",))


def add_maps(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return sum_merge(left.unionByName(right), keys)


def chunk_number(rows: DataFrame, key: str, element: Column, size: Column, chunk: int = CHUNK) -> DataFrame:
    """``rows`` with ``chunk``, from 0: elements of a key dealt by hash to as many chunks as its sizes fill.

    The sizes of a key are aggregated first and joined, where AQE splits a hot key's rows;
    then each chunk is a group of its own, so that those of a hot key go to many tasks.
    """
    totals = rows.groupBy(F.col(key).alias("__key")).agg(F.ceil(F.sum(size) / chunk).cast("int").alias("__chunks"))
    numbered = rows.join(totals, F.col(key).eqNullSafe(F.col("__key")))
    return numbered.withColumn("chunk", F.pmod(F.xxhash64(element), F.col("__chunks")).cast("int")).drop("__chunks", "__key").repartition(key, "chunk")


def flat_set(rows: DataFrame, key: str, values: str, chunk: int = CHUNK) -> DataFrame:
    """(key, chunk, values): distinct elements of all arrays of a key, sorted.

    A key of more than ``chunk`` elements has several numbered rows of about that many.
    """
    each = rows.select(key, F.explode(values).alias("__v")).distinct()
    numbered = chunk_number(each, key, F.col("__v"), F.lit(1), chunk)
    return numbered.groupBy(key, "chunk").agg(F.array_sort(F.collect_list("__v")).alias(values))


def flat_list(rows: DataFrame, key: str, values: str, chunk: int = CHUNK) -> DataFrame:
    """(key, chunk, values): all elements of all arrays of a key, sorted, in numbered rows as of :func:`flat_set`.

    Equal elements are counted before they meet, and a count above ``chunk`` is cut.
    """
    counted = rows.select(key, F.explode(values).alias("__v")).groupBy(key, "__v").agg(F.count("*").alias("__n"))
    piece = F.explode(F.sequence(F.lit(0), F.expr(f"(__n - 1) div {chunk}"))).alias("__piece")
    pieces = counted.select(key, "__v", "__n", piece).select(key, "__v", "__piece", F.least(F.lit(chunk), F.col("__n") - F.col("__piece") * chunk).cast("int").alias("__n"))
    numbered = chunk_number(pieces, key, F.struct("__v", "__piece"), F.col("__n"), chunk)
    runs = F.array_sort(F.collect_list(F.struct("__v", "__n")))
    lists = numbered.groupBy(key, "chunk").agg(runs.alias("__runs"))
    return lists.select(key, "chunk", F.flatten(F.transform("__runs", lambda x: F.array_repeat(x["__v"], x["__n"]))).alias(values))


def ratio_of_sums(rows: DataFrame, keys: Sequence[str], top: str, bottom: str, top_min: int, bottom_min: int, name: str = "ctr") -> DataFrame:
    """sum(top) / sum(bottom) where either sum is above its minimum and the ratio is at most 1."""
    sums = rows.groupBy(*keys).agg(F.sum(top).alias(top), F.sum(bottom).alias(bottom))
    kept = sums.where((F.col(top) > top_min) | (F.col(bottom) > bottom_min)).withColumn(name, F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double")))
    return kept.where(F.col(name) <= 1)


def histogram(rows: DataFrame, kind: str, count: str) -> DataFrame:
    """Rows per kind and bucket: 0 to 10 each, decades to 100, hundreds to 1000, then one."""
    n = F.col(count)
    bucket = (
        F.when(n <= 10, F.format_string("%04d", n.cast("int")))
        .when(n <= 100, F.format_string("(%04d-%04d]", (F.floor((n - 1) / 10) * 10).cast("int"), (F.floor((n - 1) / 10) * 10 + 10).cast("int")))
        .when(n <= 1000, F.format_string("(%04d-%04d]", (F.floor((n - 1) / 100) * 100).cast("int"), (F.floor((n - 1) / 100) * 100 + 100).cast("int")))
        .otherwise(F.lit(">1000"))
    )
    return rows.groupBy(F.col(kind), bucket.alias("bucket")).agg(F.count("*").alias("n"))


def list_profile(lengths: DataFrame, length: str = "length", buckets: int = 10) -> DataFrame:
    """One row: keys, mean length, interval (mean / 5) and counts per interval, the last open."""
    totals = F.broadcast(lengths.agg(F.count("*").alias("keys"), F.avg(length).alias("mean_length")))  # one row
    placed = lengths.join(totals).withColumn("b", F.least(F.coalesce(F.floor(F.try_divide(F.col(length), F.col("mean_length") / 5)), F.lit(0)), F.lit(buckets - 1)))
    counts = [F.count(F.when(F.col("b") == i, 1)).alias(f"b{i}") for i in range(buckets)]
    return placed.agg(F.max("keys").alias("keys"), F.max("mean_length").alias("mean_length"), (F.max("mean_length") / 5).alias("interval"), *counts)


# ----------------------------------------------------------------------- pairs


def shared_tag_pairs(rows: DataFrame, limit: int, with_tags: bool = False) -> DataFrame:
    """(item, other, sim, shared[, tags]) of items that share a tag within its ``limit`` heaviest.

    The limit is what bounds the pairs: at most ``limit`` squared per tag. ``tags`` are
    the shared ones, sorted.
    """
    own = top_k(rows.select("tag", "item", "weight"), ["tag"], limit, tie=("item",))
    other = own.select("tag", F.col("item").alias("other"), F.col("weight").alias("other_weight"))
    pairs = own.join(other, "tag").where("item <> other")
    return pairs.groupBy("item", "other").agg(F.round(F.sum(F.col("weight") * F.col("other_weight")), 9).alias("sim"), F.count("*").alias("shared"), *([F.array_sort(F.collect_set("tag")).alias("tags")] if with_tags else []))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def clustered(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of a key in one partition, sorted there."""
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order)


def hash_sample(rows: DataFrame, key: str, percent: int) -> DataFrame:
    """A sample that is the same on every run: by hash of the key."""
    return rows.where(F.pmod(X.text_hash(F.col(key).cast("string")), F.lit(100)) < percent)
