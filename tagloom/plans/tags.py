"""Item tags: channels, TF-IDF, merges, inverted lists, query tags."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import exprs as X
from tagloom.operators import frames as O
from tagloom.sources.scratch import written


class Channel(NamedTuple):
    """A catalogue column that holds tags; without a delimiter its text is one tag."""

    name: str
    column: str
    delimiter: str | None = None
    weight: float = 1.0


def dictionary(rows: DataFrame, online: Column | None = None) -> DataFrame:
    """(tag, tag_id) of online tags that have exactly one id."""
    kept = rows if online is None else rows.where(online)
    return O.unique_keys(kept.select(F.trim("tag").alias("tag"), "tag_id"), "tag", "tag_id")


def channel_tags(catalogue: DataFrame, item: str, channels: Sequence[Channel], known: DataFrame | None = None, stop_words: DataFrame | None = None) -> DataFrame:
    """(channel, item, tag, channel_weight[, tag_id, tag_type]) of all channels, in one pass."""
    parts = F.array(*[F.struct(F.lit(c.name).alias("channel"), F.lit(float(c.weight)).alias("channel_weight"), X.drop_digit_tags(X.split_tags(F.col(c.column), c.delimiter)).alias("tags")) for c in channels])
    long = catalogue.select(F.col(item).alias("item"), F.explode(parts).alias("c")).select("c.channel", "item", F.explode("c.tags").alias("tag"), "c.channel_weight")
    if stop_words is not None:
        long = long.join(O.small(stop_words.select(F.col("word").alias("tag"))), "tag", "left_anti")
    return long if known is None else O.lookup(long, O.small(known), "tag", "tag_id", X.tag_id_hash(F.col("tag")))


def text_tags(texts: DataFrame, item: str, text: str, channel: str, weight: float = 1.0) -> DataFrame:
    """(channel, item, tag, channel_weight) of all words of whole texts.

    Texts are shuffled, not their many more bytes of counted words.
    """
    dealt = O.dealt_by_size(texts.select(F.col(item).alias("item"), F.col(text).alias("text")), "item", F.octet_length("text"))
    return dealt.select(F.lit(channel).alias("channel"), "item", F.explode(X.word_tokens(F.col("text"))).alias("tag"), F.lit(weight).alias("channel_weight"))


def collection_tags(collections: DataFrame, members: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(item, tag): the tags of a collection on each of its items."""
    pushed = collections.select("collection", "tag").distinct().join(members.select("collection", "item").distinct(), "collection").select("item", "tag").distinct()
    return pushed if known is None else O.lookup(pushed, O.small(known), "tag", "tag_id", X.tag_id_hash(F.col("tag")))


def collection_rollup(item_tags: DataFrame, members: DataFrame, own: DataFrame | None = None) -> DataFrame:
    """(collection, key_name, tag): tags of the items, and the collection's own by name."""
    members = written(members.select("collection", "item"), "members")
    tags, items = item_tags.agg(F.count("*"), F.approx_count_distinct("item")).first()
    about = members.count() * -(-tags // max(1, items))
    # the join makes many long rows of few short ones: tasks are sized by what it makes, not by what they read
    dealt = members if about <= O.TASK_ROWS else members.repartition(-(-about // O.TASK_ROWS), "item")
    pulled = item_tags.select("item", "tag").join(dealt, "item").select("collection", F.lit("items").alias("key_name"), "tag")
    return O.distinct_rows(pulled if own is None else pulled.unionByName(own.select("collection", "key_name", "tag")), about, O.TASK_ROWS)


def tf_idf(tags: DataFrame, tf_mode: str = "linear") -> DataFrame:
    """(channel, item, tag, weight): tf * ln((N + 1) / (df + 1)) * channel weight.

    ``tf_mode`` "per_occurrence" counts each occurrence with its tf, so tf squared. Texts
    are split once: the counts are written to the shared folder, and document counts,
    channel sizes and weights are made from them. Large ones meet the frequent tags'
    document counts where they are, without a shuffle.
    """
    tf = written(tags.groupBy("channel", "item", "tag").agg(F.count("*").alias("tf"), F.max("channel_weight").alias("channel_weight")), "tf")
    power = F.col("tf") if tf_mode == "linear" else F.col("tf") * F.col("tf")
    if tf.count() <= O.BROADCAST_ROWS:
        joined = tf.join(O.inverse_frequency(tf), ["channel", "tag"])
    else:
        joined = O.join_frequent(tf, written(O.inverse_frequency(tf, with_df=True), "idf"), ["channel", "tag"], "df")
    return joined.select("channel", "item", "tag", F.round(power * F.col("idf") * F.col("channel_weight"), 9).alias("weight"))


def merge_tags(weighted: DataFrame, count: int = 30, left_out: Sequence[str] = ()) -> DataFrame:
    """(item, tag, weight): channels added up, the largest kept, over the item's largest."""
    kept = weighted.where(~F.col("channel").isin(*left_out)) if left_out else weighted
    return O.max_norm(O.top_k(O.sum_merge(kept, ["item", "tag"]), ["item"], count), ["item"])


def merge_l2(weighted: DataFrame) -> DataFrame:
    """(item, tag, weight): the sum of all channels with unit length."""
    return O.l2_norm(O.sum_merge(weighted, ["item", "tag"]), ["item"])


def final_item_tags(merged: DataFrame, durations: DataFrame, count: int = 100) -> DataFrame:
    """(item, tag, weight, duration), the largest ``count``; an unknown duration is 0."""
    ranked = O.top_k(merged, ["item"], count)
    return O.enrich(ranked, durations, "item").withColumn("duration", F.coalesce("duration", F.lit(0)))


def invert(merged: DataFrame, pool: DataFrame, count: int | None = None) -> DataFrame:
    """(tag, item, weight) of items in the pool, per tag the largest ``count``."""
    kept = O.restrict(merged.select("tag", "item", "weight"), pool, "item")
    return kept if count is None else O.top_k(kept, ["tag"], count, tie=("item",))


def vocabulary(tags: DataFrame, titles: DataFrame, patterns: Sequence[str] = X.TITLE_PATTERNS) -> DataFrame:
    """Distinct words: tags and cleaned titles in lower case, longer than one character."""
    clean = titles.select(X.clean_title(F.col("title"), patterns).alias("word"))
    return tags.select(F.col("tag").alias("word")).union(clean).select(X.lower_trim(F.col("word")).alias("word")).where(F.length("word") > 1).distinct()


def query_tokens(queries: DataFrame, lexicon: DataFrame | None = None, kinds: Sequence[str] = (), stop_words: DataFrame | None = None) -> DataFrame:
    """``queries`` with one row per token (word or two-word phrase) of ``query``.

    A lexicon (word, kind) keeps its words of the given kinds only.
    """
    tokens = F.array_distinct(F.concat(X.word_tokens(F.col("query")), X.phrase_tokens(F.col("query"))))
    rows = queries.withColumn("tag", F.explode(tokens)).drop("query")
    if lexicon is not None:
        rows = rows.join(lexicon.where(F.col("kind").isin(*kinds)).select(F.col("word").alias("tag")), "tag", "left_semi")
    if stop_words is not None:
        rows = rows.join(O.small(stop_words.select(F.col("word").alias("tag"))), "tag", "left_anti")
    return rows


def query_tag_counts(searches: DataFrame, collections: DataFrame, item_rule: Column, min_count: int = 20, **tokens) -> DataFrame:
    """(item, tag, n): searches per item and query above ``min_count``, by token."""
    counted = searches.groupBy("id", "query").agg(F.count("*").alias("n"))
    supported = O.supported(O.expand_ids(counted, collections, item_rule), ["item", "query"], min_count, F.col("n"))
    return query_tokens(supported, **tokens).groupBy("item", "tag").agg(F.sum("n").alias("n"))


def query_tags(counts: DataFrame, count: int = 30, min_weight: float = 0.01) -> DataFrame:
    """(item, tag, weight): counts over the item's largest, the largest kept."""
    rows = O.max_norm(counts.withColumn("weight", F.col("n").cast("double")).drop("n"), ["item"])
    return O.top_k(O.above(rows, min_weight), ["item"], count)


def query_postings(counts: DataFrame, pool: DataFrame, min_weight: float = 0.01) -> DataFrame:
    """(tag, item, weight): counts of pool items over the tag's largest."""
    rows = O.max_norm(O.restrict(counts, pool, "item").withColumn("weight", F.col("n").cast("double")).drop("n"), ["tag"], hot=True)
    return O.above(rows, min_weight)


def join_tags(content: DataFrame, query: DataFrame, count: int = 30) -> DataFrame:
    """Content and query tags of an item: each side's largest, added, squashed."""
    sides = [O.top_k(side.select("item", "tag", "weight"), ["item"], count) for side in (content, query)]
    merged = O.top_k(O.sum_merge(O.union_all(sides), ["item", "tag"]), ["item"], count)
    return merged.withColumn("weight", X.sigmoid(F.col("weight")))


def tag_ids(*frames: DataFrame) -> DataFrame:
    """Distinct (tag, tag_id) of all frames."""
    return O.union_all([f.select("tag", "tag_id") for f in frames]).distinct()


def join_postings(*lists: DataFrame, count: int = 1000) -> DataFrame:
    """Inverted lists added up, squashed, the largest per tag."""
    merged = O.sum_merge(O.union_all([x.select("tag", "item", "weight") for x in lists]), ["tag", "item"])
    return O.top_k(merged.withColumn("weight", F.round(X.sigmoid(F.col("weight")), 9)), ["tag"], count, tie=("item",))


def ctr_postings(lists: DataFrame, ctr: DataFrame, count: int = 200, share: float = 0.1, ascending: bool = False) -> DataFrame:
    """Inverted lists weighed by click rate where it beats ``share`` of the weight."""
    per_item = ctr.groupBy("item").agg(F.max("ctr").alias("ctr"))
    low = F.col("weight") * share
    use = F.coalesce(F.col("ctr") > low, F.lit(False))
    blended = O.enrich(lists, per_item, "item").select("tag", "item", F.round(F.when(use, F.col("ctr")).otherwise(low), 9).alias("weight"), F.when(use, "ctr").otherwise("tag").alias("weight_type"))
    return O.top_k(blended, ["tag"], count, tie=("item",), ascending=ascending)


def controlled_lists(item_tags: DataFrame, control: DataFrame, pool: DataFrame, count: int = 100) -> DataFrame:
    """(item, tag, weight, is_normal, timestamp) of pool items, the largest tags."""
    rows = O.restrict(item_tags.select("item", "tag", "weight").distinct(), pool, "item")
    return O.top_k(rows, ["item"], count).join(control.dropDuplicates(["item"]), "item")
