"""Reports: tag frequencies, ranked reports, histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions import exprs as X
from tagloom.operators import frames as O


def tag_frequency(items: DataFrame, tags: str, delimiter: str, max_duration: int = 600) -> DataFrame:
    """(tag, n) over items shorter than ``max_duration``, most frequent first."""
    rows = items.where(F.col("duration") < max_duration).select(F.explode(X.split_tags(F.col(tags), delimiter)).alias("tag"))
    return rows.groupBy("tag").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "tag")


def wanted_items(wanted: DataFrame, item_tags: DataFrame, count: int = 30) -> DataFrame:
    """(item, url, tags): ``tag###weight`` of wanted items that have tags."""
    lists = O.postings(O.restrict(item_tags, wanted, "item"), "item", "tag", count)
    return lists.select("item", X.page_url(F.col("item")).alias("url"), X.format_list(F.col("values"), ";", "###").alias("tags"))


def best_items_per_tag(wanted: DataFrame, item_tags: DataFrame, titles: DataFrame, per_item: int = 30, per_tag: int = 10) -> DataFrame:
    """(tag, item, title, weight) of wanted tags: the items on which they weigh most."""
    rows = O.top_k(item_tags, ["item"], per_item)
    kept = O.top_k(O.restrict(rows, wanted, "tag"), ["tag"], per_tag, tie=("item",))
    return O.enrich(kept, titles, "item").orderBy("tag", F.desc("weight"), "item")


def tags_per_item_histogram(item_tags: DataFrame) -> DataFrame:
    """Items per number of tags of each kind."""
    counts = item_tags.groupBy("item", "tag_type").agg(F.count("*").alias("tags"))
    return O.histogram(counts, "tag_type", "tags")


def wanted_tag_items(wanted: DataFrame, item_tag_lists: DataFrame, titles: DataFrame, count: int = 49) -> DataFrame:
    """(tag, rank, item, title, weight) of wanted tags found in the items' tag arrays."""
    rows = item_tag_lists.select("item", F.explode("values").alias("v")).select("item", F.col("v.id").alias("tag"), F.col("v.weight").alias("weight"))
    kept = O.top_k(O.restrict(rows, wanted, "tag"), ["tag"], count, tie=("item",))
    return O.enrich(kept, titles, "item").orderBy("tag", F.desc("weight"), "item")
