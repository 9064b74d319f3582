"""User profiles: plays, daily tags, decayed rollups, categories, collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import exprs as X
from tagloom.operators import frames as O


def clean_plays(raw: DataFrame, id_length: int | None = 11, step: int = 50, cap_percent: bool = False) -> DataFrame:
    """(user, ts, item, play, duration, percent) of finished plays.

    ``raw`` has user, ts, item, step, duration and a Base64 JSON payload with
    ``playduration``. The shown play is capped at twice the duration; the percent
    only with ``cap_percent``.
    """
    kept = raw.where((F.col("step") == step) & (F.col("user").cast("string") != "") & F.col("ts").isNotNull())
    if id_length is not None:
        kept = kept.where(F.length(F.col("item").cast("string")) == id_length)
    played = kept.withColumn("play", X.decoded_json(F.col("payload"), "playduration").try_cast("double")).where("play <> 0")
    capped = X.capped_play(F.col("play"), F.col("duration"))
    percent = X.play_ratio(capped if cap_percent else F.col("play"), F.col("duration"))
    return played.select("user", "ts", "item", capped.alias("play"), F.col("duration").cast("double").alias("duration"), percent.alias("percent"))


def play_sums(plays: DataFrame) -> DataFrame:
    """(user, item, duration, ratio) of distinct plays with a valid ratio."""
    valid = plays.select("user", "item", "ts", "play", "duration").distinct().where((F.col("play") > 1) & (F.col("duration") > 2))
    ratio = F.col("play") / F.col("duration")
    return valid.withColumn("ratio", ratio).where("ratio > 0.01").groupBy("user", "item", "duration").agg(F.round(F.sum("ratio"), 9).alias("ratio"))


def play_tags(plays: DataFrame, item_tags: DataFrame) -> DataFrame:
    """Plays with each tag of their item; the weight is percent times tag weight."""
    rows = O.enrich(plays, item_tags.select("item", "tag", "weight"), "item", required=True)
    return rows.withColumn("weight", F.col("percent") * F.col("weight"))


def daily_tags(plays: DataFrame, item_tags: DataFrame, min_weight: float = 0.01) -> DataFrame:
    """(day, user, tag, weight, squashed): percent times tag weight, added up per day."""
    rows = play_tags(plays.select("day", "user", "item", "percent"), item_tags)
    merged = O.above(O.sum_merge(rows, ["day", "user", "tag"]), min_weight)
    return merged.withColumn("squashed", X.sigmoid(F.col("weight")))


def daily_vectors(plays: DataFrame, item_tags: DataFrame, chunk: int = O.CHUNK) -> DataFrame:
    """(user, chunk, items, tags): items viewed, and the summed vector as a list by tag.

    Both stay long until the end. A user of more than ``chunk`` items or tags has several
    numbered rows of about that many; where one list is the longer, the other is empty.
    """
    vector = O.sum_merge(play_tags(plays.select("user", "item", "percent"), item_tags), ["user", "tag"])
    tags = O.chunk_number(vector, "user", F.col("tag"), F.lit(1), chunk).groupBy("user", "chunk").agg(F.array_sort(F.collect_list(F.struct(F.col("tag").alias("id"), "weight"))).alias("tags"))
    played = plays.select("user", "item").distinct().join(vector.select("user").distinct(), "user", "left_semi")
    items = O.chunk_number(played, "user", F.col("item"), F.lit(1), chunk).groupBy("user", "chunk").agg(F.array_sort(F.collect_list("item")).alias("items"))
    none = lambda name: F.coalesce(name, F.array()).alias(name)
    return items.join(tags, ["user", "chunk"], "full_outer").select("user", "chunk", none("items"), none("tags"))


def monthly(daily: DataFrame, as_of: Column, keys: list[str], days: int = 30, count: int = 100, by: str = "user") -> DataFrame:
    """Daily weights times their decay, added up; per user the largest ``count``."""
    age = F.datediff(as_of, F.col("day"))
    recent = daily.where((age >= 0) & (age <= days)).withColumn("weight", F.col("weight") * X.decay(age))
    return O.top_k(O.sum_merge(recent, [by, *keys]), [by], count, tie=keys)


def serving_weights(profile: DataFrame, count: int = 30, normalise: bool = True) -> DataFrame:
    """Per user the largest tags; with ``normalise`` twice ln(1 + w) over its largest."""
    top = O.top_k(profile, ["user"], count)
    return O.max_norm(top.withColumn("weight", X.log_weight(F.col("weight"))), ["user"], times=2.0) if normalise else top


def episodes(items: DataFrame, members: DataFrame) -> DataFrame:
    """(collection, item, number, latest, weight, epoch): weight n / latest.

    ``items`` has item, title (ending in ``_<n>`` for an episode) and published.
    """
    numbered = items.select("item", X.suffix_number(F.col("title")).alias("number"), X.epoch_seconds(F.col("published")).alias("epoch"))
    latest = O.with_group_max(members.join(numbered, "item"), ["collection"], "number", "latest")
    return latest.select("collection", "item", "number", "latest", X.episode_weight(F.col("number"), F.col("latest")).alias("weight"), "epoch")


def user_items(plays: DataFrame, weights: DataFrame, min_percent: float = 0.1, count: int = 100) -> DataFrame:
    """(day, user, item, weight, squashed): episode weight times percent."""
    rows = plays.where(F.col("percent") > min_percent).join(weights.groupBy("item").agg(F.max("weight").alias("own")), "item")
    merged = O.sum_merge(rows.withColumn("weight", F.col("percent") * F.col("own")), ["day", "user", "item"])
    return O.top_k(merged, ["day", "user"], count, tie=("item",)).withColumn("squashed", X.sigmoid(F.col("weight")))


def user_collections(plays: DataFrame, weights: DataFrame, min_percent: float = 0.1, count: int = 100) -> DataFrame:
    """(day, user, collection, weight): the same, added up per collection."""
    rows = plays.where(F.col("percent") > min_percent).join(weights.select("item", "collection", F.col("weight").alias("own")), "item")
    merged = O.sum_merge(rows.withColumn("weight", F.col("percent") * F.col("own")), ["day", "user", "collection"])
    return O.top_k(merged, ["day", "user"], count, tie=("collection",))


def user_collections_by_event(plays: DataFrame, weights: DataFrame, now: Column, min_percent: float = 0.1, count: int = 100) -> DataFrame:
    """(user, collection, weight): episode weight times percent, decayed by the time since each play, added up."""
    rows = plays.where(F.col("percent") > min_percent).join(weights.select("item", "collection", F.col("weight").alias("own")), "item")
    age = (F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(F.col("ts").cast("timestamp"))) / 86_400
    merged = O.sum_merge(rows.withColumn("weight", F.col("percent") * F.col("own") * X.decay(age)), ["user", "collection"])
    return O.top_k(merged, ["user"], count, tie=("collection",))


def item_categories(catalogue: DataFrame) -> DataFrame:
    """(item, first, second) of items with one category on either level."""
    return catalogue.where(X.is_single(F.col("first")) & X.is_single(F.col("second"))).select("item", "first", "second")


def daily_categories(plays: DataFrame, categories: DataFrame, min_percent: float = 0.1) -> DataFrame:
    """(day, user, first, second, weight): percents added up."""
    rows = plays.where(F.col("percent") > min_percent).join(categories, "item")
    return O.sum_merge(rows.withColumn("weight", F.col("percent")), ["day", "user", "first", "second"])


def interests(tags: DataFrame, categories: DataFrame, count: int = 30) -> DataFrame:
    """One line per user: categories ``a.b:w`` and tags ``id:w``, each the largest.

    ``tags`` has user, tag, weight (squashed here); ``categories`` user, category, weight.
    """
    squashed = O.top_k(tags, ["user"], count).withColumn("weight", X.sigmoid(F.col("weight")))
    lines = {
        "tags": O.postings(squashed, "user", "tag").select("user", X.format_list(F.col("values"), "|").alias("tags")),
        "categories": O.postings(O.top_k(categories, ["user"], count, tie=("category",)), "user", "category").select("user", X.format_list(F.col("values"), "|").alias("categories")),
    }
    both = lines["tags"].join(lines["categories"], "user", "full_outer")
    return both.select("user", X.profile_line(F.col("user"), F.col("categories"), F.col("tags")).alias("line"))
