"""Sinks: serving payloads, flat files and statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import exprs as X

DAY = 24 * 60 * 60


def entry_text(tag_type: int, digits: int = 4) -> Callable[[Column], Column]:
    """``id[:type]:weight`` of a struct (id, weight); type -1 is left out."""
    middle = "" if tag_type == -1 else f":{tag_type}"
    return lambda x: F.concat(x["id"].cast("string"), F.lit(middle + ":"), X.format_weight(x["weight"], digits))


def payload(lists: DataFrame, key: str, namespace: str, prefix: str, tag_type: int, mode: str = "append", ttl_s: int = 7 * DAY, take: int | None = None, limit: int | None = None, digits: int = 4) -> DataFrame:
    """(op, key, values, ttl_s) of ranked lists ``values``; mode is append, replace or delete."""
    if mode not in ("append", "replace", "delete"):
        raise ValueError(f"unknown mode {mode}")
    rows = lists if limit is None else lists.limit(limit)
    name = F.concat(F.lit(f"{namespace}_{prefix}_"), F.col(key).cast("string"))
    values = F.array().cast("array<string>") if mode == "delete" else F.transform(X.top_of_list(F.col("values"), take or 2_000_000_000), entry_text(tag_type, digits))
    return rows.select(F.lit(mode).alias("op"), name.alias("key"), values.alias("values"), F.lit(0 if mode == "delete" else ttl_s).alias("ttl_s"))


def controlled_payload(lists: DataFrame, state: DataFrame, namespace: str, prefix: str, tag_type: int, ttl_s: int = 7 * DAY) -> DataFrame:
    """Replacing payload whose first value is ``timestamp#normal``.

    ``lists`` has item, values, is_normal and timestamp; ``state`` (key, header)
    is what the store holds. A stored header stays unless it is missing, has no
    ``#`` or an older timestamp.
    """
    base = payload(lists.withColumn("values", F.col("values")), "item", namespace, prefix, tag_type, "replace", ttl_s)
    fresh = lists.select(F.concat(F.lit(f"{namespace}_{prefix}_"), F.col("item").cast("string")).alias("key"), F.concat(F.col("timestamp").cast("string"), F.lit("#"), F.when(F.col("is_normal"), "1").otherwise("0")).alias("fresh"), "timestamp")
    joined = base.join(fresh, "key").join(state, "key", "left")
    stored = F.split("header", "#")[0].try_cast("long")
    use_new = F.col("header").isNull() | ~F.contains("header", F.lit("#")) | F.coalesce(stored < F.col("timestamp"), F.lit(True))
    return joined.select("op", "key", F.concat(F.array(F.when(use_new, F.col("fresh")).otherwise(F.col("header"))), F.col("values")).alias("values"), "ttl_s")


def flat_value(lists: DataFrame, key: str) -> DataFrame:
    """(key, value): ``tag#weight`` with three digits, one after the other, each tag once."""
    parts = F.array_distinct(F.transform("values", lambda x: F.concat(x["id"].cast("string"), F.lit("#"), X.format_weight(x["weight"], 3))))
    return lists.select(F.col(key).alias("key"), F.array_join(parts, "").alias("value"))


def deliver(rows: DataFrame, send: Callable[[Iterator], None]) -> None:
    """Hand the payload to the caller's writer, partition by partition."""
    rows.foreachPartition(send)


def write_channels(tags: DataFrame, path: str) -> None:
    """One folder per channel, in one job."""
    tags.write.mode("overwrite").partitionBy("channel").parquet(path)


def write_report(rows: DataFrame, path: str) -> None:
    """One CSV file with a header."""
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").text(path)


def append_stats(profile: DataFrame, name: str, day: str, path: str) -> None:
    """One line of statistics per call."""
    profile.select(F.lit(day).alias("day"), F.lit(name).alias("name"), "*").write.mode("append").parquet(path)
