"""The synthetic tables in the roles of catalogue, logs and lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import exprs as X
from tagloom.operators import frames as O
from tagloom.plans import tags as T
from tagloom.plans import users as U

CHANNELS = (T.Channel("name", "p_name", " ", 0.8), T.Channel("brand", "p_brand", None, 2.0), T.Channel("type", "p_type", None, 1.0))


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("item"), "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


def channels(spark: SparkSession, d: str) -> DataFrame:
    return T.channel_tags(parts(spark, d), "item", CHANNELS)


def dictionary_rows(spark: SparkSession, d: str) -> DataFrame:
    p = parts(spark, d)
    brands = p.select(F.col("p_brand").alias("tag"), X.first_int(F.col("p_brand")).cast("long").alias("tag_id"))
    return brands.union(p.select("p_type", F.col("p_size").cast("long")))


def weighted(spark: SparkSession, d: str) -> DataFrame:
    return T.tf_idf(channels(spark, d))


def merged(spark: SparkSession, d: str) -> DataFrame:
    return T.merge_tags(weighted(spark, d))


def _lines(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("item"), F.col("l_shipdate").alias("ts"), F.col("l_quantity").alias("play"))
    return lines.withColumn("day", F.to_date("ts"))


def _played(lines: DataFrame, spark: SparkSession, d: str, *more: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("user"))
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "user", "item", "ts", "day", "play", F.lit(50.0).alias("duration"), (F.col("play") / 50).alias("percent"), "l_orderkey", "l_linenumber", *more
    )


def plays(spark: SparkSession, d: str) -> DataFrame:
    return _played(_lines(spark, d), spark, d)


def with_today(rows: DataFrame, spark: SparkSession, d: str) -> DataFrame:
    """The newest ship date on every row; the table of it has one row."""
    newest = table(spark, d, "lineitem").agg(F.to_date(F.max("l_shipdate")).alias("as_of"))
    return rows.join(F.broadcast(newest))


def month(spark: SparkSession, d: str) -> DataFrame:
    # lines of other months go before they are joined to orders
    lines = with_today(_lines(spark, d), spark, d).withColumn("age", F.datediff("as_of", "day"))
    return _played(lines.where(F.col("age").between(0, 30)), spark, d, "as_of", "age")


def pool(spark: SparkSession, d: str) -> DataFrame:
    return parts(spark, d).where(F.col("p_size").between(1, 25)).select("item")


def exposures(spark: SparkSession, d: str) -> DataFrame:
    """Log rows as texts: item, zone (day of the week), exposure, click, flag."""
    one = lambda kind: (F.col("event_type") == kind).cast("int").cast("string")
    zone = (F.dayofweek("ts") - 1).cast("string")
    return table(spark, d, "events").select(F.col("user_id").alias("item"), zone.alias("zone"), one("view").alias("exposure"), one("click").alias("click"), F.when(F.col("event_type") == "error", "insert").otherwise("").alias("flag"))


def searches(spark: SparkSession, d: str) -> DataFrame:
    return plays(spark, d).join(parts(spark, d), "item").select("user", F.col("item").alias("id"), F.col("p_name").alias("query"))


def query_counts(spark: SparkSession, d: str) -> DataFrame:
    return T.query_tag_counts(searches(spark, d), members(spark, d), F.lit(True), min_count=5)


def posted(spark: SparkSession, d: str) -> DataFrame:
    return T.invert(merged(spark, d), pool(spark, d))


def user_days(spark: SparkSession, d: str) -> DataFrame:
    return U.daily_tags(month(spark, d), merged(spark, d))


def today(spark: SparkSession, d: str) -> Column:
    """The newest ship date as a literal, which prunes folders by day: one row to the driver."""
    return F.lit(table(spark, d, "lineitem").agg(F.to_date(F.max("l_shipdate"))).first()[0]).cast("date")


def user_months(spark: SparkSession, d: str) -> DataFrame:
    return U.monthly(with_today(user_days(spark, d), spark, d), F.col("as_of"), ["tag"])


def members(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("collection"), F.col("l_partkey").alias("item")).distinct()


def episode_members(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("collection"), F.col("l_partkey").alias("item")).agg(F.max("l_linenumber").cast("long").alias("number"))


def episode_weights(spark: SparkSession, d: str) -> DataFrame:
    latest = O.with_group_max(episode_members(spark, d), ["collection"], "number", "latest")
    return latest.withColumn("weight", X.episode_weight(F.col("number"), F.col("latest")))


def titles(spark: SparkSession, d: str) -> DataFrame:
    return parts(spark, d).select("item", F.col("p_name").alias("title"))


def click_rows(spark: SparkSession, d: str) -> DataFrame:
    return exposures(spark, d)
