"""Sources: positional text, dated tables, lists and ranked lists."""

from __future__ import annotations

import contextlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_tsv(spark: SparkSession, path: str | list[str], columns: dict[str, int], min_columns: int) -> DataFrame:
    """Named columns of tab-separated lines; shorter lines are dropped, trailing empty cells count."""
    cells = spark.read.text(path).select(F.split("value", "\t", -1).alias("c")).where(F.size("c") >= min_columns)
    return cells.select(*(F.col("c")[i].alias(name) for name, i in columns.items()))


def read_parquet(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The named columns of one or several Parquet tables."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path)).select(*columns)


def last_days(table: DataFrame, day: str, as_of: Column, days: int, include_today: bool = False) -> DataFrame:
    """Rows of the ``days`` days before ``as_of``; with today one day more."""
    newest = as_of if include_today else F.date_sub(as_of, 1)
    return table.where(F.col(day).between(F.date_sub(as_of, days), newest))


def newest_hours(table: DataFrame, ts: str, hours: int = 168) -> DataFrame:
    """Rows of the last ``hours`` hours up to the newest."""
    newest = table.agg(F.max(ts).alias("__newest"))  # one row
    return table.join(F.broadcast(newest), F.col(ts) > F.col("__newest") - F.make_interval(hours=F.lit(hours))).drop("__newest")


def latest_partition(table: DataFrame, key: str) -> DataFrame:
    """Rows of the largest value of ``key``."""
    newest = table.agg(F.max(key).alias("__newest"))  # one row
    return table.join(F.broadcast(newest), F.col(key) == F.col("__newest")).drop("__newest")


def _complete(fs, path, nested: int = 8) -> bool:
    """Whether a folder or one in it has a ``_SUCCESS`` file, or a ``.check`` file that gives the number of the other entries."""
    entries = list(fs.listStatus(path))
    for entry in entries:
        name = entry.getPath().getName()
        if entry.isDirectory():
            if nested and _complete(fs, entry.getPath(), nested - 1):
                return True
        elif "_SUCCESS" in name:
            return True
        elif ".check" in name:
            with contextlib.closing(fs.open(entry.getPath())) as stream:
                text = bytes(stream.readNBytes(32)).decode("ascii", "replace").split("\n")[0].strip()
            if text.isdigit() and int(text) == len(entries) - 1:
                return True
    return False


def latest_complete_path(spark: SparkSession, path: str, newest: int = 5) -> str | None:
    """The newest of the last numeric sub-folders that are complete: a ``_SUCCESS`` file, or a ``.check`` file with the right count."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted((s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory() and s.getPath().getName().isdigit()), key=int, reverse=True)
    for name in names[:newest]:
        if _complete(fs, jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")):
            return f"{path}/{name}"
    return None


def read_json(spark: SparkSession, path: str, schema: str, names: Sequence[str]) -> DataFrame:
    """JSON lines with a given schema, columns renamed."""
    return spark.read.schema(schema).json(path).toDF(*names)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header line."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct lines, trimmed and in lower case, as ``word``."""
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("word")).where("word <> ''").distinct()


def read_key_days(spark: SparkSession, path: str) -> DataFrame:
    """``key=days`` before the first blank of lines that hold a ``#``."""
    first = F.split(F.split("value", " ")[0], "=")
    pairs = spark.read.text(path).where(F.contains("value", F.lit("#"))).select(first.alias("p")).where(F.size("p") == 2)
    return pairs.select(F.col("p")[0].alias("key"), F.col("p")[1].try_cast("int").alias("days"))


def read_ranked_lists(spark: SparkSession, path: str) -> DataFrame:
    """Rows (key, id, weight) of ``key<TAB>id,weight;id,weight`` lines; elements without a weight are dropped."""
    cells = spark.read.text(path).select(F.split("value", "\t").alias("c")).where(F.size("c") >= 2)
    parts = cells.select(F.col("c")[0].alias("key"), F.explode(F.split(F.col("c")[1], ";")).alias("part")).select("key", F.split("part", ",").alias("p"))
    return parts.where(F.size("p") == 2).select("key", F.col("p")[0].alias("id"), F.col("p")[1].try_cast("double").alias("weight")).where("weight is not null")
