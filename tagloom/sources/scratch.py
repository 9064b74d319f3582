"""Folders for tables that a job writes and reads again, and scopes that share and delete them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    A temporary folder stands in where that is unset and executors run in this process,
    as in tests; on a cluster it must be set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = current.get() if current.isDefined() else None
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tagloom-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tagloom-{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


class Scope:
    """Tables that were written inside, with the plans that they hold."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.tables: list[tuple[DataFrame, DataFrame, str]] = []

    def close(self) -> None:
        while self.tables:
            delete_folder(self.spark, self.tables.pop()[2])


_current: ContextVar[Scope | None] = ContextVar("scope", default=None)


@contextmanager
def scope(spark: SparkSession) -> Iterator[Scope]:
    """A job's tables: inside, equal plans share one written table, and at the end all are deleted.

    A frame made inside must be used up inside, as in

        with scope(spark):
            tags.tf_idf(rows).write.parquet(path)

    A scope inside another is part of it. Without a scope every call of :func:`written`
    makes a table, and its folder stays until :func:`clean`.
    """
    if _current.get() is not None:
        yield _current.get()
        return
    made = Scope(spark)
    token = _current.set(made)
    try:
        yield made
    finally:
        _current.reset(token)
        made.close()


#: Folders that were written outside a scope.
_loose: list[str] = []


def clean(spark: SparkSession) -> None:
    """Delete the tables that were written outside a scope; frames made from them end."""
    while _loose:
        delete_folder(spark, _loose.pop())


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` from a table in the shared folder: computed once, however often it is used."""
    inside = _current.get()
    if inside is not None:
        for plan, table, _ in inside.tables:
            if plan.columns == df.columns and plan.sameSemantics(df):
                return table
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    if inside is None:
        _loose.append(path)
    else:
        inside.tables.append((df, table, path))
    return table
