"""Size-tiered compaction of immutable Parquet shards under a versioned manifest.

A shard's tier is the number of times that its size has to grow ``fanout``-fold to
reach the target. A store is a folder. Arrivals are appended as small shards;
compaction merges runs of shards of one tier into files of at most the target size.
Neither changes a file: each writes new ones and commits a new manifest version, a
table that names the live shards. A commit is one rename that fails if the version
exists.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.llm.common import coded

#: Shards that one merge job reads: bounds the list of paths on the driver.
WAVE_SHARDS = 10_000
#: Runs that one job merges: bounds its plan.
JOB_RUNS = 100

MANIFEST = "path string, tier int, rows long, bytes long, first_id long, last_id long, added long"


class CommitConflictError(RuntimeError):
    """Another writer committed the same manifest version first."""


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores added while a column has it."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


class ShardStore:
    """Append-only shards of rows with a ``doc_id``, under ``root``.

    Defined cases: a store without appends has version 0 and no rows; an append of no
    rows commits a version without new shards;
    rows are stored as they come, so nulls, empty or long texts, ties and
    repeated rows are kept; any further columns are stored too,
    also those that only some appends have, under any names; a column of types that
    do not merge is an error when shards are read, not a loss.
    """

    def __init__(self, spark: SparkSession, root: str, target_bytes: int = 128 << 20, fanout: int = 4):
        self.spark, self.root, self.target_bytes, self.fanout = spark, root.rstrip("/"), target_bytes, fanout
        jvm = spark.sparkContext._jvm
        self._fs = jvm.org.apache.hadoop.fs
        path = self._fs.Path(self.root)
        self._context = self._fs.FileContext.getFileContext(path.toUri(), spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------------------- manifest

    def versions(self) -> list[int]:
        folder = self._fs.Path(f"{self.root}/manifest")
        if not self._context.util().exists(folder):
            return []
        names = [s.getPath().getName() for s in self._context.util().listStatus(folder)]
        return sorted(int(n[1:]) for n in names if n.startswith("v"))

    def manifest(self, version: int | None = None) -> DataFrame:
        """The live shards of a version, by default of the newest."""
        known = self.versions()
        if not known:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/v{known[-1] if version is None else version:012d}")

    def _commit(self, manifest: DataFrame, version: int) -> int:
        staged = f"{self.root}/staged/{uuid.uuid4().hex}"
        manifest.select(*(f.split()[0] for f in MANIFEST.split(", "))).coalesce(1).write.parquet(staged)
        folder = self._fs.Path(f"{self.root}/manifest")
        self._context.mkdir(folder, self._fs.permission.FsPermission.getDirDefault(), True)
        choice = self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self._context.rename(self._fs.Path(staged), self._fs.Path(f"{self.root}/manifest/v{version:012d}"), choice)
        except Exception as error:
            self._remove(staged)
            if "AlreadyExists" in str(error):
                raise CommitConflictError(f"version {version} exists") from error
            raise
        return version

    def _remove(self, path: str) -> bool:
        return bool(self._context.delete(self._fs.Path(path), True))

    def _tier(self) -> Column:
        """Of a size in ``bytes``; sizes of one tier differ by less than ``fanout`` times."""
        return F.greatest(F.lit(0), F.ceil(F.log(F.lit(float(self.target_bytes)) / F.col("bytes")) / math.log(self.fanout))).cast("int")

    def _rows_in(self, paths: list[str]) -> DataFrame:
        """Rows of shards with the columns of all of them; a shard without a column has nulls there."""
        return self.spark.read.option("mergeSchema", True).parquet(*paths)

    def _shards_in(self, folder: str, version: int) -> DataFrame:
        """A manifest row per file of a folder just written."""
        try:
            written = self.spark.read.parquet(folder)
        except PySparkException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return self.spark.createDataFrame([], MANIFEST)
        return (
            written.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
            .agg(F.count("*").alias("rows"), F.min("doc_id").cast("long").alias("first_id"), F.max("doc_id").cast("long").alias("last_id"))
            .select("path", self._tier().alias("tier"), "rows", "bytes", "first_id", "last_id", F.lit(version).cast("long").alias("added"))
        )

    # -------------------------------------------------------------- writing

    def append(self, rows: DataFrame) -> int:
        """Add the rows as small shards, one per partition; returns the version.

        If another writer commits first, the shards are committed on top of its version.
        """
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").parquet(folder)
        while True:
            current = self.versions()
            version = current[-1] + 1 if current else 1
            live = self.manifest(current[-1]) if current else self.spark.createDataFrame([], MANIFEST)
            try:
                return self._commit(live.unionByName(self._shards_in(folder, version)), version)
            except CommitConflictError:
                continue

    def _plan(self, manifest: DataFrame) -> DataFrame:
        """(lane, run, path) of the shards to merge: runs within a tier, up to the target.

        A shard of half the target is done. A run is due with ``fanout`` shards, whose
        merge is of a lower tier, or with half the target. So a row is written at most
        once per tier, and a tier keeps fewer than ``fanout`` shards beside its full runs.
        """
        small = manifest.where(F.col("bytes") * 2 < self.target_bytes)
        lanes = max(1, -(-small.count() // WAVE_SHARDS))
        small = small.withColumns({"lane": F.pmod(F.xxhash64("path"), F.lit(lanes)), "tier": self._tier()})
        order = Window.partitionBy("lane", "tier").orderBy("bytes", "first_id", "path")
        # a run begins within a width of the one before, and its last shard has no more than what is left to the target
        width = F.lit(self.target_bytes) - F.max("bytes").over(Window.partitionBy("lane", "tier"))
        cut = small.withColumn("cut", F.floor((F.sum("bytes").over(order) - F.col("bytes")) / width))
        whole = Window.partitionBy("lane", "tier", "cut")
        due = (F.count("*").over(whole) >= self.fanout) | ((F.count("*").over(whole) > 1) & (F.sum("bytes").over(whole) * 2 >= self.target_bytes))
        runs = cut.withColumn("due", due).where("due")
        return runs.select("lane", (F.dense_rank().over(Window.partitionBy("lane").orderBy("tier", "cut")) - 1).alias("run"), "path")

    def compact(self) -> int | None:
        """One round of merges; returns the new version, or None if none was due.

        If another writer commits first, the merged files are deleted and
        CommitConflictError is raised; the round can be run again.
        """
        current = self.versions()
        if not current:
            return None
        live = self.manifest(current[-1])
        plan = self._plan(live)
        due = [r["lane"] for r in plan.select("lane").distinct().toLocalIterator()]
        if not due:
            return None
        version, added, folders = current[-1] + 1, [], []
        for lane in due:  # a lane holds about WAVE_SHARDS shards
            runs: dict[int, list[str]] = {}
            for row in plan.where(F.col("lane") == lane).select("run", "path").orderBy("run", "path").toLocalIterator():
                runs.setdefault(row["run"], []).append(row["path"])
            schema = self._rows_in([path for paths in runs.values() for path in paths]).schema
            # a run is read by one task, which writes one file of the target's size: no shuffle
            merges = [self.spark.read.schema(schema).parquet(*paths).coalesce(1) for paths in runs.values()]
            for begin in range(0, len(merges), JOB_RUNS):
                folders.append(f"{self.root}/data/{uuid.uuid4().hex}")
                reduce(DataFrame.union, merges[begin : begin + JOB_RUNS]).write.option("compression", "zstd").parquet(folders[-1])
                added.append(self._shards_in(folders[-1], version))
        merged = live.join(plan.select("path"), "path", "left_anti").select(*live.columns)
        for shards in added:
            merged = merged.unionByName(shards)
        try:
            return self._commit(merged, version)
        except CommitConflictError:
            for folder in folders:
                self._remove(folder)
            raise

    def compact_all(self) -> int:
        """Rounds of merges until none is due; returns the newest version, 0 of an empty store."""
        while self.compact() is not None:
            pass
        return max(self.versions(), default=0)

    def expire(self, keep_versions: int = 1) -> int:
        """Delete manifests but the newest ``keep_versions`` and the files only they name."""
        known = self.versions()
        old, new = known[:-keep_versions], known[-keep_versions:]
        if not old:
            return 0
        live = self.manifest(new[0])
        for v in new[1:]:
            live = live.unionByName(self.manifest(v))
        gone = 0
        for v in old:
            for row in self.manifest(v).join(live.select("path"), "path", "left_anti").select("path").toLocalIterator():
                gone += bool(self._context.delete(self._fs.Path(row["path"]), False))
            self._context.delete(self._fs.Path(f"{self.root}/manifest/v{v:012d}"), True)
        return gone

    # -------------------------------------------------------------- reading

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, with shard, tier, shard_rows and shard_bytes of their shard.

        Where a stored column has one of these names, underscores are added to the new one.
        A store without a version has no rows, and no columns but these.
        """
        if not self.versions():
            return self.spark.createDataFrame([], "shard int, tier int, shard_rows long, shard_bytes long")
        shards = self.manifest(version).withColumn("lane", F.lit(0))
        order = Window.partitionBy("lane").orderBy("tier", "first_id", "rows", "path")
        numbered = shards.select(F.col("path").alias("of_path"), F.row_number().over(order).alias("shard"), "tier", F.col("rows").alias("shard_rows"), F.col("bytes").alias("shard_bytes"))
        batches: list[list[str]] = [[]]
        for row in shards.select("path").orderBy("path").toLocalIterator():
            if len(batches[-1]) == WAVE_SHARDS:
                batches.append([])
            batches[-1].append(row["path"])
        # without shards, the columns of what was appended
        found = [self._rows_in(b) if b else self._rows_in([f"{self.root}/data/*"]).where("false") for b in batches]
        names = list(dict.fromkeys(c for part in found for c in part.columns))
        own_path = free_name("of_path", names)
        parts = [part.select(*(part[f"`{c}`"] for c in part.columns), F.col("_metadata.file_path").alias(own_path)) for part in found]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part, allowMissingColumns=True)
        own, coding = coded(rows)
        of_path = coding.pop(own_path)
        info = ["shard", "tier", "shard_rows", "shard_bytes"]
        joined = own.join(numbered.withColumnRenamed("of_path", of_path), of_path)
        return joined.select(*(F.col(c).alias(name) for name, c in coding.items()), *(F.col(c).alias(free_name(c, list(coding))) for c in info))
