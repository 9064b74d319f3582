"""Helpers that several training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.sources.scratch import scratch_path

#: White space that ends a word: blank and \t \n \v \f \r.
WHITESPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Bytes of text that numpy code handles at a time (a longer text goes alone).
SLICE_BYTES = 1 << 20


# --------------------------------------------------------------------- tables


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(keys: DataFrame, limit: int = 1_000_000) -> DataFrame:
    """``keys``, narrow and cheap to count, with a broadcast hint up to ``limit`` rows; more are shuffled."""
    return F.broadcast(keys) if keys.count() <= limit else keys


def coded(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns named _0, _1 and so on, and these by name: what an operator adds cannot clash with the caller's names."""
    names = {c: f"_{k}" for k, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def decoded(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The caller's columns of a frame that :func:`coded` named."""
    return df.select(*(F.col(own).alias(name) for name, own in names.items()))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a variable.

    Without it, Catalyst may copy an expression into a lambda, which then
    evaluates it once per array element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITESPACE_CLASS + "+"), lambda w: w != "")


# ----------------------------------------------------------- connected classes


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) for every node of ``edges(src, dst)``; the component is its smallest node.

    Randomised contraction: each round every node joins the one of least hash among
    itself and its neighbours, and links are carried over to those. At least a
    quarter of the nodes goes in a round, as expected, and links never grow, so
    rounds are few and each is smaller than the one before; results are written
    to the shared folder. A link of a node with itself is ignored.
    """
    links = materialise(edges.where("src <> dst").select("src", "dst").distinct(), f"{name}-links")
    levels: list[DataFrame] = []
    while True:
        way = lambda a, b: F.struct(F.col(a).alias("node"), F.col(b).alias("near"))
        both = links.select(F.explode(F.array(way("src", "dst"), way("dst", "src"))).alias("e")).select("e.*")
        place = lambda c: F.xxhash64(c, F.lit(len(levels)))
        least = both.groupBy("node").agg(F.min_by("near", place("near")).alias("near"))
        into = F.when(place("near") < place("node"), F.col("near")).otherwise(F.col("node"))
        level = materialise(least.select("node", into.alias("into")), f"{name}-level")
        levels.append(level)
        # a level has one row per node, so these joins give one row per link at most
        ends = links.join(level.select(F.col("node").alias("src"), F.col("into").alias("a")), "src")
        ends = ends.join(level.select(F.col("node").alias("dst"), F.col("into").alias("b")), "dst").where("a <> b")
        links = materialise(ends.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct(), f"{name}-links")
        if links.isEmpty():
            break
    labels = levels.pop()
    while levels:
        ahead = sized(labels.select(F.col("node").alias("into"), F.col("into").alias("root")))
        labels = materialise(levels.pop().join(ahead, "into", "left").select("node", F.coalesce("root", "into").alias("into")), f"{name}-labels")
    smallest = materialise(labels.groupBy("into").agg(F.min("node").alias("component")), f"{name}-smallest")
    return labels.join(sized(smallest), "into").select("node", "component")


# ------------------------------------------------------------- words in numpy


_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(max(n, SLICE_BYTES + 1), np.uint64(base))
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def text_slices(column: pa.ChunkedArray | pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of a string column.

    Null texts count as empty. No text is cut: a long one makes a slice alone.
    """
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.string())
    array = array.fill_null("") if array.null_count else array
    wide = np.int64 if pa.types.is_large_string(array.type) else np.int32
    _, offsets, data = array.buffers()
    if not len(array):
        return
    ends = np.frombuffer(offsets, wide)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(array):
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + limit, side="right")) - 1)
        yield row, stop, raw[ends[row] : ends[stop]], ends[row : stop + 1] - ends[row]
        row = stop


def split_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and of each text its first word's index."""
    inside = ~_SEPARATOR[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < len(raw)]
    first[begins] |= inside[begins]
    closes = offsets[1:][offsets[1:] > 0] - 1
    last[closes] |= inside[closes]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans."""
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and of each text its first run's index.

    A text of fewer words has one run, of all of them; an empty text has none.
    """
    counts = np.diff(first)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(runs)])
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1], runs) + np.repeat(first[:-1], runs)
    length = np.repeat(np.minimum(counts, size), runs)
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        word = words[np.minimum(at + k, len(words) - 1)] if len(words) else total
        total = np.where(k < length, total * np.uint64(_BASE) + word, total)
    return mix(total + length.astype(np.uint64)), bounds
