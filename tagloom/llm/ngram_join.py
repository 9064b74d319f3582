"""N-gram Jaccard self-join by MinHash banding.

Texts are compared as sets of word n-grams. Texts with equal sets collapse to
one node first; nodes that share a band hash become candidates; full sets
decide. No pair of rows is ever a row of a shuffle. A candidate component that
fits into one block is compared in one task. Of a larger one every text is first
compared with a central text: those so near to it that all of them must be similar
to each other are counted, not compared; the others are dealt out in blocks and
compared with all texts. A task returns counts and one spanning link per text.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import coded, connected_components, decoded, gram_hashes, hash_spans, materialise, mix, sized, split_words, text_slices

#: N-grams of a block.
BLOCK_GRAMS = 1 << 22
#: Rounding that a comparison of similarities allows for.
SLACK = 1e-6
SIGNATURE = "doc_id long, text_key long, digest binary, n_grams int, bands array<long>"


def choose_bands(threshold: float, target_recall: float, max_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the most selective banding that meets the recall.

    A pair of similarity s meets in a band of r rows with probability s**r, so
    b bands find it with 1 - (1 - s**r)**b; longer bands give fewer false pairs.
    """
    best = (1, 1)
    for rows in range(1, max_hashes + 1):
        miss = 1 - threshold**rows
        bands = 1 if miss <= 0 else max(1, math.ceil(math.log(1 - target_recall) / math.log(miss)))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def _hash_family(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, count, dtype=np.uint64)


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for row, stop, raw, offsets in text_slices(batch.column("text")):
        starts, ends, first = split_words(raw, offsets)
        yield row, stop, *gram_hashes(hash_spans(raw, starts, ends), first, size)


def _digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, gram: int, bands: int, rows: int, seed: int) -> DataFrame:
    """Digest of the n-gram set and band hashes of every row's text."""
    factor, shift = _hash_family(bands * rows, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, grams, bounds in _sets(batch, gram):
                n = np.diff(bounds)
                some = np.flatnonzero(n)
                keys = np.zeros((len(some), bands), np.uint64)
                if len(some):
                    for band in range(bands):
                        key = np.full(len(some), band, np.uint64)
                        for k in range(band * rows, (band + 1) * rows):
                            low = np.minimum.reduceat((grams ^ shift[k]) * factor[k], bounds[:-1][some])
                            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + low)
                        keys[:, band] = key
                digests: list[bytes | None] = [None] * len(n)
                sizes = np.zeros(len(n), np.int32)
                for i in some:
                    own = np.unique(grams[bounds[i] : bounds[i + 1]])
                    digests[i], sizes[i] = _digest(own), len(own)
                per = np.zeros(len(n) + 1, np.int32)
                per[1:] = np.cumsum(np.where(n > 0, bands, 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, stop - row),
                        batch.column("text_key").slice(row, stop - row),
                        pa.array(digests, pa.binary()),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(per), pa.array(keys.ravel().view(np.int64))),
                    ],
                    ["doc_id", "text_key", "digest", "n_grams", "bands"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key")).mapInArrow(run, SIGNATURE)


def _gram_sets(docs: DataFrame, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, grams, bounds in _sets(batch, gram):
                own = [np.unique(grams[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                per = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)
                flat = np.concatenate(own).view(np.int64) if own else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(x) for x in own], pa.binary()), pa.ListArray.from_arrays(pa.array(per), pa.array(flat))],
                    ["digest", "grams"],
                )

    return docs.select("text").mapInArrow(run, "digest binary, grams array<long>")


def _roots(linked: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Of each row the row of least ``order`` that it is connected with."""
    label = order.copy()
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], len(label)).min(axis=1))
        if (low == label).all():
            return np.argsort(order)[label]
        label = low


def _compare(threshold: float):
    """Compare the texts of one block, or those of one block with another's."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        n = table.num_rows
        digests = table.column("digest").to_pylist()
        part = table.column("part").to_numpy()
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        copies = table.column("copies").to_numpy().astype(np.float64)
        lists = table.column("grams").chunk(0)
        size = np.diff(lists.offsets.to_numpy())
        values = lists.flatten().to_numpy(zero_copy_only=False)
        # sizes of the intersections, from the n-grams that two texts or more have
        which, count = np.unique(values, return_inverse=True, return_counts=True)[1:]
        column = np.cumsum(count > 1) - 1
        kept = count[which] > 1
        row, column = np.repeat(np.arange(n), size)[kept], column[which[kept]]
        both = np.zeros((n, n), np.float32)
        by_column = np.argsort(column, kind="stable")
        row, column = row[by_column], column[by_column]
        step = 4096
        for begin in range(0, int(column[-1]) + 1 if len(column) else 0, step):
            a, b = np.searchsorted(column, [begin, begin + step])
            dense = np.zeros((n, step), np.float32)
            dense[row[a:b], column[a:b] - begin] = 1
            both += dense @ dense.T
        linked = both * (1 + threshold) >= threshold * (size[:, None] + size[None, :]) - SLACK
        np.fill_diagonal(linked, False)
        if low != high:
            linked &= part[:, None] != part[None, :]
        order = np.argsort(np.argsort(np.array(digests, dtype=object)))
        root = _roots(linked, order)
        return pa.table(
            {
                "digest": pa.array(digests, pa.binary()),
                "root": pa.array([digests[i] for i in root], pa.binary()),
                "links": pa.array(linked.sum(axis=1).astype(np.int64)),
                "linked_copies": pa.array((linked @ copies).astype(np.int64)),
                "split": pa.array(np.full(n, table.column("parts")[0].as_py() > 1)),
            }
        )

    return run


def _candidates(nodes: DataFrame) -> DataFrame:
    """(node, component, weight): texts that band hashes connect; the weight adds up the sizes of a text's buckets.

    A text has one link, to the least of the texts that lead its buckets; further
    leaders of its buckets are linked with that one, so a large family of copies
    makes few links beyond one a text.
    """
    members = nodes.select(F.xxhash64("digest").alias("node"), F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("hub")).where("n > 1")
    met = members.join(shared, "band").groupBy("node").agg(F.array_sort(F.collect_set("hub")).alias("hubs"), F.sum("n").alias("weight"))
    met = materialise(met, "join-met")
    link = lambda a, b: F.struct(a.alias("src"), b.alias("dst"))
    least, others = F.element_at("hubs", 1), F.slice("hubs", 2, F.size("hubs"))
    links = F.concat(F.array(link(F.col("node"), least)), F.transform(others, lambda h: link(least, h)))
    components = connected_components(met.select(F.explode(links).alias("e")).select("e.*"), "join-candidates")
    return components.join(met.select("node", "weight"), "node")


def _by_centre(large: DataFrame, threshold: float, block: int) -> tuple[DataFrame, DataFrame]:
    """Counts of the texts near the centre of a large component, and its blocks for the others.

    With t the threshold, texts of sizes a and b are similar if at most
    (a + b)(1 - t) / (1 + t) n-grams are in one of them only. A text of size a is near
    the centre if at most a(1 - t) / (1 + t) are in one of it and the centre only; by the
    triangle inequality any two near texts are similar, so pairs of them need no
    comparison. Every other text is compared with all texts of the component.
    """
    centre = large.groupBy("component").agg(F.max(F.struct("weight", "digest")).alias("c")).select("component", F.col("c.digest").alias("digest"))
    centre = large.select("component", "digest", "grams").join(centre, ["component", "digest"])
    # written, so that Spark knows its size: small ones are broadcast, hot components of large ones split
    centre = materialise(centre.select("component", F.col("digest").alias("centre"), F.col("grams").alias("centre_grams")), "join-centres")
    apart = F.size("grams") + F.size("centre_grams") - 2 * F.size(F.array_intersect("grams", "centre_grams"))
    near = (apart * (1 + threshold) <= F.size("grams") * (1 - threshold)).alias("near")
    told = materialise(large.join(centre, "component").select("component", "digest", "copies", "grams", "centre", near), "join-told")
    sums = told.groupBy("component").agg(
        F.count_if("near").alias("n_near"),
        F.sum(F.when(F.col("near"), F.col("copies"))).alias("near_copies"),
        _parts(F.count_if("near"), F.sum(F.when(F.col("near"), F.size("grams"))), block).alias("near_parts"),
        _parts(F.count_if(~F.col("near")), F.sum(F.when(~F.col("near"), F.size("grams"))), block).alias("far_parts"),
    )
    told = told.join(sized(materialise(sums, "join-sums")), "component")
    counted = told.where("near").select(
        "digest", F.col("centre").alias("root"), (F.col("n_near") - 1).alias("links"), (F.col("near_copies") - F.col("copies")).alias("linked_copies"), F.lit(True).alias("split")
    )
    own = F.when(F.col("near"), F.col("far_parts") + _deal(F.col("near_parts"))).otherwise(_deal(F.col("far_parts")))
    others = F.when(F.col("near"), F.col("far_parts")).otherwise(F.col("far_parts") + F.col("near_parts"))
    blocks = (
        told.where("far_parts > 0")
        .select("component", "digest", "copies", "grams", own.alias("part"), F.lit(2).alias("parts"), F.explode(F.sequence(F.lit(0), others - 1)).alias("other"))
        .withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
        .drop("other")
    )
    return counted, blocks


def _parts(texts: Column, grams: Column, block: int) -> Column:
    """Blocks for so many texts and n-grams."""
    return F.greatest(F.ceil(texts / block), F.ceil(F.coalesce(grams, F.lit(0)) / BLOCK_GRAMS)).cast("int")


def _deal(parts: Column) -> Column:
    return F.pmod(F.xxhash64("digest"), F.greatest(parts, F.lit(1)).cast("long")).cast("int")


def ngram_jaccard_join(
    docs: DataFrame,
    gram: int = 5,
    threshold: float = 0.8,
    target_recall: float = 0.999,
    block: int = 512,
    seed: int = 7,
) -> DataFrame:
    """Classes of documents whose sets of word ``gram``-grams have Jaccard >= ``threshold``.

    Returns one row per input row: ``doc_id``, ``class_id`` (smallest doc_id of
    the class), ``n_links`` (other rows of similarity >= threshold, copies
    counted), ``n_text_links`` (other distinct n-gram sets among them) and
    ``n_grams``.

    Defined cases: a text of 1 to ``gram - 1`` words is one n-gram of all its
    words; a very long text is one set like others, and is compared whole; a null or empty text has no n-gram, links with nothing and is a class
    of its own; rows with a null or a repeated doc_id are rows like others (a
    class of null ids only has a null class_id); further columns are ignored; an
    empty table gives an empty result.

    ``target_recall`` is the least share of pairs at exactly ``threshold`` that
    the banding proposes; of pairs above, more. Every proposed pair is decided
    on the full sets. ``block`` bounds the texts of a block.
    """
    found = _classes(docs, gram, threshold, target_recall, block, seed)
    return found.select("doc_id", "class_id", "n_links", "n_text_links", "n_grams")


def _classes(docs: DataFrame, gram: int, threshold: float, target_recall: float, block: int, seed: int) -> DataFrame:
    """The join's rows with ``text_key`` and ``class``, a key of the class (null without n-grams)."""
    bands, rows = choose_bands(threshold, target_recall)
    signed = materialise(signatures(docs, gram, bands, rows, seed), "join-signatures")
    nodes = (
        signed.where("digest is not null")
        .groupBy("digest")
        .agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id"), F.min("text_key").alias("text_key"), F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands"))
    )
    nodes = materialise(nodes, "join-nodes")
    # 64 bits name a text here: if two share them, sets that do not match are compared, no more
    placed = _candidates(nodes).join(nodes.select(F.xxhash64("digest").alias("node"), "digest", "copies", "text_key", "n_grams"), "node")
    placed = materialise(placed.drop("node"), "join-placed")
    keys = sized(placed.select("text_key").distinct())
    wanted = docs.select("text", F.xxhash64("text").alias("text_key")).join(keys, "text_key", "left_semi")
    sets = _gram_sets(wanted.dropDuplicates(["text_key", "text"]), gram).dropDuplicates(["digest"])
    larger = placed.groupBy("component").agg(_parts(F.count("*"), F.sum("n_grams"), block).alias("parts")).where("parts > 1")
    larger = materialise(larger, "join-larger")
    dealt = placed.drop("text_key", "n_grams").join(sets, "digest").join(sized(larger), "component", "left")
    few = larger.isEmpty()
    dealt = dealt if few else materialise(dealt, "join-sets")
    blocks = dealt.where("parts is null").select("component", "digest", "copies", "grams", F.lit(0).alias("part"), F.lit(1).alias("parts"), F.lit(0).alias("low"), F.lit(0).alias("high"))
    if not few:
        counted, more = _by_centre(dealt.where("parts is not null"), threshold, block)
        blocks = blocks.unionByName(more)
    found = blocks.groupBy("component", "low", "high").applyInArrow(_compare(threshold), "digest binary, root binary, links long, linked_copies long, split boolean")
    found = materialise(found if few else found.unionByName(counted), "join-links")
    counts = found.groupBy("digest").agg(F.sum("links").alias("links"), F.sum("linked_copies").alias("linked_copies"), F.min("root").alias("root"), F.max("split").alias("split"))
    crossing = found.where("split").select(F.col("digest").alias("src"), F.col("root").alias("dst"))
    merged = connected_components(crossing, "join-classes").withColumnRenamed("node", "digest")
    classes = nodes.select("digest", "copies", "first_id").join(counts, "digest", "left").join(merged, "digest", "left")
    classes = classes.withColumn("class", F.when(F.col("split"), F.coalesce("component", "digest")).otherwise(F.coalesce("root", "digest")))
    classes = materialise(classes.drop("component", "root", "split"), "join-counts")
    # a class of one text has its first id; only the others are joined
    named = materialise(classes.groupBy("class").agg(F.min("first_id").alias("class_id"), F.count("*").alias("texts")).where("texts > 1").drop("texts"), "join-named")
    per_set = classes.join(sized(named), "class", "left").select(
        "digest",
        "class",
        F.when(F.col("links") > 0, F.col("class_id")).otherwise(F.col("first_id")).alias("class_id"),
        (F.coalesce("linked_copies", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_text_links"),
    )
    return signed.join(per_set, "digest", "left").select(
        "doc_id",
        "text_key",
        "class",
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_text_links", F.lit(0)).cast("long").alias("n_text_links"),
        "n_grams",
    )


def drop_near_duplicates(docs: DataFrame, gram: int = 5, threshold: float = 0.8, target_recall: float = 0.999, block: int = 512, seed: int = 7) -> DataFrame:
    """Of each class of near duplicates one row stays: that of least doc_id, null last.

    Of several texts of that id, one by a hash of the text; of rows that repeat id and
    text, the first by the other columns as JSON. All columns of ``docs`` are returned,
    whatever their names.

    Defined cases: rows without a word (null and empty texts) stay, all of them;
    rows with a null doc_id are rows like others; very long texts are compared
    whole; an empty table gives an empty result.
    """
    rows = materialise(_classes(docs, gram, threshold, target_recall, block, seed).select("doc_id", "text_key", "class"), "join-decided")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    several = rows.where("class is not null").groupBy("class").agg(F.min(place).alias("first"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    several = materialise(several, "join-first")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    decided = rows.join(sized(several), "class").groupBy("doc_id", "text_key").agg(F.max(stays).alias("stays"), F.count("*").alias("n"))
    decided = materialise(decided.where("not stays or n > 1").select(F.struct("doc_id", "text_key").alias("key"), "stays"), "join-dropped")
    own, names = coded(docs)
    own = own.withColumn("key", F.struct(F.col(names["doc_id"]).cast("long").alias("doc_id"), F.xxhash64(names["text"]).alias("text_key")))
    kept = own.join(sized(decided), "key", "left_anti")
    repeated = decided.where("stays")
    if not repeated.isEmpty():
        others = F.to_json(F.struct(*(c for name, c in names.items() if name not in ("doc_id", "text")), F.lit(0)))
        first = own.join(sized(repeated.select("key")), "key", "left_semi").groupBy("key").agg(F.min_by(F.struct(*names.values()), others).alias("row"))
        kept = kept.unionByName(first.select("row.*", "key"))
    return decoded(kept, names)
