"""Mixing sources to target weights in fixed-length word blocks.

Every source is one stream of words, cut into blocks. The sources' slots are dealt
to the output shards by a pseudorandom permutation, so the counts of a shard are a
multinomial draw given the sources' totals; slots of a source map to its blocks
through a permutation of the source's own, and blocks join texts by index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import WORD_PATTERN, coded, decoded, let, materialise
from tagloom.llm.common import sized as sized_keys

#: Rows of all sources per bucket, and buckets per group, that one window partition adds up.
BUCKET_ROWS = 1_000
GROUP_BUCKETS = 1_000
#: Rounds of the index permutation.
ROUNDS = 12
#: Slots that one task fills.
TASK_SLOTS = 200_000


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.xxhash64("text").alias("text_key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"),
    )


def source_targets(sized: DataFrame, weights: tuple[int, ...], share: float, cap: float, block: int) -> DataFrame:
    """Per source its number, size, target and blocks.

    Targets are ``share`` of all words by weight; none is above ``cap`` times its
    source, whose excess goes to the others by weight: sources in the order of
    cap per weight are at their cap until what is left by weight lies below it.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    number = sums.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = number.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("source_no") % len(weights) + 1).cast("double"))
    weighed = weighed.withColumns({"most": F.col("source_size") * F.lit(float(cap)), "wanted": F.sum("source_size").over(everything) * F.lit(float(share))})
    order = Window.orderBy(F.col("most") / F.col("weight"), "source_no")
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    ahead = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    capped = weighed.withColumn("level", (F.col("wanted") - before) / ahead).withColumn("full", F.col("most") / F.col("weight") <= F.col("level"))
    rest = (F.max("wanted").over(everything) - F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(everything)) / F.sum(
        F.when(~F.col("full"), F.col("weight"))
    ).over(everything)
    return capped.select(
        "source",
        F.col("source").isNull().alias("unnamed"),
        "source_no",
        "source_size",
        F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * rest).alias("target"),
        F.ceil(F.col("source_size") / block).cast("long").alias("n_blocks"),
    )


def _permuted(index: Column, n: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0 .. n-1 (swap-or-not rounds)."""

    def turn(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(*key, r, F.lit("key")), n) - x, n)
        swap = F.pmod(F.xxhash64(*key, r, F.greatest(x, partner)), F.lit(2)) == 1
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index, turn)


def slot_plan(targets: DataFrame, block: int, cap: float, shard_blocks: int, seed: int) -> DataFrame:
    """(out_shard, slot, source_no, block): which block fills each slot.

    A source has the slots that its target asks for. All slots of all sources are
    numbered, and a permutation of the numbers deals them to the shards: the counts
    that a shard draws are multinomial with the sources' totals given, so they vary
    from shard to shard while every source comes to its target.
    """
    everything = Window.partitionBy()
    order = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    # a block is taken at most ``cap`` times
    wanted = F.least(F.round(F.col("target") * F.col("n_blocks") / F.col("source_size")).cast("long"), F.col("n_blocks") * int(cap))
    owned = targets.where("source_size > 0").withColumn("slots", wanted).where("slots > 0")
    owned = owned.withColumns({"base": F.coalesce(F.sum("slots").over(order), F.lit(0)), "all_slots": F.sum("slots").over(everything)})
    owned = materialise(owned.select("source_no", "n_blocks", "slots", "base", "all_slots"), "mix-owned")
    # the table has a row per source, so Spark would fill all slots in one task
    tasks = max(targets.sparkSession.sparkContext.defaultParallelism, -(-(owned.agg(F.max("all_slots")).first()[0] or 0) // TASK_SLOTS))
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / TASK_SLOTS)))
    chunks = owned.withColumn("chunk", chunk).repartition(tasks, "source_no", "chunk")
    first = F.col("chunk") * TASK_SLOTS
    nth = F.explode(F.sequence(first, F.least(first + TASK_SLOTS, F.col("slots")) - 1)).alias("nth")
    turn = F.floor(F.col("nth") / F.col("n_blocks"))
    filled = chunks.select("source_no", "n_blocks", "base", "all_slots", nth).select(
        _permuted(F.col("base") + F.col("nth"), F.col("all_slots"), F.lit(seed)).alias("place"),
        "source_no",
        _permuted(F.col("nth") % F.col("n_blocks"), F.col("n_blocks"), F.lit(seed), F.col("source_no"), turn).alias("block"),
    )
    filled = filled.select(F.floor(F.col("place") / shard_blocks).alias("out_shard"), (F.col("place") % shard_blocks).alias("slot"), "source_no", "block")
    # written, so that joins know its size
    return materialise(filled, "mix-slots")


def _placed(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows with their source's number and their first word's index in its stream.

    Sizes are added up in buckets of rows, buckets in groups, groups in sources, so
    no source passes one task.
    """
    buckets = max(1, -(-sized.count() // BUCKET_ROWS))
    order = F.xxhash64("doc_id", "text_key")
    keyed = sized.withColumn("unnamed", F.col("source").isNull()).withColumn("source", F.coalesce("source", F.lit("")))
    numbers = targets.select(F.coalesce("source", F.lit("")).alias("source"), "unnamed", "source_no", "source_size", "target")
    keyed = keyed.join(sized_keys(numbers), ["source", "unnamed"]).withColumn("bucket", F.pmod(order, F.lit(buckets)))

    def before(partition: list[str], by: list, value: str) -> Column:
        return F.coalesce(F.sum(value).over(Window.partitionBy(*partition).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    sums = keyed.groupBy("source_no", "bucket").agg(F.sum("size").alias("words")).withColumn("group", F.floor(F.col("bucket") / GROUP_BUCKETS))
    sums = materialise(sums, "mix-buckets")
    groups = sums.groupBy("source_no", "group").agg(F.sum("words").alias("words"))
    groups = groups.select("source_no", "group", before(["source_no"], ["group"], "words").alias("group_base"))
    bases = sums.select("source_no", "group", "bucket", before(["source_no", "group"], ["bucket"], "words").alias("base")).join(groups, ["source_no", "group"])
    bases = materialise(bases.select("source_no", "bucket", (F.col("base") + F.col("group_base")).alias("base")), "mix-bases")
    numbered = keyed.withColumn("start", before(["source_no", "bucket"], [order, "doc_id", "text_key"], "size"))
    return numbered.join(bases, ["source_no", "bucket"]).withColumn("start", F.col("start") + F.col("base")).drop("base", "bucket")


def _pieces(placed: DataFrame, block: int) -> DataFrame:
    """The part of each text in each block of its source."""
    end = F.col("start") + F.col("size")
    blocks = F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))
    cut = placed.where("size > 0").withColumn("block", F.explode(blocks))
    first = F.greatest(F.col("block") * block, F.col("start"))
    return cut.withColumn("start_word", first - F.col("start")).withColumn("piece_words", F.least((F.col("block") + 1) * block, end) - first)


def _prepared(docs: DataFrame, weights, share, cap, block) -> tuple[DataFrame, DataFrame]:
    if cap != int(cap) or cap < 1:
        raise ValueError("cap must be a whole number of passes: blocks are taken whole")
    sized = materialise(_sized(docs), "mix-sizes")
    targets = materialise(source_targets(sized, weights, share, cap, block), "mix-targets")
    return materialise(_placed(sized, targets), "mix-placed"), targets


def _spans(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0, block: int = 64, shard_blocks: int = 4096, seed: int = 11) -> DataFrame:
    placed, targets = _prepared(docs, weights, share, cap, block)
    slots = slot_plan(targets, block, cap, shard_blocks, seed)
    return slots.join(_pieces(placed, block), ["source_no", "block"]).select(
        "out_shard", "slot", F.when(~F.col("unnamed"), F.col("source")).alias("source"), "block", "doc_id", "text_key", "start_word", F.col("piece_words").alias("n_words"), "start", "size"
    )


def mix_spans(docs: DataFrame, **options) -> DataFrame:
    """The mix as spans: (out_shard, slot, source, block, doc_id, text_key, start_word, n_words)."""
    return _spans(docs, **options).drop("start", "size")


def taken_words(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0, block: int = 64, shard_blocks: int = 4096, seed: int = 11) -> DataFrame:
    """Per row its size, its source's size and target, and the words the mix takes of it.

    Sources in code point order, null last, weigh ``weights`` in turn. Defined
    cases: a null or empty text has size 0 and is never taken; a very long text is
    many blocks; rows of one doc_id are ordered by a hash of their text; null doc_ids and
    repeated rows are rows like others; rows of a null source are one source;
    other columns are ignored; an empty table gives an empty result. The same
    input and seed give the same result, whatever the partitions.
    """
    placed, targets = _prepared(docs, weights, share, cap, block)
    uses = slot_plan(targets, block, cap, shard_blocks, seed).groupBy("source_no", "block").agg(F.count("*").alias("uses"))
    taken = (
        _pieces(placed, block)
        .select("source_no", "block", "start", "piece_words")
        .join(uses, ["source_no", "block"])
        .groupBy("source_no", "start")
        .agg(F.sum(F.col("piece_words") * F.col("uses")).alias("words"))
    )
    sized = placed.where("size > 0").join(taken, ["source_no", "start"], "left")
    none = placed.where("size = 0").withColumn("words", F.lit(0).cast("long"))
    return sized.unionByName(none).select("doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"))


def _repeated(found: DataFrame, spans: DataFrame, listed: Column, names: dict[str, str]) -> DataFrame:
    """Rows of repeated keys with their spans.

    Rows of a key follow each other in the stream, so the place of a span's row tells
    which of them it is. Equal rows are one with a count until they get their numbers.
    """
    columns = list(names.values())
    whole = F.to_json(F.struct(*(c for name, c in names.items() if name not in ("doc_id", "source", "text")), F.lit(0)))
    kinds = found.withColumn("whole", whole).groupBy("key", "whole").agg(F.count("*").alias("n"))
    order = Window.partitionBy("key").orderBy("whole").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = kinds.withColumn("end", F.sum("n").over(order)).select("key", "whole", F.explode(F.sequence(F.col("end") - F.col("n"), F.col("end") - 1)).alias("copy"))
    firsts = spans.groupBy("key").agg(F.min("start").alias("first"))
    copies = spans.join(firsts, "key").withColumn("copy", F.expr("(start - first) div size")).groupBy("key", "copy").agg(listed)
    rows = found.withColumn("whole", whole).groupBy("key", "whole").agg(F.first(F.struct(*columns)).alias("row"))
    return copies.join(numbered, ["key", "copy"]).join(rows, ["key", "whole"]).select("row.*", "key", "spans")


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed texts with the columns of ``docs``: one row per span that the mix takes.

    ``text`` is the span with its own white space, ``n_chars`` its length; repeated
    passes repeat rows. Rows come by output shard and slot: a partition holds whole
    output shards in order, so files written from it keep the shards' composition.

    Defined cases: those of :func:`taken_words`; texts without a word give no row; of
    rows that repeat doc_id, source and text each gives its own spans, with its own other
    columns, by the order of these as JSON; columns may have any names, and an empty
    table gives an empty result.
    """
    spans = _spans(docs, **options).withColumn("key", F.struct("doc_id", "source", "text_key"))
    own, names = coded(docs)
    text = names["text"]
    found = own.withColumn("key", F.struct(F.col(names["doc_id"]).alias("doc_id"), F.col(names["source"]).cast("string").alias("source"), F.xxhash64(text).alias("text_key")))
    several = materialise(found.groupBy("key").count().where("count > 1").select("key"), "mix-repeated")
    listed = F.collect_list(F.struct("start_word", "n_words", "out_shard", "slot")).alias("spans")
    if several.isEmpty():
        found = found.join(spans.groupBy("key").agg(listed), "key")
    else:
        spans = materialise(spans, "mix-spans")
        several = sized_keys(several)
        once = found.join(several, "key", "left_anti").join(spans.groupBy("key").agg(listed), "key")
        found = once.unionByName(_repeated(found.join(several, "key", "left_semi"), spans.join(several, "key", "left_semi"), listed, names))
    tokens = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    piece = lambda t, s: F.rtrim(F.array_join(F.slice(t, s["start_word"].cast("int") + 1, s["n_words"].cast("int")), ""), F.lit(" \t\n\x0b\x0c\r"))
    cut = let(tokens, lambda t: F.transform("spans", lambda s: F.struct(s["out_shard"].alias("out_shard"), s["slot"].alias("slot"), piece(t, s).alias("text"))))
    texts = found.withColumn("piece", F.explode(cut))
    changed = {text: F.col("piece.text")} | ({names["n_chars"]: F.length("piece.text").cast("long")} if "n_chars" in names else {})
    texts = texts.withColumns({"out_shard": F.col("piece.out_shard"), "slot": F.col("piece.slot")} | changed).drop("piece", "spans", "key")
    return decoded(texts.repartition("out_shard").sortWithinPartitions("out_shard", "slot"), names)
