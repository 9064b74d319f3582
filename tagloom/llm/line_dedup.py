"""Line deduplication by a segment-partition edit join.

Equal lines collapse first. A line of length l with threshold t is cut into t + 1
segments: a line within t edits holds one of them, unchanged and at most t places
off. Segments go into an index by (length, number, segment); a line probes it with
its substrings at the places that can matter. Pairs that meet are decided by
edit distance, inside blocks of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import coded, connected_components, decoded, let, scratch_path, sized


def threshold(length: Column, max_edits: int, min_segment: int) -> Column:
    """Edits allowed for a line: segments have at least ``min_segment`` characters."""
    return F.greatest(F.lit(0), F.least(F.lit(max_edits), F.floor(length / min_segment).cast("int") - 1))


def _cases(max_edits: int, gaps: range, shifts: bool) -> Column:
    """(gap, edits, number, shift): which segment of a line ``gap`` shorter may stand where.

    Edits before a segment and after it both bound how far it can have moved.
    """
    cases = []
    for gap in gaps:
        for edits in range(max(1, gap), max_edits + 1):
            for i in range(1, edits + 2):
                low, high = max(1 - i, gap - (edits + 1 - i)), min(i - 1, gap + (edits + 1 - i))
                cases += [(gap, edits, i, shift) for shift in (range(low, high + 1) if shifts else (0,))]
    return F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(("gap", "edits", "number", "shift"), c, strict=True)]) for c in cases])


def _keys(lines: DataFrame, cases: Column, max_edits: int, min_segment: int) -> DataFrame:
    """(key, line_key) of the substrings of ``lines`` in the cases that apply.

    One short expression per row compiles well; all cases in one expression make
    a method too long for the JVM to compile.
    """
    rows = lines.select("*", F.explode(cases).alias("c")).select("line", "length", "line_key", "c.*")
    length, edits, number = F.col("length") - F.col("gap"), F.col("edits"), F.col("number")
    rows = rows.where(threshold(length, max_edits, min_segment) == edits)
    base = F.floor(length / (edits + 1)).cast("int")
    short = edits + 1 - F.pmod(length, edits + 1)  # so many segments are one shorter
    start = (base * (number - 1) + F.greatest(F.lit(0), number - 1 - short) + 1 + F.col("shift")).cast("int")
    size = base + F.when(short < number, 1).otherwise(0)
    return rows.select(F.xxhash64(length, number, F.substring("line", start, size)).alias("key"), "line_key")


def index_keys(lines: DataFrame, max_edits: int, min_segment: int) -> DataFrame:
    """Keys of the lines' own segments."""
    return _keys(lines, _cases(max_edits, range(1), False), max_edits, min_segment)


def probe_keys(lines: DataFrame, max_edits: int, min_segment: int) -> DataFrame:
    """Keys of the substrings that lines at most as long may have as segments."""
    return _keys(lines, _cases(max_edits, range(max_edits + 1), True), max_edits, min_segment)


def _spanning_links(members: Column, max_edits: int, min_segment: int) -> Column:
    """(digest, root) of a block's lines that are linked, by their component in the block."""

    def links(m: Column) -> Column:
        def near(x: Column, y: Column) -> Column:
            allowed = threshold(F.least(x["length"], y["length"]), max_edits, min_segment)
            roles = (x["indexed"] & y["probing"]) | (y["indexed"] & x["probing"])
            apart = (x["low"] == x["high"]) | (x["part"] != y["part"])
            distance = F.levenshtein(x["line"], y["line"], max_edits)
            return roles & apart & (F.abs(x["length"] - y["length"]) <= allowed) & F.when(roles & apart, (distance >= 0) & (distance <= allowed))

        def later(x: Column, i: Column) -> Column:
            tail = F.slice(m, i + 2, F.size(m))
            found = F.filter(F.transform(tail, lambda y, j: F.struct(i.alias("a"), (i + 1 + j).alias("b"), near(x, y).alias("linked"))), lambda e: e["linked"])
            return F.when(i + 1 < F.size(m), found).otherwise(F.array().cast("array<struct<a:int,b:int,linked:boolean>>"))

        pairs = F.flatten(F.transform(m, later))

        def union(label: Column, e: Column) -> Column:
            a, b = F.element_at(label, e["a"] + 1), F.element_at(label, e["b"] + 1)
            return F.transform(label, lambda x: F.when(x == F.greatest(a, b), F.least(a, b)).otherwise(x))

        labels = F.aggregate(pairs, F.sequence(F.lit(0), F.size(m) - 1), union)
        roots = let(labels, lambda known: F.transform(m, lambda x, i: F.struct(x["digest"].alias("src"), F.element_at(m, F.element_at(known, i + 1) + 1)["digest"].alias("dst"))))
        return F.filter(roots, lambda e: e["src"] != e["dst"])

    return let(members, links)


def _write(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _lines(docs: DataFrame) -> DataFrame:
    split = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return split.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).withColumn("digest", F.unhex(F.md5("line")))


def line_classes(docs: DataFrame, max_edits: int = 2, min_segment: int = 12, block: int = 48) -> DataFrame:
    """Classes of equal and nearly equal lines: one row per line that has a word.

    Two lines are linked if they are equal or within t edits of characters, where
    t is ``max_edits``, or fewer if the shorter line has no t + 1 segments of
    ``min_segment`` characters. Classes are the connected lines. Returns doc_id,
    text_key (xxhash64 of the text), line_no (from 0), n_copies (equal lines),
    class_doc, class_line (the first line of the class by doc_id, text_key, line
    number) and kept (true for that line).

    Defined cases: null and empty texts and blank lines give no row; lines of any
    length count whole; null doc_ids come last in order; of repeated rows all first lines are kept; other columns
    are ignored; an empty table gives an empty result. ``block`` bounds how many
    lines of one key are compared in one row of a plan.
    """
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key", "line_no")
    distinct = _lines(docs).groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n_copies"), F.first("line").alias("line")).withColumn("length", F.length("line"))
    # rows of a task are numbered in turn and the table is written: its few changing bytes compress where a hash does not
    distinct = _write(distinct.withColumn("line_key", F.monotonically_increasing_id()), "lines")
    long = distinct.where(F.col("length") >= 2 * min_segment).select("line", "length", "line_key")
    index, probes = index_keys(long, max_edits, min_segment), probe_keys(long, max_edits, min_segment)
    known = index.groupBy("key").agg(F.count("*").alias("n"), F.min("line_key").alias("only"))
    probing = _write(probes.join(known, "key").where("n > 1 or only <> line_key").select("key", "line_key"), "line-probes")
    indexed = index.join(probing.select("key").distinct(), "key", "left_semi")
    members = probing.withColumns({"indexed": F.lit(False), "probing": F.lit(True)}).unionByName(indexed.withColumns({"indexed": F.lit(True), "probing": F.lit(False)}))
    members = _write(members.groupBy("key", "line_key").agg(F.max("indexed").alias("indexed"), F.max("probing").alias("probing")), "line-members")
    parts = members.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    texts = distinct.select("line_key", "digest", "line", "length").join(sized(members.select("line_key").distinct()), "line_key", "left_semi")
    dealt = (
        members.join(parts, "key")
        .withColumn("part", F.pmod(F.xxhash64("line_key", F.lit(1)), F.col("parts").cast("long")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
        .join(texts, "line_key")
    )
    member = F.struct("digest", "line", "length", "indexed", "probing", "part", "low", "high")
    blocks = dealt.groupBy("key", "low", "high").agg(F.collect_list(member).alias("members")).where(F.size("members") > 1)
    links = blocks.select(F.explode(_spanning_links(F.col("members"), max_edits, min_segment)).alias("link")).select("link.*").distinct()
    near = connected_components(links, "line-classes").withColumnRenamed("node", "digest")
    # lines without a near one have no component: they stay out of joins by it, where they would meet in one task
    firsts = near.join(distinct.select("digest", "first"), "digest")
    merged = near.join(firsts.groupBy("component").agg(F.min("first").alias("class_first")), "component").select("digest", "class_first")
    named = distinct.select("digest", "first", "n_copies").join(merged, "digest", "left").select("digest", "n_copies", F.coalesce("class_first", "first").alias("of"))
    # written, so that both sides of the next join come from shuffles and a common line's rows can be split
    named = _write(named, "line-named")
    whole = _lines(docs).select("doc_id", "text_key", "line_no", "digest").join(named, "digest")
    kept = F.col("doc_id").eqNullSafe(F.col("of.doc_id")) & F.col("text_key").eqNullSafe(F.col("of.text_key")) & (F.col("line_no") == F.col("of.line_no"))
    return whole.select("doc_id", "text_key", "line_no", "n_copies", F.col("of.doc_id").alias("class_doc"), F.col("of.line_no").alias("class_line"), kept.alias("kept"))


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with texts from which all but the first line of each class are gone.

    Defined cases: blank lines stay; a text of which no line is left becomes empty;
    null and empty texts stay as they are; of repeated rows each keeps the first
    lines; columns may have any names; an empty table gives an empty result.
    """
    gone = line_classes(docs, **options).where("not kept").groupBy(F.struct("doc_id", "text_key").alias("key")).agg(F.collect_set("line_no").alias("gone"))
    own, names = coded(docs)
    text = names["text"]
    found = own.withColumn("key", F.struct(F.col(names["doc_id"]).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"))).join(gone, "key", "left")
    left = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains("gone", i)), "\n")
    return decoded(found.withColumn(text, F.when(F.col("gone").isNull(), F.col(text)).otherwise(left)), names)
