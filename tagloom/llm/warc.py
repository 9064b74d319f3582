"""WARC archives: write, index, and read selected records by byte range.

Archives are plain WARC/1.1 files. The index holds offset, length, URL and digest
of every record; a read sorts the wanted records by file and offset, joins
neighbouring ranges and fetches each range once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import materialise

#: Ranges closer than this are fetched together, up to the second bound.
GAP_BYTES = 64 << 10
RANGE_BYTES = 4 << 20
CHUNK = 1 << 20

INDEX = "file string, offset long, length long, header_bytes int, record_type string, record_id string, refers_to string, url string, digest string, payload_bytes long"


def _open(uri: str):
    """A random-access file in whatever store the URI names."""
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[len("file:") :]
    store, path = pafs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


# -------------------------------------------------------------------- writing


def plan_records(pages: DataFrame, min_revisit_bytes: int = 1000) -> DataFrame:
    """Pages with payload, digest, record type and the page a revisit refers to.

    Of pages with equal payloads of ``min_revisit_bytes`` or more, that with the
    largest page_id is the response; all shorter payloads are responses.
    """
    own = pages.select("page_id", "url", F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"))
    own = own.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    long = own.where(F.col("payload_bytes") >= min_revisit_bytes)
    groups = long.groupBy("digest", "payload_bytes").agg(F.max("page_id").alias("response_id"), F.count("*").alias("n")).where("n > 1 and response_id is not null")
    # written first: of a table whose size it knows, Spark broadcasts a small one and shuffles a large one
    groups = materialise(groups, "warc-groups")
    joined = own.join(groups.drop("n"), ["digest", "payload_bytes"], "left")
    revisit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("response_id")).alias("refers_to")
    )


def _line(name: str, value: Column) -> Column:
    """One header line; none for a null. Line ends cannot occur inside a value."""
    clean = F.regexp_replace(value.cast("string"), r"[\r\n]", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def write_warc(records: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """One archive per partition of ``records`` (see :func:`plan_records`).

    A record is a line of Spark's text writer, whose separator is the blank lines
    that end a WARC record, so its commit protocol covers lost executors.
    """
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", urn(F.coalesce(F.col("page_id").cast("string"), F.lit("")))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Refers-To", F.when(revisit, urn(F.col("refers_to")))),
        _line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, 0).otherwise(F.col("payload_bytes"))),
        F.lit("\r\n"),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    records.select(F.concat(header, body).alias("value")).write.option("lineSep", "\r\n\r\n").text(path)


# ------------------------------------------------------------------- indexing


def _fields(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8", "replace").split("\r\n")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k}


def _scan(file: str) -> Iterator[tuple]:
    """The records of one archive in order; bodies are skipped, not kept."""
    with _open(file) as source:
        size, offset = source.size(), 0
        while offset < size:
            source.seek(offset)
            head = b""
            while b"\r\n\r\n" not in head:
                more = source.read(4096)
                if not more:
                    raise ValueError(f"{file}: no header ends after byte {offset}")
                head += more
            head = head[: head.index(b"\r\n\r\n") + 4]
            if not head.startswith(b"WARC/"):
                raise ValueError(f"{file}: no record at byte {offset}")
            f = _fields(head)
            body = int(f["content-length"])
            plain = lambda x: x.removeprefix("<urn:page:").removesuffix(">") or None if x is not None else None
            yield (
                file, offset, len(head) + body, len(head), f["warc-type"], plain(f.get("warc-record-id")), plain(f.get("warc-refers-to")),
                f.get("warc-target-uri"), (f.get("warc-payload-digest") or "").removeprefix("sha1:") or None, body,
            )
            offset += len(head) + body + 4


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


_INDEX_ARROW = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("header_bytes", pa.int32()), ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("url", pa.string()), ("digest", pa.string()), ("payload_bytes", pa.int64())]
)


def index_warc(spark: SparkSession, path: str) -> DataFrame:
    """Offset, length, URL and digest of every record of the archives in ``path``."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("path").to_pylist():
                rows: list[tuple] = []
                for row in _scan(file):
                    rows.append(row)
                    if len(rows) == 4096:
                        yield _table(rows, _INDEX_ARROW)
                        rows = []
                if rows:
                    yield _table(rows, _INDEX_ARROW)

    return files.select("path").repartition(spark.sparkContext.defaultParallelism * 2, "path").mapInArrow(run, INDEX)


# -------------------------------------------------------------------- reading


_READ_ARROW = pa.schema([("record_id", pa.string()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _ranges(rows: list[dict]) -> Iterator[list[dict]]:
    """Runs of neighbouring records that one read fetches."""
    run: list[dict] = []
    for row in rows:
        if run and (
            row["file"] != run[0]["file"] or row["offset"] - (run[-1]["offset"] + run[-1]["length"]) > GAP_BYTES or row["offset"] + row["length"] - run[0]["offset"] > RANGE_BYTES
        ):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def read_records(selected: DataFrame, keep_payload: bool = True) -> DataFrame:
    """Payloads of the index rows in ``selected``, with size and SHA-1 as read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            for group in _ranges(batch.to_pylist()):
                if group[0]["file"] != name:
                    if source is not None:
                        source.close()
                    name, source = group[0]["file"], _open(group[0]["file"])
                begin = group[0]["offset"]
                data = source.read_at(group[-1]["offset"] + group[-1]["length"] - begin, begin)
                out = []
                for r in group:
                    at = r["offset"] - begin
                    body = data[at + r["header_bytes"] : at + r["length"]]
                    out.append((r["record_id"], hashlib.sha1(body).hexdigest(), len(body), body if keep_payload else None))
                yield _table(out, _READ_ARROW)
        if source is not None:
            source.close()

    wanted = selected.select("file", "offset", "length", "header_bytes", "record_id")
    dealt = wanted.repartitionByRange(wanted.sparkSession.sparkContext.defaultParallelism * 2, "file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(run, "record_id string, digest string, payload_bytes long, payload binary")


def archive_pages(pages: DataFrame, path: str, min_revisit_bytes: int = 1000) -> DataFrame:
    """Write ``pages`` to WARC archives under ``path`` and read every record back.

    Returns per page ``page_id``, ``payload_bytes`` and ``payload_digest`` of the full
    payload, ``record_type`` and ``refers_to``. A response's size and digest are
    those of the bytes read; a revisit's those of the response it refers to.

    Defined cases: a null html is an empty payload; a null url has no target line;
    line ends in a url become blanks; pages of one page_id and equal payloads are
    all responses; pages without a page_id refer to the response of their payload
    if one has an id, and come back with a null page_id; other columns are ignored;
    an empty table gives an empty result.
    """
    spark = pages.sparkSession
    write_warc(plan_records(pages, min_revisit_bytes), f"{path}/archive")
    index_warc(spark, f"{path}/archive").write.parquet(f"{path}/index")
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    # a page without an id has no key to be found by: its line of the index is
    placed = index.withColumn("key", F.concat_ws(":", "file", "offset"))
    read = read_records(placed.where("record_type = 'response'").withColumn("record_id", F.col("key")), keep_payload=False)
    full = placed.where("record_type = 'response'").select("key", "record_id").join(read.withColumnRenamed("record_id", "key"), "key")
    responses = full.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    targets = full.where("record_id is not null").groupBy(F.col("record_id").alias("refers_to"), F.col("digest")).agg(F.max("payload_bytes").alias("read_bytes"))
    revisits = (
        placed.where("record_type = 'revisit'")
        .join(targets, ["refers_to", "digest"], "left")
        .select(F.col("record_id").cast("long").alias("page_id"), F.col("read_bytes").alias("payload_bytes"), F.when(F.col("read_bytes").isNotNull(), F.col("digest")).alias("payload_digest"), "record_type", F.col("refers_to").cast("long").alias("refers_to"))
    )
    return responses.unionByName(revisits)
