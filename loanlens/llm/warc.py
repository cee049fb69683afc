"""WARC archives of web pages, their normalisation, and reading them back through an index.

Spark's text writer puts the records into archives, each one monolithic gzip stream. The normaliser
inflates such a stream once, front to back, and writes every record as its own gzip member into a new
archive, with a sidecar index of (record id, archive, offset, length). The reader takes index rows,
seeks to each member and inflates that member alone.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanlens.llm.common import Scratch

REVISIT_BYTES = 100            # smallest payload that a revisit may refer to
ARCHIVE_ROWS = 5_000           # records of one archive at most
_PIECE = 1 << 20
_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_types(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, size, digest, refers_to): refers_to is the response's id for revisits, else null."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumns(
        {"size": F.octet_length("html").cast("long"), "digest": F.sha2("html", 256)})
    # only repeated payloads travel: one row per digest after the map-side minimum
    first = (rows.filter(F.col("size") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select("digest", "first"))
    later = (rows.filter(F.col("size") >= least).select("page_id", "digest").join(first, "digest")
             .filter("page_id <> first").select(F.col("page_id").alias("again"), F.col("digest").alias("d"), F.col("first").alias("refers_to")).distinct())
    return rows.join(later, F.expr("page_id = again and digest = d"), "left").select(
        "page_id", "url", "html", "size", "digest", "refers_to")


def write_archives(typed: DataFrame, path: str) -> None:
    """Write one WARC record per row; each output file is a single gzip stream of at most ``ARCHIVE_ROWS`` records.

    The text writer's line end completes the blank lines that close a record.
    """
    revisit = F.col("refers_to").isNotNull()
    uri = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), uri(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ")),
        F.lit(f"WARC-Date: {_DATE}"), F.concat(F.lit("WARC-Payload-Digest: sha-256:"), F.col("digest")),
        F.concat(F.lit("WARC-Payload-Length: "), F.col("size").cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), uri(F.col("refers_to")), F.lit(f"\r\nWARC-Profile: {PROFILE}"))),
        F.lit("Content-Type: application/http; msgtype=response"), F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")))
    typed.select(F.concat(head, F.lit("\r\n\r\n"), body, F.lit("\r\n\r")).alias("value")).write.option("compression", "gzip").option(
        "lineSep", "\n").option("maxRecordsPerFile", ARCHIVE_ROWS).text(path)


def split_records(stream: Iterator[bytes]) -> Iterator[bytes]:
    """Whole WARC records of an inflated stream, by their Content-Length."""
    held = bytearray()
    for piece in stream:
        held += piece
        start = 0
        while (cut := held.find(b"\r\n\r\n", start)) >= 0:
            length = re.search(rb"\r\nContent-Length: (\d+)", held[start:cut])
            end = cut + 4 + int(length[1]) + 4
            if end > len(held):
                break
            yield bytes(held[start:end])
            start = end
        del held[:start]
    if held:
        raise ValueError(f"{len(held)} bytes after the last whole record")


def inflate(raw) -> Iterator[bytes]:
    """Pieces of a gzip stream (one member or several), inflated front to back in bounded steps."""
    view, inflater = memoryview(raw), zlib.decompressobj(31)
    at = 0
    while at < len(view) or inflater.unconsumed_tail:
        data = inflater.unconsumed_tail or view[at:at + _PIECE]
        if not inflater.unconsumed_tail:
            at += len(data)
        yield inflater.decompress(data, _PIECE)
        if inflater.eof:
            at -= len(inflater.unused_data)
            inflater = zlib.decompressobj(31)


def deflate(record: bytes) -> bytes:
    """One gzip member."""
    c = zlib.compressobj(4, zlib.DEFLATED, 31)
    return c.compress(record) + c.flush()


def normalise(spark: SparkSession, archives: str, out: str) -> DataFrame:
    """Rewrite every archive below ``archives`` into ``out``, one gzip member per record.

    Returns the sidecar index (archive, record_id, offset, length). An archive is written under the
    attempt's own name and then renamed, so a retried or doubled task leaves one whole file.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(archives).select("path", "content")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        fs, folder = pafs.FileSystem.from_uri(out)
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                name = path.rsplit("/", 1)[1].replace(".txt.gz", ".gz").replace(".gz", ".warc.gz")
                target, own = f"{folder}/{name}", f"{folder}/_{name}.{TaskContext.get().taskAttemptId()}"
                ids, offsets, lengths, at = [], [], [], 0
                with fs.open_output_stream(own, compression=None) as sink:
                    for record in split_records(inflate(content.as_buffer())):
                        member = deflate(record)
                        ids.append(re.search(rb"\r\nWARC-Record-ID: (\S+)", record)[1].decode())
                        offsets.append(at)
                        lengths.append(len(member))
                        sink.write(member)
                        at += len(member)
                fs.move(own, target)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{out}/{name}"] * len(ids)), pa.array(ids, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    ["archive", "record_id", "offset", "length"])

    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    return files.mapInArrow(rewrite, "archive string, record_id string, offset long, length long")


_READ = ("page_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, intact boolean")


def read_records(index: DataFrame) -> DataFrame:
    """The records that index rows point to; each member is read and inflated by itself.

    ``intact`` says that a response's payload has the length and digest its header states.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = (None, None)
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                if opened[0] != archive:
                    fs, path = pafs.FileSystem.from_uri(archive)
                    opened = archive, fs.open_input_file(path)
                opened[1].seek(offset)
                record = zlib.decompress(opened[1].read(length), 31)
                head, _, payload = record.split(b"\r\n\r\n", 2)
                field = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
                payload = payload[:-4]
                size, digest = int(field["WARC-Payload-Length"]), field["WARC-Payload-Digest"].removeprefix("sha-256:")
                revisit = field["WARC-Type"] == "revisit"
                name = lambda v: v.removeprefix("<urn:page:").removesuffix(">")
                rows.append((name(field["WARC-Record-ID"]), field["WARC-Target-URI"], "revisit" if revisit else "response", size, digest,
                             name(field["WARC-Refers-To"]) if revisit else None,
                             revisit or (len(payload) == size and hashlib.sha256(payload).hexdigest() == digest)))
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                             ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "intact"])

    # the index keeps an archive's rows together and in order, so archives are read front to back
    return index.select("archive", "offset", "length").mapInArrow(read, _READ)


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one WARC record per row, normalise the archives, and return what reading them back gives.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to, intact. Of rows with equal
    payloads of at least ``REVISIT_BYTES`` bytes the one with the smallest id is the response and others are
    revisits of it; rows that repeat that id with that payload are responses too. A null html is an empty
    payload. A row with a null id is always a response and comes back with a null id. Other columns are
    ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    kind = dict(pages.dtypes)[id_col]
    plain = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    raw = scratch.path("archives")
    write_archives(record_types(plain), raw)
    index = scratch.save(normalise(spark, raw, scratch.path("members")), "index")
    back = read_records(index).select(
        F.expr(f"if(page_id = 'null', null, cast(page_id as {kind}))").alias(id_col), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "intact")
    return scratch.result(back)


def op7_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


OP7_SQL = """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as n, sha256(coalesce(html, '')) as d from pages),
f as (select *, min(page_id) over (partition by d) as first from p)
select page_id, cast(n as bigint) as payload_bytes, d as payload_digest,
       case when n >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
       case when n >= 100 and page_id <> first then first end as refers_to, true as intact
from f"""
