"""WARC archives with revisit resolution.

Only headers are shuffled by payload digest: one aggregation finds the
original of every payload that comes more than once, and the copies' headers
are joined to it.  The payloads move once, to meet these decisions by page,
and are written with fresh headers: a ``response`` record with the payload,
or a ``revisit`` record that refers to the response and has none.

An archive is a ``.warc.gz`` file with one gzip member a record, so that records
can be read by offset: a ``warcinfo`` record, the pages' records, and a closing
``metadata`` record with their number.  Tasks compress and pack records by bytes;
Spark's committed text writer puts each packed archive into a file of its own, so
a lost task leaves no broken archive.  A gzip member ends with its length in four
bytes, little end first, and the closing record is short: the archive's last byte
is zero, and the writer adds it as the line's end.  Archives are read back record
by record, by Content-Length, and checked against their closing record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import read, stage

ARCHIVE_BYTES = 32 << 20  # an archive is closed when its members pass this; a task holds one archive at a time
READ_BYTES = 16 << 20  # payloads handed on at a time when they are read back
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


def base32_sha1(binary: Column) -> Column:
    """Upper-case base32 of the SHA-1, from the hex digest five digits (four letters) at a time."""
    h = F.sha1(binary)
    parts = [F.lpad(F.conv(F.substring(h, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]),
                    F.lit(">"))


def resolve(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int) -> DataFrame:
    """``(page_id, url, payload, digest, bytes, nth, original, original_url, is_revisit)`` of every page."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    binary = F.col("payload").cast("binary")
    # page: the id as text, never null, so that the join's partitioning serves the window over the same keys
    rows = rows.withColumns({"digest": base32_sha1(binary), "bytes": F.octet_length(binary).cast("long"),
                             "page": F.coalesce(F.col("page_id").cast("string"), F.lit("-"))})
    heads = stage(rows.where(F.col("bytes") >= min_bytes).select("page_id", "page", "url", "digest"), "warc_headers")
    groups = heads.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "url")).alias("first"))
    copies = (heads.select("digest", "page").distinct().join(groups.where("n > 1"), "digest")
              .select(F.col("digest").alias("g_digest"), F.col("page").alias("g_page"),
                      F.col("first.page_id").alias("original"), F.col("first.url").alias("original_url"), F.lit(True).alias("grouped")))
    same = (F.col("digest") == F.col("g_digest")) & (F.col("page") == F.col("g_page"))
    out = rows.join(stage(copies, "warc_copies").hint("merge"), same, "left").drop("g_digest", "g_page")
    # rows that repeat a page and its payload: the largest url first
    nth = F.row_number().over(Window.partitionBy("digest", "page").orderBy(F.col("url").desc_nulls_last()))
    out = out.withColumn("nth", nth)
    first = F.col("page_id").eqNullSafe(F.col("original")) & (F.col("nth") == 1)
    return out.withColumn("is_revisit", F.coalesce("grouped", F.lit(False)) & ~first).drop("grouped")


def record(date: str) -> Column:
    """The whole record."""
    def line(name, value):
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), F.regexp_replace(value, "[\r\n]+", " "), F.lit(CRLF))).otherwise("")

    revisit, size = F.col("is_revisit"), F.col("bytes").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size, F.lit(CRLF * 2))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col("page_id"), F.col("digest"), F.col("nth"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Page-ID", F.col("page_id").cast("string")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
        line("WARC-Refers-To", F.when(revisit, record_id(F.col("original"), F.col("digest"), F.lit(1)))),
        line("WARC-Refers-To-Target-URI", F.when(revisit, F.col("original_url"))),
        line("WARC-Refers-To-Date", F.when(revisit, F.lit(date))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF), block, F.lit(CRLF * 2))


def note(kind: str, ident: str, date: str, fields: dict, **head: str) -> bytes:
    """A ``warcinfo`` or ``metadata`` record."""
    block = "".join(f"{k}: {v}{CRLF}" for k, v in fields.items())
    lines = {"WARC-Type": kind, "WARC-Record-ID": ident, "WARC-Date": date, **head,
             "Content-Type": "application/warc-fields", "Content-Length": len(block.encode())}
    return "".join([f"WARC/1.1{CRLF}", *(f"{k}: {v}{CRLF}" for k, v in lines.items()), CRLF, block, CRLF * 2]).encode()


def close_archive(members: list[bytes], date: str) -> bytes:
    """The archive of these members without its last byte, which is zero."""
    digest = hashlib.md5(b"".join(hashlib.md5(m).digest() for m in members)).digest()
    info, last = (f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(digest + name).digest())}>" for name in (b"warcinfo", b"metadata"))
    first = note("warcinfo", info, date, {"software": "textlab", "format": "WARC File Format 1.1"})
    end = note("metadata", last, date, {"records": len(members)}, **{"WARC-Refers-To": info})
    out = b"".join([gzip.compress(first, mtime=0), *members, gzip.compress(end, mtime=0)])
    assert out[-1] == 0
    return out[:-1]


def packer(date: str, archive_bytes: int):
    """Compresses each record to a gzip member; rows are archives of about ``archive_bytes``, or of one longer record."""
    def run(batches):
        members, size = [], 0
        for b in batches:
            for value in b.column(0):
                members.append(gzip.compress(value.as_buffer(), compresslevel=6, mtime=0))
                size += len(members[-1])
                if size >= archive_bytes:
                    archive, members, size = close_archive(members, date), [], 0
                    yield pa.RecordBatch.from_arrays([pa.array([archive], pa.binary())], names=["archive"])
        if members:
            yield pa.RecordBatch.from_arrays([pa.array([close_archive(members, date)], pa.binary())], names=["archive"])

    return run


def name_archives(spark: SparkSession, path: str) -> None:
    """Give written archives their ``.warc.gz`` names: one rename a file; may be run again."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.listStatus(folder):
        name = f.getPath().getName()
        if name.endswith(".txt"):
            fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(folder, name.removesuffix(".txt") + ".warc.gz"))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_bytes: int = 0, date: str = DATE, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write one record a row as ``.warc.gz`` archives of about ``archive_bytes`` under ``path``, a member a record.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with the
    largest page id is the response (of rows that repeat id and payload, the one with the largest
    url); the others revisit it.  Null payloads are empty; null ids are smaller than all ids and get no
    WARC-Page-ID line; null urls get no target line.  An empty table writes an empty
    file.  A record has the 2 GB of one Spark value at most.  Other columns are not read.
    """
    out = resolve(pages, id_col, url_col, payload_col, min_bytes)
    archives = out.select(record(date).cast("binary").alias("record")).mapInArrow(packer(date, archive_bytes), "archive binary")
    (archives.select(F.col("archive").cast("string").alias("value")).write
     .options(lineSep="\0", compression="none", maxRecordsPerFile=1).text(path))
    name_archives(pages.sparkSession, path)


def records(stream):
    """``(headers, block)`` of each record of a binary stream; names are lower-cased, lengths are checked."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        head = {}
        while (line := stream.readline()).strip():
            name, _, value = line.partition(b":")
            head[name.strip().lower().decode()] = value.strip().decode()
        size = int(head["content-length"])
        block = stream.read(size)
        if len(block) < size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {head.get('warc-record-id')} is cut off")
        yield head, block


READ = ("record_id string, record_type string, page_id long, url string, refers_to_id string, "
        "digest string, payload_bytes long, payload binary")


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row for each record of the archives in ``path``, gzip or plain; a response's digest is taken from its payload.

    Notes (``warcinfo`` and ``metadata``) give no row; a number of records in the last of them must be that of the archive.
    """
    def run(batches):
        for b in batches:
            for content in b.column(0):
                raw = content.as_buffer()
                stream = io.BufferedReader(pa.BufferReader(raw))
                if raw.size > 1 and raw[:2].to_pybytes() == b"\x1f\x8b":
                    stream = gzip.GzipFile(fileobj=stream)
                rows, held, n = [], 0, 0
                for head, block in records(stream):
                    body, kind = block.partition(b"\r\n\r\n")[2], head["warc-type"]
                    if kind in ("warcinfo", "metadata"):
                        told = block.removeprefix(b"records:").strip()
                        if block.startswith(b"records:") and int(told) != n:
                            raise ValueError(f"the archive tells of {int(told)} records and holds {n}")
                        continue
                    full = kind == "response"
                    digest = base64.b32encode(hashlib.sha1(body).digest()).decode() if full else \
                        head.get("warc-payload-digest", "").removeprefix("sha1:")
                    page = head.get("warc-page-id")
                    rows.append((head["warc-record-id"], kind, int(page) if page else None, head.get("warc-target-uri"),
                                 head.get("warc-refers-to"), digest, len(body) if full else None, body if full and payloads else None))
                    n, held = n + 1, held + (len(body) if payloads else 0)
                    if len(rows) == 1000 or held >= READ_BYTES:
                        yield table(rows)
                        rows, held = [], 0
                if rows:
                    yield table(rows)

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    names = [c.split()[0] for c in READ.split(", ")]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    files = spark.read.format("binaryFile").load(path)
    return files.select("content").mapInArrow(run, READ)


def resolved(archive: DataFrame) -> DataFrame:
    """Revisit records with the size and page of the response that they refer to; responses as they are."""
    a = archive.drop("payload")
    full = a.where("record_type = 'response'")
    seen = full.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full_bytes"),
                       F.col("digest").alias("full_digest"))
    again = a.where("record_type = 'revisit'").join(seen.hint("merge"), "refers_to_id")
    again = again.select("page_id", "url", F.col("full_bytes").alias("payload_bytes"), F.col("full_digest").alias("payload_digest"),
                         "record_type", "refers_to")
    return full.select("page_id", "url", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type",
                       F.lit(None).cast("long").alias("refers_to")).unionByName(again)


def op3_warc(spark, sf_dir: str) -> DataFrame:
    """``op3``: all pages written as deduplicated archives and read back."""
    path = scratch_dir(spark, "warc")
    write_warc(read(spark, sf_dir, "pages"), f"{path}/archives")
    return resolved(stage(read_warc(spark, f"{path}/archives"), "warc_index")).drop("url")
