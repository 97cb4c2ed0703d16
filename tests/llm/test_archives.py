"""Archives as other readers see them: members, notes, names and sizes."""

import glob
import gzip
import io
import os
import zlib

import pytest

from textlab.llm import warc


def members(raw):
    """The records of an archive, each from a gzip member of its own."""
    out = []
    while raw:
        d = zlib.decompressobj(31)
        out.append(d.decompress(raw) + d.flush())
        raw = d.unused_data
    return out


def archives(path):
    return [open(f, "rb").read() for f in sorted(glob.glob(f"{path}/*.warc.gz"))]


def test_one_member_a_record(spark, tmp_path):
    pages = [(i, f"http://{i}", f"<p>{i % 40}</p>" * (1 + i % 7)) for i in range(200)]
    warc.write_warc(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3), f"{tmp_path}/w")
    assert not glob.glob(f"{tmp_path}/w/*.txt")
    ids, n = set(), 0
    for raw in archives(f"{tmp_path}/w"):
        parts = members(raw)
        read = [next(warc.records(io.BytesIO(p))) for p in parts]
        assert all(len(list(warc.records(io.BytesIO(p)))) == 1 for p in parts)
        kinds = [h["warc-type"] for h, _ in read]
        assert kinds[0] == "warcinfo" and kinds[-1] == "metadata" and set(kinds[1:-1]) <= {"response", "revisit"}
        assert read[-1][1] == f"records: {len(parts) - 2}\r\n".encode() and read[-1][0]["warc-refers-to"] == read[0][0]["warc-record-id"]
        ids |= {h["warc-record-id"] for h, _ in read}
        n += len(parts)
        assert gzip.decompress(raw) == b"".join(parts)
    assert len(ids) == n and n == 200 + 2 * len(archives(f"{tmp_path}/w"))


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    rows = spark.range(40).selectExpr("id page_id", "concat('u', id) url", "concat_ws('', transform(sequence(1, 3000), x -> sha2(concat(id, '-', x), 256))) html")
    bound = 200_000  # a page is some 190,000 digits, of half a byte each
    warc.write_warc(rows, f"{tmp_path}/w", archive_bytes=bound)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{tmp_path}/w/*.warc.gz")]
    assert len(sizes) >= 10 and max(sizes) < bound + 130_000
    got = warc.read_warc(spark, f"{tmp_path}/w", payloads=True)
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in got.collect()} == {r["page_id"]: r["html"] for r in rows.collect()}


def test_records_of_many_megabytes(spark, tmp_path):
    """A record of over 16 MB has a length whose last byte is not zero."""
    rows = spark.range(3).selectExpr("id page_id", "'u' url", "repeat(concat('a', id, 'é'), 5000000) html")
    warc.write_warc(rows, f"{tmp_path}/w")
    got = warc.resolved(warc.read_warc(spark, f"{tmp_path}/w")).collect()
    assert sorted((r["page_id"], r["payload_bytes"], r["record_type"]) for r in got) == [(i, 20_000_000, "response") for i in range(3)]


def test_a_shortened_archive_is_refused(spark, tmp_path):
    warc.write_warc(spark.createDataFrame([(i, "u", str(i)) for i in range(5)], "page_id long, url string, html string").coalesce(1), f"{tmp_path}/w")
    raw = next(a for a in archives(f"{tmp_path}/w") if a)
    parts = members(raw)
    os.makedirs(f"{tmp_path}/cut")
    with open(f"{tmp_path}/cut/a.warc.gz", "wb") as f:
        f.write(b"".join(gzip.compress(p) for p in parts[:1] + parts[2:]))
    with pytest.raises(Exception, match="tells of"):
        warc.read_warc(spark, f"{tmp_path}/cut").count()
