"""WARC archives: exact round trips, the normaliser on hand-made streams, damage and odd rows."""

import gzip
import zlib

import pytest
from pyspark.sql import functions as F

from tamarind.llm import warc as W
from tamarind.llm.common import Workspace


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def expected(rows, least=0):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        revisit = bool(same) and i != max(same) and len(data) >= least
        out.append((i, len(data), W.payload_digest(data), "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((int(r.record_id) if r.record_id else None, r.payload_bytes, r.payload_digest, r.record_type,
                    int(r.refers_to) if r.refers_to else None) for r in df.collect()), key=str)


ROWS = ([(i, f"http://h/{i}", f"<p>{i % 7}</p>" * (i % 7)) for i in range(60)]
        + [(100, None, "x"), (101, "http://a\r\nWARC-Type: fake", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (102, "u", None), (103, "u", ""),
           (104, "ü", "é日本\x00\r\n" * 3), (105, "u", "long " * 400_000), (None, "u", "x"), (None, "u", "alone"), (59, "u", "<p>3</p>" * 3), (106, "", "y")])


@pytest.mark.parametrize("least", [0, 10])
def test_round_trip(spark, least):
    df = pages(spark, ROWS).select("*", *[F.lit("mine").alias(c) for c in ("id", "digest", "size", "revisit", "first", "refers_to", "payload")])
    assert got(W.archive_pages(df.repartition(4), least_bytes=least)) == expected(ROWS, least)


def test_no_pages(spark):
    assert W.archive_pages(pages(spark, [])).collect() == []


def test_small_archives_and_their_sidecars(spark):
    """Archives roll over; each record is a member of its own, at the offset that the sidecar says."""
    ws = Workspace(spark, "t")
    listed = W.write_archives(pages(spark, ROWS).coalesce(1), f"{ws.root}/a", ws, archive_bytes=2000)
    assert listed.count() > 3 and listed.agg(F.sum("n_records")).first()[0] == len(ROWS)
    for r in listed.collect():  # one stream
        data = open(r.archive.removeprefix("file:"), "rb").read()
        z = zlib.decompressobj(31)
        z.decompress(data)
        assert z.eof and not z.unused_data and len(data) == r.n_bytes
    index = W.normalise(listed, f"{ws.root}/b", ws)
    by = {}
    for r in index.collect():
        by.setdefault(r.archive, []).append(r)
    for archive, rows in by.items():
        data = open(archive.removeprefix("file:"), "rb").read()
        side = [x.split("\t") for x in open(archive.removeprefix("file:").removesuffix(".warc.gz") + ".idx", encoding="utf-8").read().splitlines()]
        assert [(int(x[0]), int(x[1]), x[2]) for x in side] == sorted((r.offset, r.length, r.record_id) for r in rows)
        assert sum(r.length for r in rows) == len(data)
        for r in rows:
            assert gzip.decompress(data[r.offset:r.offset + r.length]).startswith(b"WARC/1.1\r\n")
        assert gzip.decompress(data).count(b"WARC-Record-ID") == len(rows)
    assert got(W.check_payloads(W.read_records(index, span=1000))) == expected(ROWS)


def record(name, block):
    return f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <{W.SCHEME}{name}>\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_normaliser_reads_every_layout_and_reports_damage(spark, tmp_path):
    recs = [record(i, bytes([65 + i]) * n) for i, n in enumerate((0, 5, 3_000_000, 1))]
    whole = b"".join(recs)
    layouts = {"whole": gzip.compress(whole), "single": b"".join(map(gzip.compress, recs)),
               "odd": gzip.compress(whole[:700]) + gzip.compress(whole[700:]), "plain": whole, "padded": gzip.compress(whole) + b"\0" * 9,
               "empty": b"", "cut": gzip.compress(whole)[:-40], "junk": gzip.compress(recs[0] + b"no record"), "short": recs[0] + recs[1][:-6]}
    for name, data in layouts.items():
        (tmp_path / f"{name}.warc.gz").write_bytes(data)
    ws = Workspace(spark, "t")
    listed = spark.createDataFrame([(f"{tmp_path}/{n}.warc.gz",) for n in layouts], "archive string")
    index = W.normalise(listed, f"{ws.root}/n", ws)
    found, damaged = {}, set()
    for r in index.orderBy("source", "offset").collect():
        name = r.source.rpartition("/")[2].removesuffix(".warc.gz")
        if r.damaged:
            damaged.add(name)
            continue
        data = open(r.archive.removeprefix("file:"), "rb").read()[r.offset:r.offset + r.length]
        found.setdefault(name, []).append(gzip.decompress(data))
    for name in ("whole", "single", "odd", "plain", "padded"):
        assert found[name] == recs, name
    assert damaged == {"cut", "junk", "short"} and "empty" not in found
    assert found["junk"] == recs[:1] == found["short"] and found["cut"] == recs[:len(found["cut"])]


def test_a_damaged_payload_is_an_error(spark):
    ws = Workspace(spark, "t")
    index = W.normalise(W.write_archives(pages(spark, [(1, "u", "hello")]), f"{ws.root}/a", ws), f"{ws.root}/b", ws)
    r = index.first()
    path = r.archive.removeprefix("file:")
    data = gzip.decompress(open(path, "rb").read()).replace(b"hello", b"hallo")
    open(path, "wb").write(gzip.compress(data))
    import os
    index = index.withColumn("length", F.lit(os.path.getsize(path)).cast("long"))
    with pytest.raises(Exception, match="damaged payload of record 1"):
        W.check_payloads(W.read_records(index)).collect()


def test_base32(spark):
    for text in ("", "a", "é"):
        df = spark.createDataFrame([(text,)], "t string")
        assert df.select(W.base32_sha1(F.col("t"))).first()[0] == W.payload_digest(text.encode())


def test_a_payload_is_hashed_once(spark):
    """The digest is used twice, and stands in 32 digits each time: its hash is a step of its own."""
    found = spark.createDataFrame([("1", "response", "t", None, W.payload_digest(b"abc"), 3, bytearray(b"abc"), "a", 0)], W.RECORDS)
    out = W.check_payloads(found)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("sha1(") == 1
    assert out.columns == found.columns and out.collect() == found.collect()
