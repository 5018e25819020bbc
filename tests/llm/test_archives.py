"""Media archives and WARC archives: exact round trips."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from marketloom.llm import media, warc
from marketloom.llm.common import shared_path

ROWS = [(1, "one"), (2, ""), (3, None), (None, "no id"), (4, "x" * 64), (5, "x" * 65), (6, "é" * 100_000), (7, "zero\0\0"), (1, "one"), (8, "tail\n" * 30), (9, "tail\n" * 30), (10, "WARC/1.1\r\n\r\nWARC-Type: revisit\r\n\r\n" * 9)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "clash", 5) for r in ROWS], "doc_id long, text string, media string, n_bytes int").repartition(3)


def test_media_round_trip(spark, docs):
    folder = shared_path(spark, "media-test")
    media.save_media(docs, folder)
    back = media.load_media(spark, folder, rangeBytes=2048)
    assert back.rdd.getNumPartitions() > 3
    got = Counter((r.doc_id, media.from_image(bytes(r.media))[1][: media.from_image(bytes(r.media))[0]]) for r in back.collect())
    assert got == Counter((i, (t or "").encode()) for i, t in ROWS)
    by = defaultdict(set)
    for r in media.describe(back).collect():
        data = (dict(ROWS)[r.doc_id] or "").encode()
        payload = data.ljust(max(64, -(-len(data) // 64) * 64), b"\0")
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        by[r.payload_sha256].add((r.media_sha256, r.media_bytes, r.feature))
    assert all(len(v) == 1 for k, v in by.items() if k != hashlib.sha256(b"\0" * 64).hexdigest())


def test_media_members_are_fetched_again(spark, docs):
    class Once:
        broken = True

        def seek(self, at):
            self.at = at

        def read(self, n):
            if Once.broken:
                Once.broken = False
                raise OSError("lost")
            return b"abc"[:n]

        def close(self):
            Once.closed = True

    def opened():
        Once.opens = getattr(Once, "opens", 0) + 1
        if Once.opens == 1:
            raise OSError("not there yet")
        return Once()

    reader = media.MediaReader({"path": "file:///tmp"})
    assert reader._member(None, 0, 3, zlib.crc32(b"abc"), opened)[1] == b"abc" and Once.opens == 3 and Once.closed
    with pytest.raises(OSError):
        reader._member(Once(), 0, 3, 1, Once)


def test_media_empty(spark, docs):
    folder = shared_path(spark, "media-empty")
    media.save_media(docs.limit(0), folder)
    assert media.describe(media.load_media(spark, folder)).count() == 0


def test_warc_round_trip(spark, docs, monkeypatch):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("http://a b\n/"), "doc_id").alias("url"), F.col("text").alias("html"), F.lit(1).alias("chunk_no"))
    folder = shared_path(spark, "warc-test")
    manifest = warc.write_archives(warc.chunk_table(pages, chunk=1000), folder)
    rows = warc.read_archives(manifest, folder, chunk=700).collect()
    payloads = defaultdict(bytes)
    for r in sorted((r for r in rows if r.page_id not in (1, None)), key=lambda r: r.chunk_no):
        payloads[r.page_id] += bytes(r.data)
        if r.record_type == "response":
            assert r.digest == hashlib.sha256(payloads[r.page_id]).hexdigest() and r.upto == len(payloads[r.page_id])
    for i, t in ROWS:
        if i not in (1, None, 9):
            assert payloads[i] == (t or "").encode()
    last = {r.page_id: r for r in rows if r["last"]}
    assert last[9].record_type == "revisit" and last[9].refers_to == 8 and payloads[9] == b""
    assert last[9].digest == hashlib.sha256(ROWS[10][1].encode()).hexdigest() and last[9].upto == 150
    assert sum(r["last"] for r in rows) == len(ROWS)
    assert warc.read_archives(warc.write_archives(warc.chunk_table(pages.limit(0)), folder), folder).count() == 0


def test_warc_query(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    first: dict = {}
    for r in sorted(pages, key=lambda r: r.page_id):
        first.setdefault(r.html, r.page_id)
    want = set()
    for r in pages:
        data = (r.html or "").encode()
        again = len(data) >= 100 and first[r.html] != r.page_id
        want.add((r.page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[r.html] if again else None))
    assert {tuple(r) for r in warc.op5_warc(spark, sf).collect()} == want


def test_warc_archives_roll_over(spark, monkeypatch):
    """Every page is read back when archives are full in the middle of a range (sizes are set in this process, so no task is used)."""
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.lit("http://a/").alias("url"), F.concat(F.repeat(F.lit("x"), F.col("id").cast("int") % 700), F.col("id").cast("string")).alias("html"))
    batches = warc.chunk_table(pages, chunk=256).toArrow().to_batches()
    monkeypatch.setattr(warc, "ARCHIVE", 5000)
    monkeypatch.setattr(warc, "RANGE", 1500)
    folder = shared_path(spark, "warc-rolled")
    fs, base = warc.fs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)
    manifest = list(warc._write(batches, folder))
    assert len(manifest) > 10
    payloads = defaultdict(bytes)
    for batch in warc._read(manifest, folder, 200, True):
        for r in batch.to_pylist():
            payloads[r["page_id"]] += r["data"]
    assert payloads == {i: (b"x" * (i % 700) + str(i).encode()) for i in range(300)}
