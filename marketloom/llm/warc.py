"""WARC archives as a chunked record table.

Pages become rows (record, chunk number, bytes) of bounded size, inside the scan's own tasks. A writer streams these rows into
archives: it opens a record at chunk 0, appends chunk after chunk, carries the digest along and checks it at the last. A reader
streams ranges of archives back as the same kind of rows, each with the digest of all bytes so far. The scan holds a page's html once, as a
row of the input table does; from the chunk rows on, writing and reading hold one chunk.

Records whose payloads of MIN_REVISIT bytes or more are equal share one response, that with the smallest page_id; the others are
revisits that refer to it and hold no payload. The response of a payload is found by digest: minima summed in every task first.

An archive's name holds its writer's attempt; only ranges in the manifest, which Spark commits, are read.

Which payloads repeat is a table of digests; it is broadcast while it takes at most common.MOST_BROADCAST_BYTES, else joined by a shuffle.

Defined cases. A null html is empty. A page without an id is a revisit like others where another page with an id has its payload; pages
whose payload only occurs without ids are all responses. Rows that repeat the smallest page_id of a payload are all responses. Very long
pages are cut into chunks. Extra columns are not read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import io
import re
import uuid
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import shared_path, small_side, staged, store_of, table

CHUNK = 1 << 20
#: Bytes of an archive that one read task takes; a record is never split.
RANGE = 32 << 20
ARCHIVE = 1 << 30
MIN_REVISIT = 100

_DATE = b"1970-01-01T00:00:00Z"


def chunk_table(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", chunk: int = CHUNK) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, refers_to, chunk_no, data): one row for each chunk, chunks of a page in order.

    A revisit has one chunk without bytes.
    """
    body = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("body"))
    digest = rows.select("page_id", F.octet_length("body").cast("long").alias("payload_bytes"), F.sha2("body", 256).alias("payload_digest"))
    firsts = digest.filter(F.col("payload_bytes") >= MIN_REVISIT).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    firsts = staged(firsts, "warc-firsts")
    named = rows.withColumns({"payload_bytes": F.octet_length("body").cast("long"), "payload_digest": F.sha2("body", 256)}).join(small_side(firsts), "payload_digest", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    named = named.withColumn("refers_to", refers)
    last = F.when(F.col("refers_to").isNotNull(), F.lit(0)).otherwise(F.greatest(F.expr(f"(payload_bytes - 1) div {chunk}"), F.lit(0)))
    numbered = named.withColumn("chunk_no", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    data = F.when(F.col("refers_to").isNull(), F.substring("body", (F.col("chunk_no") * chunk + 1).cast("int"), F.lit(chunk))).otherwise(F.lit(b""))
    return numbered.select("page_id", "url", "payload_bytes", "payload_digest", "refers_to", "chunk_no", data.alias("data"))


def _write(batches, folder: str):
    store, base = store_of(folder)
    out = name = digest = None
    at = start = left = 0
    want = ""
    ranges: list[tuple] = []

    def manifest():
        rows, ranges[:] = list(ranges), []
        return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["archive", "start", "end"])

    for batch in batches:
        for page, url, size, sha, refers, number, data in zip(*(batch.column(i).to_pylist() for i in range(6)), batch.column(6)):
            data = data.as_py()
            if number == 0:
                if left:
                    raise ValueError("a record's chunks are not together")
                if out is None:
                    name, at, start = f"{uuid.uuid4().hex}.warc", 0, 0
                    out = store.open_output_stream(f"{base}/{name}")
                http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
                left = 0 if refers is not None else size
                head = [b"WARC/1.1", b"WARC-Type: " + (b"response" if refers is None else b"revisit"), b"WARC-Record-ID: <urn:page:%s>" % str(page).encode(), b"WARC-Date: " + _DATE]
                head += [b"WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", "", url or "about:blank").encode("utf-8", "surrogatepass"), b"WARC-Payload-Digest: sha256:" + sha.encode()]
                if refers is not None:
                    head += [b"WARC-Refers-To: <urn:page:%d>" % refers, b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
                head += [b"Content-Type: application/http;msgtype=response", b"Content-Length: %d" % (len(http) + left), b"", b""]
                at += out.write(b"\r\n".join(head) + http)
                digest, want = hashlib.sha256(), sha if refers is None else ""
            at += out.write(data)
            digest.update(data)
            left -= len(data)
            if left == 0:
                if want and digest.hexdigest() != want:
                    raise ValueError("a record's bytes differ from its digest")
                at += out.write(b"\r\n\r\n")
                if at - start >= RANGE or at >= ARCHIVE:
                    ranges.append((name, start, at))
                    start = at
                if at >= ARCHIVE:
                    out.close()
                    out = None
                    yield manifest()
    if out is not None:
        out.close()
        if at > start:
            ranges.append((name, start, at))
        yield manifest()


def write_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Writes archives into folder (a URI that all tasks reach); returns the manifest (archive, start, end), a written table."""
    store, base = store_of(folder)
    store.create_dir(base, recursive=True)
    return staged(chunks.mapInArrow(partial(_write, folder=folder), "archive string, start long, end long"), "warc-manifest")


CHUNKS = "page_id long, record_type string, refers_to long, chunk_no long, upto long, digest string, last boolean, data binary"
_ARROW = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("chunk_no", pa.int64()), ("upto", pa.int64()), ("digest", pa.string()), ("last", pa.bool_()), ("data", pa.binary())])


def _head(file) -> dict[bytes, bytes]:
    out = {}
    while line := file.readline().rstrip(b"\r\n"):
        key, _, value = line.partition(b":")
        out[key.strip().lower()] = value.strip()
    return out


def _number(urn: bytes | None) -> int | None:
    found = re.fullmatch(rb"<urn:page:(-?\d+)>", urn or b"")
    return int(found[1]) if found else None


def _records(file, end: int, chunk: int):
    """Rows of CHUNKS of the records up to end."""
    while file.tell() < end:
        if not file.readline().startswith(b"WARC/"):
            raise ValueError("no record here")
        head = _head(file)
        begun = file.tell()
        file.readline()
        http = _head(file)
        left = int(head[b"content-length"]) - (file.tell() - begun)
        page, kind, refers = _number(head[b"warc-record-id"]), head[b"warc-type"].decode(), _number(head.get(b"warc-refers-to"))
        if kind == "revisit":
            yield page, kind, refers, 0, int(http[b"content-length"]), head[b"warc-payload-digest"].removeprefix(b"sha256:").decode(), True, b""
        else:
            digest, number, upto = hashlib.sha256(), 0, 0
            while True:
                data = file.read(min(chunk, left))
                if len(data) < min(chunk, left):
                    raise EOFError("the archive ends in a record")
                left -= len(data)
                upto += len(data)
                digest.update(data)
                yield page, kind, refers, number, upto, digest.copy().hexdigest(), not left, data
                number += 1
                if not left:
                    break
        if file.read(4) != b"\r\n\r\n":
            raise ValueError("a record doesn't end here")


def _read(batches, folder: str, chunk: int, with_data: bool, most: int = 8 << 20):
    store, base = store_of(folder)
    for batch in batches:
        for name, start, end in zip(*(c.to_pylist() for c in batch.columns)):
            with store.open_input_file(f"{base}/{name}") as raw:
                raw.seek(start)
                rows, held = [], 0
                for row in _records(io.BufferedReader(raw, 1 << 20), end, chunk):
                    rows.append(row if with_data else (*row[:-1], None))
                    held += len(row[-1]) * with_data + 200
                    if held >= most:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


def read_archives(manifest: DataFrame, folder: str, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """Rows of CHUNKS: digest is that of the payload's first upto bytes, for a revisit that of the whole payload it refers to.

    with_data: False leaves data null, when only lengths and digests are wanted.
    """
    ranges = max(1, min(100_000, manifest.count()))
    return manifest.repartition(ranges).mapInArrow(partial(_read, folder=folder, chunk=chunk, with_data=with_data), CHUNKS)


def op5_warc(spark, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "warc")
    manifest = write_archives(chunk_table(table(spark, sf_dir, "pages")), folder)
    back = read_archives(manifest, folder, with_data=False).filter("last")
    return back.select("page_id", F.col("upto").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
