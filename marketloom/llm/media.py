"""Media columns: a data source over archive directories.

Texts become 8-bit samples: rows of 64 grey pixels in a PNG, one tar member each. `save_media` writes archives from tasks and
a manifest table; the source "media_archive" plans byte ranges over those archives, and a task streams the members that begin in
its range through Arrow, in batches of bounded size.

Beside each archive lies an index of fixed-width records (offset, size, checksum, id), ordered by offset, so a range finds its
first member by bisection and every member can be fetched, checked and fetched again by its offset alone, without the ones before
it. An archive's name holds its writer's attempt; only archives in the manifest, which Spark commits, are read, so lost or repeated
attempts leave no rows.

Defined cases. A null text is empty: 64 zero bytes. A null id is kept as null. Repeated rows are members of their own. Very long texts are stored and fetched whole, one
member at a time, as a range ends with the member that begins in it. Ties cannot occur: members are found by offset. Extra columns are not read, whatever their names. An empty table gives an empty archive list and an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import time
import uuid
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from marketloom.llm.common import shared_path, store_of, table

WIDTH = 64
#: Bytes of an archive that one read task takes.
RANGE = 64 << 20
#: Bytes of payload in one Arrow batch.
BATCH = 8 << 20
ATTEMPTS = 4
#: A new archive is begun after so many bytes.
ARCHIVE = 512 << 20

_ENTRY = struct.Struct("<qqIqB")  # offset of the payload, size, crc32, id, whether the id is null


_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_image(data: bytes) -> bytes:
    """A grey 8-bit PNG of 64 columns that holds data and zero bytes after it; a text chunk holds data's length."""
    rows = max(1, -(-len(data) // WIDTH))
    samples = np.zeros((rows, WIDTH + 1), dtype=np.uint8)  # the first column says that a row is not filtered
    samples[:, 1:] = np.frombuffer(data.ljust(rows * WIDTH, b"\0"), dtype=np.uint8).reshape(rows, WIDTH)
    head = struct.pack(">IIBBBBB", WIDTH, rows, 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"tEXt", b"bytes\0%d" % len(data)) + _chunk(b"IDAT", zlib.compress(samples.tobytes(), 1)) + _chunk(b"IEND", b"")


def from_image(stored: bytes) -> tuple[int, bytes]:
    """Length of the data and the samples of an image that to_image made; every chunk's checksum is tested."""
    if not stored.startswith(_SIGNATURE):
        raise ValueError("not a PNG")
    at, chunks = len(_SIGNATURE), {}
    while at < len(stored):
        (size,) = struct.unpack_from(">I", stored, at)
        kind, data = stored[at + 4 : at + 8], stored[at + 8 : at + 8 + size]
        if struct.unpack_from(">I", stored, at + 8 + size)[0] != zlib.crc32(kind + data):
            raise ValueError("a chunk is damaged")
        chunks[kind] = data
        at += 12 + size
    width, rows = struct.unpack_from(">II", chunks[b"IHDR"])
    lines = np.frombuffer(zlib.decompress(chunks[b"IDAT"]), dtype=np.uint8).reshape(rows, width + 1)
    if width != WIDTH or lines[:, 0].any():
        raise ValueError("not an image of this module")
    return int(chunks[b"tEXt"].partition(b"\0")[2]), lines[:, 1:].tobytes()


def feature(samples: bytes) -> str:
    """Mean, deviation, roughness and a 64-bit outline (columns brighter than the image's mean)."""
    image = np.frombuffer(samples, dtype=np.uint8).reshape(-1, WIDTH)
    columns = image.sum(axis=0, dtype=np.int64)
    total, n = int(columns.sum()), image.size
    squares = int(np.bincount(image.ravel(), minlength=256) @ (np.arange(256, dtype=np.int64) ** 2))
    edges = int(np.abs(np.diff(image.astype(np.int16), axis=1)).sum())
    outline = int.from_bytes(np.packbits(columns * WIDTH > total).tobytes(), "big")
    deviation = max(0.0, squares / n - (total / n) ** 2) ** 0.5
    return f"mean={total / n:.4f};sd={deviation:.4f};rough={edges / n:.4f};outline={outline:016x}"


def _write(batches, folder: str):
    store, base = store_of(folder)
    name = out = index = None
    at = count = 0

    def close():
        out.write(b"\0" * 1024)
        out.close()
        with store.open_output_stream(f"{name}.idx") as f:
            f.write(b"".join(index))
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in (name.rpartition("/")[2], at, count)], names=["archive", "n_bytes", "n_members"])

    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1)):
            if out is None:
                name, index, at, count = f"{base}/{uuid.uuid4().hex}.tar", [], 0, 0
                out = store.open_output_stream(name)
            doc, media = doc.as_py(), to_image((text.as_py() or "").encode("utf-8", "surrogatepass"))
            member = tarfile.TarInfo(f"{count:09d}-{doc}.png")
            member.size = len(media)
            head = member.tobuf(tarfile.USTAR_FORMAT)
            out.write(head)
            out.write(media)
            out.write(b"\0" * (-len(media) % 512))
            index.append(_ENTRY.pack(at + len(head), len(media), zlib.crc32(media), doc or 0, doc is None))
            at += len(head) + len(media) + (-len(media) % 512)
            count += 1
            if at >= ARCHIVE:
                yield close()
                out = None
    if out is not None:
        yield close()


def save_media(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text") -> None:
    """Writes archives into folder, and the table of those that count into folder/manifest. folder: a URI that all tasks reach."""
    store, base = store_of(folder)
    store.create_dir(base, recursive=True)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text))
    rows.mapInArrow(partial(_write, folder=folder), "archive string, n_bytes long, n_members long").write.parquet(f"{folder}/manifest")


class MediaRange(InputPartition):
    def __init__(self, archive: str, start: int, end: int):
        super().__init__((archive, start, end))
        self.archive, self.start, self.end = archive, start, end


class MediaReader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"]
        self.range = int(options.get("rangeBytes", RANGE))
        self.attempts = int(options.get("attempts", ATTEMPTS))

    def partitions(self):
        import pyarrow.dataset as ds

        store, base = store_of(self.folder)
        files = [x.path for x in store.get_file_info(fs.FileSelector(f"{base}/manifest")) if x.path.endswith(".parquet")]
        manifest = ds.dataset(files, filesystem=store).to_table() if files else None
        if not manifest or not manifest.num_rows:
            return [MediaRange("", 0, 0)]
        sizes = zip(manifest["archive"].to_pylist(), manifest["n_bytes"].to_pylist())
        return [MediaRange(a, s, min(n, s + self.range)) for a, n in sizes for s in range(0, n, self.range)]

    def _member(self, file, offset: int, size: int, crc: int, reopen):
        """The file in use and one member, checked; a failed open or read, or a wrong checksum, fetches it again by its offset."""
        for attempt in range(self.attempts):
            try:
                if file is None:
                    time.sleep(0.1 * attempt)
                    file = reopen()
                file.seek(offset)
                data = file.read(size)
                if len(data) == size and zlib.crc32(data) == crc:
                    return file, data
            except OSError:
                pass
            if file is not None:
                file.close()
            file = None
        raise OSError(f"member at {offset} can't be read")

    def read(self, part):
        if not part.archive:
            return
        store, base = store_of(self.folder)
        path = f"{base}/{part.archive}"
        reopen = lambda: store.open_input_file(path)
        file, ids, media, held = None, [], [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "media"])

        with store.open_input_file(f"{path}.idx") as index:
            entry = lambda i: (index.seek(i * _ENTRY.size), _ENTRY.unpack(index.read(_ENTRY.size)))[1]
            n = index.size() // _ENTRY.size
            low, high = 0, n
            while low < high:  # the first member at or after the range's start
                middle = (low + high) // 2
                low, high = (low, middle) if entry(middle)[0] >= part.start else (middle + 1, high)
            index.seek(low * _ENTRY.size)
            for _ in range(low, n):
                offset, size, crc, doc, unknown = _ENTRY.unpack(index.read(_ENTRY.size))
                if offset >= part.end:
                    break
                file, data = self._member(file, offset, size, crc, reopen)
                ids.append(None if unknown else doc)
                media.append(data)
                held += size
                if held >= BATCH:
                    yield batch()
                    ids, media, held = [], [], 0
        if file is not None:
            file.close()
        if ids:
            yield batch()


class MediaArchive(DataSource):
    """Members of the archives of a folder: doc_id long, media binary. Options: path, rangeBytes, attempts."""

    @classmethod
    def name(cls):
        return "media_archive"

    def schema(self):
        return "doc_id long, media binary"

    def reader(self, schema):
        return MediaReader(self.options)


_FEATURES = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])


def _described(batches):
    for batch in batches:
        rows = []
        for doc, stored in zip(batch.column(0).to_pylist(), batch.column(1)):
            media = stored.as_py()
            length, samples = from_image(media)
            rows.append((doc, length, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-WIDTH:]), len(media), hashlib.sha256(media).hexdigest(), feature(samples)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _FEATURES.types)], schema=_FEATURES)


def describe(media: DataFrame) -> DataFrame:
    """Lengths, digests and the feature of each member of a media column (doc_id, media)."""
    return media.select("doc_id", "media").mapInArrow(_described, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def load_media(spark, folder: str, **options) -> DataFrame:
    spark.dataSource.register(MediaArchive)
    return spark.read.format("media_archive").options(**options).load(folder)


def op1_media_columns(spark, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "media")
    save_media(table(spark, sf_dir, "documents"), folder)
    return describe(load_media(spark, folder))
