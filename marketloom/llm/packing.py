"""Packing by power-of-two decomposition.

A document of n tokens is cut into as many whole sequences of MOST tokens as fit, and the rest by its binary digits, longest
first. Every piece is a sequence of its own, of a length that is a power of two; equal lengths go to one bucket, from which
batches of one shape are drawn. No sequence crosses documents and nothing is padded.

Tokens never leave the task that made them (a checksum does); a piece's number in its bucket comes from a hash slot, a row number
in that slot and a small table of slot counts, so no bucket is ever gathered in one task.

Defined cases. A null text is empty: one piece with only the end token. Repeated rows are documents of their own, also with null ids.
Very long texts are encoded whole, alone in their portion; ties are numbered by id, start and checksum. Extra columns
are not read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.llm import subwords
from marketloom.llm.common import gives_back, staged, table

MOST = 2048
END = 1
SLOTS = 1024

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])


def lengths(n: int, most: int = MOST) -> list[int]:
    """Powers of two, longest first, at most `most` each, that sum to n."""
    return [most] * (n // most) + [1 << b for b in range(most.bit_length() - 2, -1, -1) if n % most >> b & 1]


@gives_back
def _cut(batches, vocabulary: str, most: int):
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), [x or "" for x in batch.column(1).to_pylist()]
        for a, b in subwords.portions(texts):
            rows: list[tuple] = []
            for doc, own in zip(ids[a:b], subwords.encode(texts[a:b], vocabulary)):
                data, at, n = own.tobytes() + np.array([END], dtype="<u4").tobytes(), 0, len(own) + 1
                for size in lengths(n, most):
                    rows.append((doc, at, size, zlib.crc32(data[4 * at : 4 * (at + size)]), n))
                    at += size
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


def cut(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = subwords.VOCABULARY, most: int = MOST) -> DataFrame:
    """Pieces of every document, one row each."""
    if most & (most - 1) or most < 2:
        raise ValueError("most must be a power of two")
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text)).mapInArrow(partial(_cut, vocabulary=vocabulary, most=most), PIECES)


def number(pieces: DataFrame, slots: int = SLOTS) -> DataFrame:
    """pieces with bucket (its length) and sequence_id, unique over all and without gaps inside a bucket.

    sequence_id = log2(length) * 2 ** 56 + the place in the bucket.
    """
    slot = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(slots)).cast("int")
    slotted = pieces.withColumn("__slot", slot)
    counts = slotted.groupBy("length", "__slot").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inside = Window.partitionBy("length", "__slot").orderBy("doc_id", "start", "ids_crc32")
    # At most slots x 12 lengths rows are broadcast.
    placed = slotted.withColumn("__inside", F.row_number().over(inside) - 1).join(F.broadcast(offsets), ["length", "__slot"])
    place = F.col("__before") + F.col("__inside")
    return placed.select(*pieces.columns, F.col("length").alias("bucket"), (F.shiftleft(F.log2("length").cast("long"), 56) + place).cast("long").alias("sequence_id"))


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = subwords.VOCABULARY, most: int = MOST) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, bucket, sequence_id, offset (always 0)."""
    return number(staged(cut(docs, key, text, vocabulary, most), "pieces")).withColumn("offset", F.lit(0).cast("long"))


def op2_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
