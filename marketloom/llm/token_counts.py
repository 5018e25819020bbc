"""Token counts without token ids.

A document's tokens are the sum, over its distinct pre-tokens, of how often each occurs times how many pieces it has; pieces are
counted once for each distinct pre-token of the corpus.

1. Each task turns a block of documents into per-document frequencies of block-local pre-token numbers, and lists the block's distinct
   pre-tokens.
2. These (pre-token, block, number) rows are dealt and sorted by pre-token; a task counts the pieces of each run of equal pre-tokens
   once while the rows stream by, and holds one batch.
3. Frequencies and counts of a block meet (a join on the block) and are multiplied and summed. A block is bounded, so is its group.

Documents never meet by pre-token, so a pre-token that all documents share costs one row for each block. Pre-tokens are the matches of
the vocabulary's own pattern; a special string in a text, and every text of a vocabulary without a pattern, is counted in the text
between two places at which no token can continue.

Defined cases. Null and empty texts have 0 tokens. Repeated rows give repeated results, also with null ids. Very long texts make a
block of their own. Ties do not occur. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm import subwords
from marketloom.llm.common import gives_back, staged, table

LIMIT = 1024
#: A block ends after so many distinct pre-tokens or characters, whichever comes first.
BLOCK_PRETOKENS = 500_000
BLOCK_CHARS = 32_000_000
#: Pre-tokens of a block that one row lists, and listed pre-tokens that are answered together.
LISTED = 4096
ANSWERED = 200_000

_ROWS = "block long, doc_id long, n_bytes long, numbers binary, counts binary, base int, words array<string>"
_ARROW = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("numbers", pa.binary()), ("counts", pa.binary()), ("base", pa.int32()), ("words", pa.list_(pa.string()))])


def _pack_counts(counts: np.ndarray) -> bytes:
    """Numbers below 2 ** 32, compressed with their bytes of equal weight together."""
    return zlib.compress(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack_counts(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _pack(numbers: np.ndarray) -> bytes:
    """Ascending numbers as compressed steps."""
    return _pack_counts(np.diff(numbers, prepend=0))


def _unpack(packed: bytes) -> np.ndarray:
    return _unpack_counts(packed).cumsum()


@gives_back
def _frequencies(batches, vocabulary: str):
    from pyspark import TaskContext

    split = subwords.splitter(vocabulary)
    number: dict[str, int] = {}
    known: dict[str, list[int]] = {}  # numbers of the pre-tokens of a piece
    block, chars = TaskContext.get().partitionId() << 32, 0

    def rows(values: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*values), _ARROW.types)], schema=_ARROW)

    def numbers_of(piece: str) -> list[int]:
        known[piece] = out = [number.setdefault(x, len(number)) for x in split(piece)]
        return out

    def closed():
        words = list(number)
        for at in range(0, len(words), LISTED):
            yield rows([(block, None, None, None, None, at, words[at : at + LISTED])])

    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), [x or "" for x in batch.column(1).to_pylist()]
        for a, b in subwords.portions(texts):
            out = []
            for doc, text in zip(ids[a:b], texts[a:b]):
                seen: dict[int, int] = {}
                for piece, n in Counter(subwords.pieces(text)).items():
                    for k in known.get(piece) or numbers_of(piece):
                        seen[k] = seen.get(k, 0) + n
                mine = np.fromiter(seen, dtype=np.int64, count=len(seen))
                counts, order = np.fromiter(seen.values(), dtype=np.int64, count=len(seen)), np.argsort(mine)
                out.append((block, doc, len(text.encode("utf-8", "surrogatepass")), _pack(mine[order]), _pack_counts(counts[order]), None, None))
                chars += len(text)
            yield rows(out)
            if len(number) > BLOCK_PRETOKENS or chars > BLOCK_CHARS:
                yield from closed()
                number.clear()
                known.clear()
                block, chars = block + 1, 0
    yield from closed()


@gives_back
def _pieces(batches, vocabulary: str):
    """(block, numbers, counts): rows come sorted by pre-token, and each run of equal ones is counted once. Up to ANSWERED rows are
    answered together, one row for each block among them."""
    last, n_last, held, size = None, 0, [], 0

    def answers():
        block, number, n = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((number, block))
        block, number, n = block[order], number[order], n[order]
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        parts = [(number[a:b], n[a:b]) for a, b in zip(starts, [*starts[1:], len(block)])]
        return pa.RecordBatch.from_arrays([pa.array(block[starts]), pa.array([_pack(x) for x, _ in parts]), pa.array([_pack_counts(x) for _, x in parts])], names=["block", "numbers", "counts"])

    for batch in batches:
        words = batch.column(2)
        if not len(words):
            continue
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        fresh = [x for x in distinct if x != last]
        counts = dict(zip(fresh, subwords.count(fresh, vocabulary).tolist()))
        n = np.array([n_last if x == last else counts[x] for x in distinct], dtype=np.int64)[coded.indices.to_numpy()]
        last, n_last = words[-1].as_py(), int(n[-1])
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), n))
        size += len(n)
        if size >= ANSWERED:
            yield answers()
            held, size = [], 0
    if held:
        yield answers()


def _sums(docs: pa.Table, answers: pa.Table) -> pa.Table:
    parts = [(_unpack(a.as_py()), _unpack_counts(b.as_py())) for a, b in zip(answers["numbers"], answers["counts"])]
    n_pieces = np.zeros(sum(len(x) for x, _ in parts), dtype=np.int64)
    for number, n in parts:
        n_pieces[number] = n
    totals = [int(n_pieces[_unpack(a.as_py())] @ _unpack_counts(b.as_py())) for a, b in zip(docs["numbers"], docs["counts"])]
    return pa.table({"doc_id": docs["doc_id"], "n_bytes": docs["n_bytes"], "n_tokens": pa.array(totals, pa.int64())})


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = subwords.VOCABULARY) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(partial(_frequencies, vocabulary=vocabulary), _ROWS)
    rows = staged(rows, "pretokens")
    listed = rows.filter("words IS NOT NULL").select("block", "base", F.posexplode("words").alias("at", "word"))
    asked = listed.select("block", (F.col("base") + F.col("at")).alias("number"), "word").repartition("word").sortWithinPartitions("word")
    answers = asked.mapInArrow(partial(_pieces, vocabulary=vocabulary), "block long, numbers binary, counts binary")
    held = rows.filter("words IS NULL").select("block", "doc_id", "n_bytes", "numbers", "counts")
    return held.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_sums, "doc_id long, n_bytes long, n_tokens long")


def op6_token_counts(spark, sf_dir: str, limit: int = LIMIT) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > limit)
