"""Near-duplicate components with odd sketches.

A document is the set of its 3-word shingles. Equal sets are one class. Each class has 256 MinHash samples: 125 of them form 25
bands of 5, and all are folded into a bitmap of 1024 bits in which every sample flips one bit (an odd sketch). The bits that
differ between two sketches estimate a high similarity closely, so most wrong candidates are dropped before any set is moved.

1. In each band bucket the members are candidates with one hub (a member drawn by hash, another in each band): one pair for each
   member, never all pairs. Candidates whose sketches are close are confirmed on full sets; links join classes to components.
2. In buckets that still hold several components, members outside the largest one are compared, by finer sketches (1024 samples, 4096
   bits), with the bucket's members of other components; close pairs are confirmed too. Pairs inside a component change nothing and are never compared.

Two classes at similarity 0.85 share a band with probability 1 - 4e-7, and their sketches stay under the cut to more than 4
standard deviations; both grow with the similarity. A link is only ever made by the exact sizes of full sets (of 64-bit hashes).

Broadcasts hold only ids and keys and are bounded in bytes (common.small_side); beyond the bound the same joins shuffle.

Defined cases. A document with fewer than three words is one shingle; without words (or null) it has an empty set and is linked with
nothing. Repeated rows and equal texts fall into one class. Ties do not occur: components are named by their smallest id. A null id
is linked like any other, and a component is named by its smallest id that isn't null; one of null ids only has a null name. Very long
texts are hashed in blocks. Extra columns are not read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import gives_back, small_side, staged, table, text_or_empty
from marketloom.llm.components import connected_components

SAMPLES, BANDS, ROWS, BITS = 256, 25, 5, 1024
SHARE = 85
#: Most differing bits of two sketches of a pair at the threshold: its mean is about 71, a standard deviation about 10.
MOST_BITS = 118
#: Finer sketches of the members that are compared in step 2: samples, bits, and most differing bits (mean about 285, deviation 20).
FINE_SAMPLES, FINE_BITS, MOST_FINE_BITS = 1024, 4096, 377

_rng = np.random.Generator(np.random.PCG64(20240))
_FACTORS = _rng.integers(1, 2**63, FINE_SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 2**63, FINE_SAMPLES, dtype=np.uint64)
_U = np.uint64
#: Remembered word hashes of one worker.
MOST_WORDS = 150_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MOST_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_words = _WordHashes()


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct 3-word shingles of a text, lower-cased in A-Z."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))
    if len(h) < 3:
        for x in h[1:]:
            h = _mix(h[:1] * _U(0x9E3779B97F4A7C15) + x)
        return h[:1] if len(h) < 2 else _mix(h[:1] + _U(len(words)))
    return np.unique(_mix(_mix(_mix(h[:-2]) + h[1:-1]) + h[2:]))


def samples(hashes: np.ndarray, n: int = SAMPLES) -> np.ndarray:
    """The first n MinHash samples of a set."""
    out = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 2048):
        np.minimum(out, (hashes[at : at + 2048][None, :] * _FACTORS[:n, None] + _SHIFTS[:n, None]).min(axis=1), out=out)
    return out


def odd_sketch(mins: np.ndarray, n_bits: int = BITS) -> np.ndarray:
    """Parity bitmaps of rows of samples, as rows of 64-bit words."""
    rows, n = mins.shape
    spots = (_mix(mins + np.arange(n, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) >> _U(40)) % _U(n_bits)
    bits = np.zeros((rows, n_bits), dtype=np.uint8)
    np.bitwise_xor.at(bits, (np.repeat(np.arange(rows), n), spots.astype(np.int64).ravel()), 1)
    return np.packbits(bits, axis=1, bitorder="little").view("<i8")


def band_keys(mins: np.ndarray) -> np.ndarray:
    grouped = mins[:, : BANDS * ROWS].reshape(len(mins), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(mins), BANDS)).copy()
    for r in range(ROWS):
        key = _mix(key * _U(0x9E3779B97F4A7C15) + grouped[:, :, r])
    return key.view(np.int64)


_FEATURES = "doc_id long, text_hash long, n_shingles long, digest binary, sketch array<long>, bands array<long>"
_FEATURES_ARROW = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("sketch", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))])


@gives_back
def _features(batches):
    for batch in batches:
        texts = batch.column(2)
        for at in range(0, batch.num_rows, 512):
            sizes, digests, mins = [], [], []
            for text in texts.slice(at, 512):
                hashes = shingle_set(text.as_py())
                sizes.append(len(hashes))
                digests.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None)
                mins.append(samples(hashes))
            m, n = np.array(mins), len(mins)
            rows = lambda x, w: pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * w, pa.int32()), pa.array(np.ascontiguousarray(x).ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 512), batch.column(1).slice(at, 512), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), rows(odd_sketch(m), BITS // 64), rows(band_keys(m), BANDS)], schema=_FEATURES_ARROW)


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    body = text_or_empty(text)
    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.xxhash64(body).alias("text_hash"), body.alias("text")).mapInArrow(_features, _FEATURES)


_FINE_ARROW = pa.schema([("cls", pa.int64()), ("digest", pa.binary()), ("fine", pa.list_(pa.int64()))])


@gives_back
def _fine(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            own = [shingle_set(x.as_py()) for x in batch.column(1).slice(at, 128)]
            words = odd_sketch(np.array([samples(x, FINE_SAMPLES) for x in own]), FINE_BITS)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * (FINE_BITS // 64), pa.int32()), pa.array(np.ascontiguousarray(words).ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 128), pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in own], pa.binary()), lists], schema=_FINE_ARROW)


_SETS_ARROW = pa.schema([("cls", pa.int64()), ("digest", pa.binary()), ("hashes", pa.binary())])


@gives_back
def _sets(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            own = [shingle_set(x.as_py()).tobytes() for x in batch.column(1).slice(at, 512)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 512), pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in own], pa.binary()), pa.array(own, pa.binary())], schema=_SETS_ARROW)


@gives_back
def _linked(batches, share: int):
    for batch in batches:
        keep = np.zeros(batch.num_rows, dtype=bool)
        for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
            a, b = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
            both = np.concatenate([a, b])
            both.sort(kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            keep[i] = 100 * common >= share * (len(a) + len(b) - common)
        yield batch.select([0, 1]).filter(pa.array(keep))


def of_classes(wanted: DataFrame, docs: DataFrame, classes: DataFrame, make, schema: str, key: str, text: str, label: str) -> DataFrame:
    """What make derives from the texts of some classes (wanted: cls, staged), one written row for each; schema has cls and digest.

    A class's text is that of one row: its id and its text's hash. Where equal rows come, one of them stays.
    """
    named = staged(classes.join(small_side(wanted), "cls", "left_semi").select("cls", "doc_id", "text_hash", "digest"), f"{label}-named")
    side = small_side(named.select("cls", F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")))
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), text_or_empty(text).alias("text")).withColumn("hash", F.xxhash64("text"))
    found = rows.join(side, F.col("id").eqNullSafe(F.col("__id")) & (F.col("hash") == F.col("__hash"))).select("cls", "text")
    made = found.mapInArrow(make, schema).join(small_side(named.select("cls", "digest")), ["cls", "digest"], "left_semi")
    return staged(made.dropDuplicates(["cls", "digest"]).drop("digest"), label)


def confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, share: int, key: str, text: str) -> DataFrame:
    """The pairs (a, b) whose full sets are linked. Sets are made again from the texts of the classes that occur in pairs."""
    wanted = staged(pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct(), "near-wanted")
    sets = of_classes(wanted, docs, classes, _sets, "cls long, digest binary, hashes binary", key, text, "near-sets")
    side = lambda name: sets.select(F.col("cls").alias(name), F.col("hashes").alias(f"hashes_{name}"))
    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "hashes_a", "hashes_b")
    return staged(joined.mapInArrow(partial(_linked, share=share), "a long, b long"), "near-links")


def _close(a: str, b: str, share: int, sketch: str = "sketch", n_bits: int = BITS, most: int = MOST_BITS):
    """Sizes and sketches allow a link."""
    bits = sum((F.bit_count(F.get(F.col(f"{a}.{sketch}"), F.lit(i)).bitwiseXOR(F.get(F.col(f"{b}.{sketch}"), F.lit(i)))) for i in range(n_bits // 64)), F.lit(0))
    sizes = 100 * F.least(f"{a}.n", f"{b}.n") >= share * F.greatest(f"{a}.n", f"{b}.n")
    return sizes & (bits <= most)


def classified(docs: DataFrame, key: str = "doc_id", text: str = "text", share: int = SHARE) -> tuple[DataFrame, DataFrame]:
    """(rows, names): rows has doc_id, text_hash, n_shingles and digest of every row; names has digest, component_id and lead of every
    set that isn't empty. lead is the text hash of the row that stands for a component without any id, in that row's own set.

    share: percent of the union that two linked sets have in common (85 or more: bands and the sketch's cut are made for it).
    """
    rows = staged(features(docs, key, text), "near-features")
    full = rows.filter("n_shingles > 0")
    # Ids that aren't null first.
    first = full.groupBy("digest").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_hash", F.col("n_shingles").alias("n"), "sketch", "bands")).alias("x"))
    # A class is numbered by its id, or by a hash of its digest where all its ids are null.
    number = F.coalesce(F.col("x.doc_id"), F.xxhash64("digest")).alias("cls")
    classes = staged(first.select("digest", number, "x.doc_id", "x.text_hash", "x.n", "x.sketch", "x.bands"), "near-classes")

    buckets = classes.select("cls", F.explode("bands").alias("bucket"))
    shared = staged(buckets.groupBy("bucket").agg(F.count("*").alias("m"), F.min_by("cls", F.xxhash64("cls", "bucket")).alias("hub")).filter("m > 1").drop("m"), "near-buckets")
    members = staged(buckets.join(small_side(shared), "bucket"), "near-members")
    pairs = members.filter("cls <> hub").select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).distinct()
    side = classes.select("cls", "n", "sketch")
    close = pairs.join(side.alias("x"), F.col("a") == F.col("x.cls")).join(side.alias("y"), F.col("b") == F.col("y.cls")).filter(_close("x", "y", share))
    tried = staged(close.select("a", "b"), "near-pairs")
    links = confirmed(tried, docs, classes, share, key, text)
    found = connected_components(links)

    # Buckets that still hold several components: those outside the largest against the others.
    named = members.select("bucket", "cls").join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    named = staged(named, "near-named-members")
    per = named.groupBy("bucket", "component").agg(F.count("*").alias("m"))
    mixed = staged(per.groupBy("bucket").agg(F.max_by("component", F.struct("m", "component")).alias("major"), F.count("*").alias("k")).filter("k > 1").drop("k"), "near-mixed")
    loose = named.join(small_side(mixed), "bucket")
    compared = staged(loose.select("cls").distinct(), "near-compared")
    fine = of_classes(compared, docs, classes, _fine, "cls long, digest binary, fine array<long>", key, text, "near-fine")
    held = staged(loose.join(fine, "cls").join(classes.select("cls", "n", F.col("bands").alias("marks")), "cls"), "near-loose")
    both = F.zip_with("x.marks", "y.marks", lambda p, q: p == q)
    # A pair is compared in the first band that it shares.
    once = F.element_at("x.marks", F.array_position(both, True).cast("int")) == F.col("x.bucket")
    different = F.col("x.component") != F.col("y.component")
    order = (F.col("y.component") == F.col("y.major")) | (F.col("x.cls") < F.col("y.cls"))
    rest = held.filter("component <> major").alias("x").join(held.alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & different & order & _close("x", "y", share, "fine", FINE_BITS, MOST_FINE_BITS) & once)
    more = staged(rest.select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")).distinct().join(tried, ["a", "b"], "left_anti"), "near-more")
    extra = confirmed(more, docs, classes, share, key, text)
    joined = links.union(extra)
    found = connected_components(joined) if not extra.isEmpty() else found

    held = classes.select("digest", "cls", "doc_id", "text_hash").join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    names = held.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.min(F.struct("digest", "text_hash")).alias("lead"))
    lead = F.when(F.col("component_id").isNull() & (F.col("digest") == F.col("lead.digest")), F.col("lead.text_hash"))
    return rows.select("doc_id", "text_hash", "n_shingles", "digest"), held.select("digest", "component").join(names, "component").select("digest", "component_id", lead.alias("lead"))


def near_components(docs: DataFrame, key: str = "doc_id", text: str = "text", share: int = SHARE) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, stays) of every row; component_id is null where no row of the component has an id.

    stays: the row stands for its component: it has the component's id, or (in one without any id) the text that leads it, or no words.
    """
    rows, names = classified(docs, key, text, share)
    out = rows.join(names, "digest", "left")
    lone = F.col("n_shingles") == 0
    component = F.when(lone, F.col("doc_id")).otherwise(F.col("component_id"))
    stays = lone | (F.col("doc_id") == F.col("component_id")) | (F.col("doc_id").isNull() & (F.col("text_hash") == F.col("lead")))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), F.coalesce(stays, F.lit(False)).alias("stays"))


def op8_near_dedup(spark, sf_dir: str) -> DataFrame:
    out = near_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stand for their component, one for each; all columns of docs, whatever their names.

    That is the row with the smallest id; where no row of a component has an id, one row of one of its texts. Rows of documents
    without words all stay. Where rows repeat (in id and text), one of them stays.
    """
    staying = near_components(docs, key, text).filter("stays and n_shingles > 0").groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"))
    staying = staged(staying, "near-kept")
    body = text_or_empty(text)
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(f"`{key}`").cast("long").alias("__id"), F.xxhash64(body).alias("__hash"), F.regexp_like(body, F.lit(r"[^\x20\x09-\x0D]")).alias("__words"))
    on = F.col("__id").eqNullSafe(F.col("doc_id")) & (F.col("__hash") == F.col("text_hash"))
    single = held.filter("__words").join(small_side(staying.filter("n = 1").drop("n")), on, "left_semi")
    again = held.filter("__words").join(small_side(staying.filter("n > 1").drop("n")), on, "left_semi").dropDuplicates(["__id", "__hash"])
    return single.union(again).union(held.filter("not __words")).select("__row.*")
