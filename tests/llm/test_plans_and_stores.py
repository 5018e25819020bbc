"""Cases of sharding, mixing and stores that earlier tests left out."""

import random
from collections import Counter, defaultdict

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from marketloom.llm import common, mixing, sharding


def test_many_rows_without_an_id(spark):
    rows = [(None if i % 4 else i, f"text {i}" * (i % 9)) for i in range(4_000)]
    docs = spark.createDataFrame(rows, "rec long, text string")
    out = sharding.shard(docs, common.shared_path(spark, "maps-null"), 4, key="rec").collect()
    loads, slots = Counter(), defaultdict(list)
    for r in out:
        loads[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert len(out) == 4_000 and max(loads.values()) < 1.06 * min(loads.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_plan_by_brute_force(spark):
    rng = random.Random(6)
    stats = [(i, rng.choice([rng.randrange(1, 90), 50]), 1) for i in range(300)]
    plan = {r.virtual_slot: r.shard for r in sharding.plan_map(spark.createDataFrame(stats, "virtual_slot int, slot_bytes long, slot_rows long"), 7).collect()}
    loads, want = [0] * 7, {}
    for slot, size, _ in sorted(stats, key=lambda x: (-x[1], x[0])):
        want[slot] = loads.index(min(loads))
        loads[want[slot]] += size
    assert plan == want


def test_entropy_beside_a_tiny_source(spark):
    rows = [(i, "x" * 900 if i < 1_990 else "y", "big" if i < 1_990 else "tiny") for i in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs, target_entropy=0.6)
    reads = {r.source: r["count"] for r in out.groupBy("__row.source").count().collect()}
    assert reads["big"] == 1_990 and 10 <= reads["tiny"] <= 20
    calm = mixing.mix(docs, target_entropy=1e-9).agg(F.max("epoch")).first()[0]
    assert calm == 1


def test_plan_beyond_the_broadcast(spark, monkeypatch):
    rows = [(None if i % 3 == 0 else i, f"long {i} " * (100_000 if i == 5 else i % 7), f"s{i % 5}" if i % 11 else None) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    read = lambda: Counter(tuple(r) for r in mixing.mix(docs).select("__row.doc_id", F.md5("__row.text"), "__row.source", "epoch", "__block", "block_rank", "weight", "alpha").collect())
    small = read()
    monkeypatch.setattr(mixing, "MOST_BROADCAST_BYTES", 0)
    assert read() == small and len({k[:3] for k in small}) == len({(a, t, s) for a, t, s in rows})
    assert docs.filter("doc_id IS NULL").count() > 200 and len({k[4] for k in small if k[0] is None}) > 20


def test_store_names(tmp_path):
    assert common.store_of(f"file://{tmp_path}/a")[1] == f"{tmp_path}/a"
    try:
        store, path = common.store_of("s3a://bucket/some/folder?region=us-east-1&endpoint_override=localhost:1")
    except (OSError, NotImplementedError) as e:  # Arrow without S3
        pytest.skip(str(e))
    assert isinstance(store, fs.S3FileSystem) and path == "bucket/some/folder"
