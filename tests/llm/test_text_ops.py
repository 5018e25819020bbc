"""Quality rules, mixing, sharding, packing, token counts and licence scans."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.llm import licenses, mixing, packing, quality_rules, sharding, subwords, token_counts
from tests.oracle import same

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("shard", T.IntegerType())])

LONG = " ".join(f"w{i % 5000}" for i in range(30_000))
TEXTS = [
    None, "", " ", "\n\n", "a", "one two", "x  y\n z\t \nq   ", " lead", "trail \n", "tab\t \nend", "é ü   x 　 y", "<|endoftext|> in <|endoftext|>text",
    "line of words\nline of words\nother\nline of words", "a b c d e f g h i a b c d e f g h", "spam " * 40, LONG, "same text here", "same text here",
    "The MIT License; the Apache License, GNU General Public License and CC-BY. cc by mit license", "K" * 5000, "𝔘nicode 😀 👩‍👩‍👧", "it's we'll I'd 12345 foo123bar !!! ###",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 4 else None, t, "en", ["a", "b", None][i % 3], i, i) for i, t in enumerate(TEXTS)] + [(1, "", "en", "a", 1, 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return (text or "").encode("utf-8", "surrogatepass").replace(b"\x0b", b" ").split()


def repeated(w):
    places = defaultdict(list)
    for i in range(len(w) - 7):
        places[tuple(w[i : i + 8])].append(i)
    return len({i + k for own in places.values() if len(own) > 1 for i in own for k in range(8)})


def test_quality_brute_force(docs):
    rows = quality_rules.apply_policy(quality_rules.ledger(docs.select("doc_id", "text"))).collect()
    assert len(rows) == docs.count()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    for r in docs.collect():
        x, w, t = by[r.doc_id][0], words(r.text), r.text or ""
        lines = [ln for ln in t.split("\n") if words(ln)]
        assert (x.n_words, x.word_chars, x.n_dup_lines, x.n_repeat_words) == (len(w), sum(len(v.decode("utf-8", "surrogatepass")) for v in w), len(lines) - len(set(lines)), repeated(w))
        assert x.n_symbols == sum(t.count(c) for c in "#*$%&|<>")
        assert bool(x.failed_bits & 3) == (len(w) < 20 or 100 * x.n_repeat_words > 30 * len(w))
        assert x.kept == (x.failed_bits == 0)


def test_quality_policies_and_ablation(docs):
    held = quality_rules.ledger(docs.select("doc_id", "text"))
    one, two = (quality_rules.apply_policy(held, quality_rules.POLICIES[v]).filter("kept").count() for v in (1, 2))
    assert one >= two
    table = {r.rule: r for r in quality_rules.ablations(held).collect()}
    assert set(table) == set(quality_rules.RULES)
    for name, r in table.items():
        less = quality_rules.Policy(9, tuple(x for x in quality_rules.RULES if x != name))
        assert r.kept_with == two and r.kept_without == quality_rules.apply_policy(held, less).filter("kept").count()
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns and kept.count() == two


def test_quality_oracle(spark, sf):
    assert same(quality_rules.op10_quality_rules(spark, sf), quality_rules.OP10_SQL, sf) > 0


def test_mixing_oracle(spark, sf):
    assert same(mixing.op4_mixing(spark, sf), mixing.OP4_SQL, sf) > 0


def test_mixing_limits(spark):
    rows = [(i, "x" * 400, "big" if i < 900 else f"s{i % 3}", "en") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, weight string")
    out = mixing.mix(docs)
    reads = {r.source: r["count"] for r in out.groupBy("__row.source").count().collect()}
    assert reads["big"] == 900  # the largest source is read whole once
    assert all(1.9 <= reads[s] / n <= 2.0 for s, n in (("s0", 34), ("s1", 33), ("s2", 33)))
    alpha = out.select("alpha").first().alpha
    assert (90000 / 3300) ** (1 - alpha) <= 2.0 < (90000 / 3300) ** (1 - alpha + 2e-6)
    totals = spark.createDataFrame([(90000,), (3400,), (3300,), (3300,)], "total long")
    a = mixing.exponent(totals, None, 1.0)
    w = np.array([90000, 3400, 3300, 3300.0]) ** a
    w /= w.sum()
    assert abs(-(w * np.log(w)).sum() - 1.0) < 1e-4


def test_mixing_cases(docs, empty):
    out = mixing.mix(docs)
    assert {r.d for r in out.select(F.col("__row.n_words").alias("d")).distinct().collect()} == {r.n_words for r in docs.collect()}
    assert mixing.mix(empty).count() == 0


def test_sharding(docs, empty, spark, sf):
    rows = sharding.slotted(docs).cache()
    stats = sharding.slot_stats(rows)
    for n in (1, 3, 7):
        plan = sharding.plan_map(stats, n)
        out = sharding.assign(rows, plan, stats).collect()
        assert len(out) == docs.count()
        by = defaultdict(list)
        for r in out:
            by[r.shard].append(r.slot)
        assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(n))
    crc = Counter(zlib.crc32((r.text or "").encode()) for r in docs.collect())
    assert crc == Counter(r.text_crc32 for r in out)
    assert sharding.assign(sharding.slotted(empty), sharding.plan_map(sharding.slot_stats(sharding.slotted(empty)), 3), sharding.slot_stats(sharding.slotted(empty))).count() == 0
    real = sharding.op7_sharding(spark, sf).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in real) == want
    loads, largest = Counter(), Counter()
    for r in real:
        loads[r.shard] += r["size"]
        largest[r.virtual_slot] += r["size"]
    assert set(loads) == set(range(40)) and max(loads.values()) - min(loads.values()) <= max(largest.values())


def test_sharding_stored_maps(spark):
    """A stored map is used again, and edited when shards or data change."""
    from marketloom.llm.common import shared_path

    folder = shared_path(spark, "maps-test")
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 90).cast("int")).alias("text"))
    one = {r.doc_id: (r.shard, r.version) for r in sharding.shard(docs, folder, 8).collect()}
    two = {r.doc_id: (r.shard, r.version) for r in sharding.shard(docs, folder, 8).collect()}
    assert one == two and {v for _, v in one.values()} == {1}
    more = sharding.shard(docs, folder, 9).collect()
    assert {r.version for r in more} == {2} and {r.shard for r in more} == set(range(9))
    assert sum(one[r.doc_id][0] != r.shard for r in more) < 0.2 * len(more)
    assert sharding.load_map(spark, folder, 1).count() == sharding.load_map(spark, folder).count() and sharding.load_map(spark, folder + "-none") is None
    same = docs.filter("doc_id < 3").union(docs.filter("doc_id < 3"))
    assert sorted((r.shard, r.slot) for r in sharding.shard(same, shared_path(spark, "maps-few"), 1).collect()) == [(0, i) for i in range(6)]
    assert sharding.shard(docs.limit(0), shared_path(spark, "maps-none"), 3).count() == 0


def test_sharding_edit(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    slotted = sharding.slotted(rows, n_slots=512).cache()
    stats = sharding.slot_stats(slotted)
    old = sharding.plan_map(stats, 10).cache()
    new = sharding.edit_map(old, stats, 11).cache()
    assert new.count() == old.count() and new.select("version").distinct().collect()[0].version == 2
    moved = old.alias("a").join(new.alias("b"), "virtual_slot").filter("a.shard <> b.shard").select("b.shard").collect()
    to = Counter(r.shard for r in moved)
    assert to[10] > 0.8 * len(moved) and len(moved) < 512 / 6  # little else moves
    loads = [r.b for r in sharding.assign(slotted, new, stats).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(loads) == 11 and max(loads) < 1.1 * min(loads)


def brute_ids(text):
    return subwords.tokenizer().encode(text or "", add_special_tokens=False).ids


def test_packing(docs, empty):
    by = defaultdict(list)
    out = packing.pack(docs).collect()
    assert len({r.sequence_id for r in out}) == len(out)
    for r in out:
        by[r.doc_id, r.doc_tokens].append(r)
    assert all(r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 2048 for r in out)
    for r in docs.filter("doc_id <> 1").collect():
        ids = np.array([*brute_ids(r.text), 1], dtype="<u4")
        own = sorted(by[r.doc_id, len(ids)], key=lambda x: x.start)
        assert [x.length for x in own] == packing.lengths(len(ids))
        assert [x.ids_crc32 for x in own] == [zlib.crc32(ids[x.start : x.start + x.length].tobytes()) for x in own]
    numbers = defaultdict(list)
    for r in out:
        numbers[r.length].append(r.sequence_id & (2**56 - 1))
    assert all(sorted(v) == list(range(len(v))) for v in numbers.values())
    assert packing.pack(empty).count() == 0


def test_token_counts(docs, empty, spark, sf, monkeypatch):
    for frame in (docs, spark.read.parquet(f"{sf}/documents.parquet")):
        want = Counter((r.doc_id, len((r.text or "").encode()), len(brute_ids(r.text))) for r in frame.collect())
        got = Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(frame).collect())
        assert got == want
    assert token_counts.count_tokens(empty).count() == 0


def test_pieces_join_and_agree():
    for text in filter(None, TEXTS):
        assert "".join(subwords.pieces(text)) == text
        assert list(subwords.encode([text])[0]) == brute_ids(text)
        assert subwords.count(subwords.pieces(text)).sum() == len(brute_ids(text))


def test_licenses(docs, empty):
    out = {r.doc_id: r for r in licenses.scan_documents(docs).collect()}
    for r in docs.collect():
        w = [x.decode("utf-8", "surrogatepass") for x in licenses.words_of(r.text)]
        places = [(i, lab) for p, lab in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        x = out[r.doc_id]
        assert (x.n_words, x.n_base) == (len(w), len(places))
        assert x.base_labels == ",".join(sorted({lab for _, lab in places}))
        assert (x.first_word, x.last_word) == ((min(p)[0], max(p)[0]) if (p := places) else (None, None))
        assert 0 <= x.score <= 1
    assert licenses.scan_documents(empty).count() == 0


def test_license_statistics_brute_force():
    automaton, _ = licenses.scanner()
    templates = list(automaton.templates.values())
    rng = np.random.default_rng(3)
    pool = [w for t in templates for w in t] + [b"zzz"]
    text = [pool[i] for i in rng.integers(0, len(pool), 300)] + templates[0][5:40] + [b"zzz"] + templates[2][:20]
    got = dict.fromkeys(range(len(text)), 0) | {at: n for at, _, n in automaton.statistics(text)}
    for at in range(len(text)):
        n = 0
        while n <= at and any(text[at - n : at + 1] == t[i : i + n + 1] for t in templates for i in range(len(t))):
            n += 1
        assert got[at] == n


def test_license_chains():
    text = [w.decode() for w in licenses.words_of(licenses.TEXTS["mit-text"])]
    n = len(text)
    whole = licenses.scan("intro words " + licenses.TEXTS["mit-text"] + " tail")
    assert "mit-text" in whole["labels"] and ("mit-text", 2, n + 1, n) in whole["spans"] and whole["score"] == 1
    edited = text[:20] + ["changed"] + text[21:40] + ["also", "here"] + text[40:]
    assert "mit-text" in licenses.scan(" ".join(edited))["labels"]
    assert "mit-text" not in licenses.scan(" ".join(text[:15]))["labels"]
    # Two copies, and one after many shuffled passages of the same text.
    two = licenses.scan(" ".join(text + ["other"] * 30 + text))
    assert [x[:3] for x in two["spans"] if x[0] == "mit-text"] == [("mit-text", 0, n - 1), ("mit-text", n + 30, 2 * n + 29)]
    mixed = [w for k in range(40) for w in text[k * 3 % n : k * 3 % n + 5]]
    assert any(x[0] == "mit-text" and x[3] >= n - 8 for x in licenses.scan(" ".join(mixed + text))["spans"])
    tag = licenses.scan("# SPDX-License-Identifier: Apache-2.0")
    assert tag["labels"] == ["spdx:apache-2.0"] and tag["score"] == 1 and tag["base_labels"] == []
    assert {"cc-by-text"} <= set(licenses.scan(licenses.TEXTS["cc-by-text"])["labels"])


def test_license_chains_brute_force():
    """The best chain of each template has the most covered words of all chains of its runs, worked out by trying them all."""
    rng = np.random.default_rng(7)
    for _ in range(60):
        runs, at = [], 0
        for _ in range(rng.integers(1, 7)):
            at += int(rng.integers(1, 9))
            length = int(rng.integers(4, 7))
            runs.append((at + length, length, {"t": sorted({int(x) for x in rng.integers(5, 30, rng.integers(1, 3))})}))
        best = 0

        def extend(k, last, upto, covered):
            nonlocal best
            best = max(best, covered)
            for j in range(k, len(runs)):
                end, length, where = runs[j]
                for position in where["t"]:
                    overlap = max(0, last - (end - length), upto - (position - length))
                    if last < end and upto < position and overlap < length and (covered == 0 or last >= end - length - licenses.MOST_GAP):
                        extend(j + 1, end, position, covered + length - (overlap if covered else 0))

        extend(0, -99, -99, 0)
        assert max(x[3] for x in licenses.chained(runs)) == best


def test_licenses_repeats_and_own_texts(spark):
    docs = spark.createDataFrame([(None, "alpha beta gamma delta epsilon"), (None, "alpha beta gamma delta epsilon"), (1, "x " * 300_000 + "cc by")], "doc_id long, text string")
    out = licenses.scan_documents(docs, texts={"own": "Alpha, beta gamma: delta epsilon!"}).collect()
    assert [r.labels for r in out if r.doc_id is None] == ["own", "own"] and [(r.n_words, r.first_word, r.labels) for r in out if r.doc_id] == [(300_002, 300_000, "cc-by")]
