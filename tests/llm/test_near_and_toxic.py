"""Near-duplicates against brute force, toxicity on held-out rows, and the pipeline against its own stages by brute force."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketloom.llm import mixing, near_dedup, packing, quality_rules, toxicity
from marketloom.llm.components import connected_components


def shingles(text):
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())


class Groups:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        a, b = sorted((self.find(x), self.find(y)))
        self.up[b] = a


def brute(rows):
    sets, groups = [(i, shingles(t)) for i, t in rows], Groups()
    for k, (i, s) in enumerate(sets):
        groups.find(i)
        for j, t in sets[:k]:
            if s and t and 100 * len(s & t) >= 85 * len(s | t):
                groups.join(i, j)
    return {i: (len(s), groups.find(i)) for i, s in sets}


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 120)] + [(1, k) for k in range(1000, 1300)] + [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(350)] + [(7, 7)]
    groups = Groups()
    for a, b in edges:
        groups.join(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: groups.find(x) for e in edges for x in e if len(set(e)) == 2 or x in got}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def family(spark):
    """A family of near copies around the threshold, exact copies, short and empty texts."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(4000)}" for _ in range(150)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i + 10, " ".join(words)))
    rows += [(1000 + i, rows[3][1].upper()) for i in range(5)] + [(2000, None), (2001, ""), (2002, " \n"), (2003, "one"), (2004, "ONE"), (2005, "one two"), (2006, "one  two"), (2007, "é É x"), (2008, "é É X")]
    rows += [(3000 + i, " ".join(f"r{rng.randrange(500)}" for _ in range(rng.randrange(3, 300)))) for i in range(60)]
    rows += [(4000, " ".join(f"long{i}" for i in range(30_000))), (4001, " ".join(f"long{i}" for i in range(30_000)) + " more")]
    return rows


def test_near_brute_force(spark, family):
    docs = spark.createDataFrame([(*r, 1, "x") for r in family], "doc_id long, text string, cls int, bucket string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_components(docs).collect()}
    assert got == brute(family)
    kept = near_dedup.keep_one(docs.union(docs.filter("doc_id < 20")))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in got.items() if i == c)


def test_near_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_components(docs).count() == 0
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_components(only).collect()} == {(1, 0, 1), (2, 0, 2)}


def test_near_null_ids_and_clashing_names(spark):
    """Null ids are linked like others and name nothing; keep_one leaves one row of each component and every column."""
    same, near, alone, none = "a b c d e f g h i j", " ".join(f"n{i}" for i in range(60)), "only null ids have this text here", "another one of null ids only today"
    rows = [(1, same), (2, same), (None, same), (3, near), (None, near + " tail"), (4, near + " tail end"), (None, alone), (None, alone), (None, none), (None, ""), (5, None), (None, " ")]
    docs = spark.createDataFrame([(*r, "x", b"y", i) for i, r in enumerate(rows)], "doc_id long, text string, __id string, __hash binary, n long")
    got = {(r.doc_id, r.text_hash): r.component_id for r in near_dedup.near_components(docs).collect()}
    ids = {i: c for (i, _), c in got.items() if i is not None}
    assert ids == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5}
    assert sorted((c is None, c or 0) for (i, _), c in got.items() if i is None) == [(False, 1), (False, 3), (True, 0), (True, 0), (True, 0), (True, 0)]
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    left = kept.collect()
    assert sorted(r.text or "" for r in left) == sorted([same, near, alone, none, "", "", " "])
    assert {r.doc_id for r in left} == {1, 3, 5, None} and all(r["__id"] == "x" and r["__hash"] == b"y" for r in left)


def test_near_ties_and_repeats(spark, monkeypatch):
    """Repeated rows, one id with two texts, and joins that shuffle where sides are broadcast elsewhere."""
    long = " ".join(f"k{i}" for i in range(100))
    rows = [(1, long), (1, long), (1, "quite another text of six words"), (2, long + " z"), (3, "quite another text of six words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    from marketloom.llm import common

    for most in (common.MOST_BROADCAST_BYTES, 0):
        monkeypatch.setattr(near_dedup, "small_side", lambda df, most=most: common.small_side(df, most))
        got = near_dedup.near_components(docs).collect()
        assert len(got) == 5 and all(r.component_id == 1 for r in got)
        assert sorted(r.text for r in near_dedup.keep_one(docs).collect()) == sorted([long, "quite another text of six words"])


def test_near_recall_on_given_tables(spark):
    """All links of a given table, worked out by an inverted index of shingles, give the same components."""
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    sets, by, groups = {}, defaultdict(list), Groups()
    for i, t in rows:
        sets[i] = shingles(t)
        groups.find(i)
        common = Counter(j for x in sets[i] for j in by[x])
        for j, n in common.items():
            if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                groups.join(i, j)
        for x in sets[i]:
            by[x].append(i)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.op8_near_dedup(spark, sf).collect()}
    assert got == {i: (len(s), groups.find(i)) for i, s in sets.items()}


def test_odd_sketch_estimates():
    rng = np.random.default_rng(2)
    for share in (0.95, 0.85, 0.7):
        union = rng.integers(0, 2**63, 4000, dtype=np.uint64)
        both = int(share * 4000)
        a, b = np.concatenate([union[:both], union[both : (both + 4000) // 2]]), np.concatenate([union[:both], union[(both + 4000) // 2 :]])
        x, y = near_dedup.odd_sketch(np.array([near_dedup.samples(a), near_dedup.samples(b)]))
        bits = sum(bin(int(p) & (2**64 - 1)).count("1") for p in x ^ y)
        m, k = near_dedup.BITS, near_dedup.SAMPLES
        estimate = 1 + m / (4 * k) * math.log(max(1e-9, 1 - 2 * bits / m))
        assert abs(estimate - share) < 0.1


WORDS = "the of and to in that it was for on are as with his they at be this from have".split()
BAD = "grumblesnark fizzlewretch".split()


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(1500):
        words = ["".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 3))) for _ in range(rng.randrange(40, 200))]
        bad = rng.random() < 0.15
        if bad:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(BAD)
        docs.append((i, " ".join(words), "en", "s", 1.0))
        labels.append((i, 1, int(bad)))
    docs += [(9000, None, "en", "s", 1.0), (9001, "", "en", "s", 1.0)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, difference double"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_held_out(labelled):
    docs, labels = labelled
    model = toxicity.train(docs, labels)
    out = toxicity.score(docs, *model).join(labels, "doc_id", "left").collect()
    assert len(out) == 1502 and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and r.toxic is not None]
    assert sum(r.score >= 0.3 for r in held if r.toxic) >= 0.9 * sum(r.toxic for r in held)
    assert sum(r.score >= 0.3 for r in held if not r.toxic) <= 0.03 * len(held)
    assert all(r.score < 0.3 for r in out if r.doc_id >= 9000)
    # Held-out labels play no part.
    flipped = labels.withColumn("toxic", F.when(toxicity.remainder() == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.score(docs, *toxicity.train(docs, flipped)).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in out)
    kept = toxicity.keep_ordinary(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in out if r.score < 0.3}


def test_toxicity_without_labels(labelled):
    docs, labels = labelled
    for few in (labels.limit(0), labels.withColumn("toxic", F.lit(0))):
        out = toxicity.score(docs, *toxicity.train(docs, few)).collect()
        assert len(out) == 1502 and all(r.score < 1e-6 for r in out)
    assert toxicity.score(docs.limit(0), *toxicity.train(docs, labels)).count() == 0


def test_tables_equal_dictionaries():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**40, 5000, dtype=np.uint64))
    t = toxicity.Table(keys, np.arange(len(keys), dtype=np.float32) + 1)
    asked = np.concatenate([keys[::3], rng.integers(0, 2**40, 2000, dtype=np.uint64)])
    want = dict(zip(keys.tolist(), range(1, len(keys) + 1)))
    assert t.get(asked).tolist() == [want.get(k, 0) for k in asked.tolist()]


def test_toxicity_cases(spark, labelled):
    """Repeated rows, null ids, a very long text and clashing names."""
    docs, labels = labelled
    model, curve = toxicity.train(docs, labels)
    bad = "the of and " * 20 + "grumblesnark fizzlewretch grumblesnark " + "in that it " * 20
    extra = spark.createDataFrame([(None, bad), (None, "the of and to in that"), (1, "the of and"), (1, "the of and"), (8, "that it was for " * 200_000)], "doc_id long, text string")
    out = toxicity.score(extra, model, curve).collect()
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append(r.score)
    assert max(by[None]) >= 0.3 > min(by[None]) and len(set(by[1])) == 1 and len(by[1]) == 2 and by[8][0] < 0.3
    named = docs.withColumns({"__text": F.lit(1), "__whole": F.lit(2), "__row": F.lit(3)})
    kept = toxicity.keep_ordinary(named, labels)
    assert kept.columns == named.columns and {r["__whole"] for r in kept.collect()} == {2}
    twice = labels.union(labels.withColumn("toxic", F.lit(0)))
    again, same = toxicity.train(docs, twice)
    assert again is not None and np.allclose(same, curve)


def test_discounts():
    assert toxicity.discounts([10, 5, 2, 1]) == pytest.approx([1 - 2 * 0.5 * 5 / 10, 2 - 3 * 0.5 * 2 / 5, 3 - 4 * 0.5 * 1 / 2])
    assert toxicity.discounts([None, None, None, None]) == [0.5, 0.5, 0.5]


def test_pipeline(spark, sf):
    out = corpus_pipeline.run(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = quality_rules.apply_policy(quality_rules.ledger(docs)).filter("kept").select("doc_id")
    docs = docs.join(kept, "doc_id", "left_semi")
    scores = toxicity.score(docs, *toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet")))
    docs = docs.join(scores.filter(F.col("score") < 0.3).select("doc_id"), "doc_id", "left_semi")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    single = {i for i, (_, c) in brute(rows).items() if i == c}
    docs = docs.filter(F.col("doc_id").isin(list(single)))
    reads = Counter(r.doc_id for r in mixing.mix(docs).select("__row.doc_id").collect())
    assert set(reads) == single
    sizes = defaultdict(int)
    for r in out:
        sizes[r.doc_id] += r.length
    from tests.llm.test_text_ops import brute_ids

    text = dict(rows)
    assert sizes == {i: n * (len(brute_ids(text[i])) + 1) for i, n in reads.items()}
    assert len({r.sequence_id for r in out}) == len(out) and packing.MOST == 2048


def test_pipeline_stages_on_odd_rows(spark, sf):
    """Nulls in any column, empty and very long texts, repeated rows, an empty table, and columns with clashing names, for every stage."""
    rng = random.Random(8)
    prose = lambda k: " ".join(f"word{rng.randrange(5000)}" for _ in range(k))
    one = prose(60)
    texts = [(1, one), (1, one), (2, one), (None, one), (None, prose(50)), (3, None), (4, ""), (5, prose(30_000)), (6, prose(40)), (7, prose(45))]
    rows = [(i, t, [None, "en"][k % 2], [None, "a", "b"][k % 3], len(t or ""), k, "x", 1.5, "b") for k, (i, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, epoch int, __row string, __whole double, __block string")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        kept[name] = [(r.doc_id, getattr(r, "text", None)) for r in out.collect()]
        if name != "packing":
            assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), sf).count() == 0, name
    assert {i for i, _ in kept["quality rules"]} <= {1, 2, None, 5, 6, 7} and len(kept["toxicity"]) <= len(rows)
    assert Counter(i for i, _ in kept["near-duplicates"]) == Counter([1, None, 3, 4, 5, 6, 7])
    assert {i for i, _ in kept["mixing"]} == {i for i, _ in texts} and {i for i, _ in kept["packing"]} == {i for i, _ in texts}


def brute_discount(counts):
    n = Counter(x for x in counts if x)
    d = toxicity.discounts([n[k] for k in (1, 2, 3, 4)])
    return lambda x: 0.0 if x == 0 else d[min(x, 3) - 1]


def brute_model(texts: list[tuple[int, str]]) -> dict:
    """Differences of 5-grams, worked out one at a time; every 5-gram counts."""
    n = [Counter(), Counter()]
    for toxic, text in texts:
        n[1 - toxic].update(toxicity.codes(text).tolist())
    every = set(n[0]) | set(n[1])
    low = {w: {c & ((1 << 8 * w) - 1) for c in every} for w in range(1, 6)}
    shared = {0: {0: 1 / 256}}
    for w in range(1, 5):
        count = Counter(c & ((1 << 8 * w) - 1) for c in low[w + 1])
        cut = brute_discount(count.values())
        total, gap = Counter(), Counter()
        for c, k in count.items():
            total[c >> 8] += k
            gap[c >> 8] += cut(k)
        shared[w] = {c: (k - cut(k) + gap[c >> 8] * shared[w - 1][c & ((1 << 8 * (w - 1)) - 1)]) / total[c >> 8] for c, k in count.items()}
    n.append(n[0] + n[1])
    cuts = [brute_discount(x.values()) for x in n]
    total, gap = [Counter(), Counter(), Counter()], [Counter(), Counter(), Counter()]
    for k in (0, 1, 2):
        for c in n[k]:
            total[k][c >> 8] += n[k][c]
            gap[k][c >> 8] += cuts[k](n[k][c])
    out = {}
    for c in every:
        x = c >> 8
        s = (n[2][c] - cuts[2](n[2][c]) + gap[2][x] * shared[4][c & 0xFFFFFFFF]) / total[2][x]
        logs = [math.log((n[k][c] - cuts[k](n[k][c]) + (gap[k][x] + 1) * s) / (total[k][x] + 1)) for k in (0, 1)]
        out[c] = logs[0] - logs[1]
    return out


def test_model_keeps_every_ngram(labelled, monkeypatch):
    """Differences equal the formula over all 5-grams, whether the model is broadcast or a table that is larger than may be broadcast."""
    docs, labels = labelled
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = brute_model([(toxic[i], t) for i, t in texts.items() if i in toxic and zlib.crc32(str(i).encode()) % 4 < 2])
    scores = []
    for most in (toxicity.MOST_BROADCAST, 100):
        monkeypatch.setattr(toxicity, "MOST_BROADCAST", most)
        monkeypatch.setattr(toxicity, "BLOCK", 20_000)
        model, curve = toxicity.train(docs, labels)
        assert (most == 100) == isinstance(model, type(docs))
        got = {r.doc_id: (r["__whole"], r["__passage"]) for r in toxicity.differences(docs.select("doc_id", "text"), model).collect()}
        assert len(got) == len(texts) and got[9000] == got[9001] == (0, 0)
        for i in list(texts)[:60]:
            worth = [want.get(c, 0.0) for c in toxicity.codes(texts[i]).tolist()]
            best = max(sum(worth[k : k + toxicity.PASSAGE]) for k in range(len(worth) - toxicity.PASSAGE + 1)) / toxicity.PASSAGE
            assert abs(got[i][0] - sum(worth) / len(worth)) < 1e-5 and abs(got[i][1] - best) < 1e-5
        scores.append({r.doc_id: r.score for r in toxicity.score(docs, model, curve).collect()})
        if most == 100:
            assert {r.doc_id for r in toxicity.keep_ordinary(docs, labels).collect()} == {i for i, s in scores[-1].items() if s < 0.3}
    assert all(abs(scores[0][i] - scores[1][i]) < 1e-6 for i in texts)


def test_passages_from_every_byte():
    """An expression counts in full wherever it lies in a text, and in a text that is shorter than a passage."""
    bad, pad = "grumblesnark", "x"
    inner = [int(c) for c in toxicity.codes(f"{pad * 9}{bad}{pad * 9}") if b"\n" not in int(c).to_bytes(5, "big") and int(c).to_bytes(5, "big") != b"xxxxx"]
    model = toxicity.Model(pa.table({"codes": pa.array([], pa.list_(pa.int64())), "differences": pa.array([], pa.list_(pa.float32()))}))
    model.seen = toxicity.Table(np.unique(np.array(inner, dtype=np.uint64)), np.ones(len(set(inner)), dtype=np.float32))
    assert {model.differences(pad * k + bad + pad * 600)[1] for k in range(4, 600, 3)} == {1.0}
    whole, passage = model.differences("grum")
    assert whole == passage == 0 and model.differences("") == (0.0, 0.0)
    assert model.differences("xgrumb")[0] == model.differences("xgrumb")[1] > 0
