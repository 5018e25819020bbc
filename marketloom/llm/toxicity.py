"""Toxicity by class-conditional Kneser-Ney models.

Two models of byte 5-grams, one of toxic and one of ordinary labelled texts, discount their own counts and back off to one
distribution that both share: 5-grams of both classes together, which back off to the Kneser-Ney continuation counts of shorter
contexts. Discounts are estimated from counts of counts, for each class and for the shared counts. In every context a class also gets
PRIOR counts of the shared distribution, so where it has hardly seen an expression the shared part decides and rare expressions weigh
little; a byte that neither class has seen after a context says nothing.

A text's score compares the two log-likelihoods for each byte, of the whole text and of its most toxic passage of PASSAGE bytes (from
every byte on; a shorter text is one passage), so that a few words count alike in a short text and in a very long one. A logistic
curve over both turns them into a probability.

Counts cover every labelled training row and every 5-gram of it, and are summed in Spark (tasks sum first); the model is a table of
contexts that is worked out from them by equality joins and windows of at most 256 rows, and it grows with what was counted. A model of
at most MOST_BROADCAST 5-grams is broadcast (about 20 MB); a larger one stays a table, and texts meet it by a shuffle: texts are
laid into blocks of about BLOCK bytes, the contexts of each block are joined to the model, and the block is scored with its own part of
it. Both ways give the same differences. Labelled rows whose crc32(doc_id) mod 4 is 0 or 1 give counts and those with 3 the
calibration, so it sees scores of texts that the model has not seen; rows with 2 are held out. Labels, language, source and id are no
input of a score.

Defined cases. Null and empty texts score as the calibration says of no evidence (differences 0). Repeated rows repeat. A doc_id with
several labels is toxic if one of them is. A row with a null id is scored like any other, is never learned from and isn't held out. Very
long texts are scored whole, one at a time. Ties don't matter: nothing is ranked. Extra columns are not read, whatever their names.
Without labels of both classes every score is the share of toxic labels (0 without any). An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

from marketloom.llm.common import gives_back, small_side, staged, table

ORDER = 5
#: Entries of a model that is broadcast, and bytes of text that share one part of a larger model.
MOST_BROADCAST = 1 << 19
BLOCK = 4 << 20
#: Counts of the shared distribution that every context of a class is given.
PRIOR = 1.0
PASSAGE = 12
THRESHOLD = 0.3
#: Steps of the differences (whole text, passage) at which calibrating rows are summed, and the number of steps to either side.
STEPS, MOST_STEPS = (0.005, 0.03), (64, 128)
DIFFERENCES = ["__whole", "__passage"]
_U = np.uint64


def codes(text: str | None) -> np.ndarray:
    """5-grams of a text's lower-cased UTF-8, as numbers; a line break is put before and after the text."""
    data = np.frombuffer(b"\n" * (ORDER - 1) + (text or "").lower().encode("utf-8", "surrogatepass") + b"\n", dtype=np.uint8).astype(np.uint64)
    out = np.zeros(len(data) - ORDER + 1, dtype=np.uint64)
    for i in range(ORDER):
        out = (out << _U(8)) | data[i : len(data) - ORDER + 1 + i]
    return out


@gives_back
def _count(batches):
    for batch in batches:
        toxic = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
        texts = batch.column(1)
        for kind in (False, True):
            held, size = [], 0
            own = np.flatnonzero(toxic == kind)
            for k, i in enumerate(own):
                held.append(codes(texts[int(i)].as_py()))
                size += len(held[-1])
                if size > 2_000_000 or k == len(own) - 1:
                    code, n = np.unique(np.concatenate(held), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(n * kind), pa.array(n * (not kind))], names=["code", "n_toxic", "n_plain"])
                    held, size = [], 0


class Table:
    """Numbers to values: open addressing, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(10, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.keys = np.full(1 << self.bits, np.iinfo(np.uint64).max, dtype=np.uint64)
        self.values = np.zeros(1 << self.bits, dtype=np.float32)
        self.probes, left = 0, np.arange(len(keys))
        while len(left):
            slots = (self._slot(keys[left]) + self.probes) & ((1 << self.bits) - 1)
            free = self.keys[slots] == np.iinfo(np.uint64).max
            _, firsts = np.unique(np.where(free, slots, -1), return_index=True)
            firsts = firsts[free[firsts]]
            self.keys[slots[firsts]], self.values[slots[firsts]] = keys[left[firsts]], values[left[firsts]]
            left = np.delete(left, firsts)
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values (0 if absent)."""
        slots = self._slot(keys)
        empty = np.iinfo(np.uint64).max
        found = self.keys[slots]
        missed = found != keys
        out = np.where(missed, np.float32(0), self.values[slots])
        left = np.flatnonzero(missed & (found != empty))  # a search ends at a free slot
        for probe in range(1, self.probes):
            if not len(left):
                break
            at = (slots[left] + probe) & ((1 << self.bits) - 1)
            found = self.keys[at]
            hit = found == keys[left]
            out[left[hit]] = self.values[at[hit]]
            left = left[~hit & (found != empty)]
        return out


def counts_of_counts(n) -> list[Column]:
    """How often a count is 1, 2, 3 and 4."""
    return [F.sum((n == k).cast("long")) for k in (1, 2, 3, 4)]


def discounts(seen: list[int | None]) -> list[float]:
    """Discounts of counts 1, 2 and 3 or more, from how many counts are 1, 2, 3 and 4 (modified Kneser-Ney).

    Where a small corpus has too few to estimate one, it is the plain discount n1 / (n1 + 2 n2), or one half.
    """
    n = [x or 0 for x in seen]
    plain = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    return [min(k, max(0.0, k - (k + 1) * plain * n[k] / n[k - 1])) if n[k] and n[k - 1] else plain for k in (1, 2, 3)]


def discount(n, d: list[float]) -> Column:
    """What is taken off a count."""
    return F.when(n == 0, 0.0).when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])


def continuation(grams: DataFrame) -> DataFrame:
    """(gram, p): shared probability of a byte after the three before it, by Kneser-Ney continuation counts of all 5-grams."""
    counts, longer = {}, grams.select(F.col("code").alias("gram"))
    for width in range(ORDER - 1, 0, -1):
        longer = counts[width] = staged(longer.groupBy(F.col("gram").bitwiseAND((1 << 8 * width) - 1).alias("gram")).agg(F.count("*").alias("n")), f"toxic-{width}-grams")
    out = None
    for width in range(1, ORDER):
        w = Window.partitionBy(F.shiftright("gram", 8))  # at most 256 rows
        d = discounts(list(counts[width].agg(*counts_of_counts(F.col("n"))).first()))
        cut = discount(F.col("n"), d)
        c = counts[width].withColumns({"total": F.sum("n").over(w), "gap": F.sum(cut).over(w)})
        if out is None:
            c = c.withColumn("lower", F.lit(1 / 256))
        else:
            lower = out.select(F.col("gram").alias("short"), F.col("p").alias("lower"))
            # Grams of one or two bytes: at most 65,536 rows.
            c = c.join(F.broadcast(lower) if width <= 3 else lower, F.col("gram").bitwiseAND((1 << 8 * (width - 1)) - 1) == F.col("short"))
        out = c.select("gram", ((F.col("n") - cut) / F.col("total") + F.col("gap") / F.col("total") * F.col("lower")).alias("p"))
    return out


def model_table(grams: DataFrame) -> DataFrame:
    """(context, codes, differences): the 5-grams of each context, and log P(toxic) - log P(ordinary) of their last bytes.

    grams: code, n_toxic, n_plain (a staged table: it is read several times).
    """
    pooled = F.col("n_toxic") + F.col("n_plain")
    kinds = {"n_toxic": F.col("n_toxic"), "n_plain": F.col("n_plain"), "pooled": pooled}
    row = list(grams.agg(*[x for n in kinds.values() for x in counts_of_counts(n)]).first())
    d = {name: discounts(row[4 * i : 4 * i + 4]) for i, name in enumerate(kinds)}
    w = Window.partitionBy("context")  # at most 256 rows
    g = grams.withColumns({"pooled": pooled, "context": F.shiftright("code", 8), "gram": F.col("code").bitwiseAND((1 << 8 * (ORDER - 1)) - 1)}).join(continuation(grams), "gram")
    cut = discount(F.col("pooled"), d["pooled"])
    total = F.sum("pooled").over(w)
    g = g.withColumn("shared", (F.col("pooled") - cut) / total + F.sum(cut).over(w) / total * F.col("p"))
    for n in ("n_toxic", "n_plain"):
        cut = discount(F.col(n), d[n])
        g = g.withColumn(f"log_{n}", F.ln((F.col(n) - cut + (F.sum(cut).over(w) + PRIOR) * F.col("shared")) / (F.sum(n).over(w) + PRIOR)))
    rows = g.groupBy("context").agg(F.collect_list(F.struct("code", (F.col("log_n_toxic") - F.col("log_n_plain")).cast("float").alias("seen"))).alias("x"))
    return rows.select("context", F.col("x.code").alias("codes"), F.col("x.seen").alias("differences"))


def _flat(x) -> np.ndarray:
    return (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x).flatten().to_numpy(zero_copy_only=False)


class Model:
    """Log-likelihood differences of 5-grams (toxic minus ordinary), of rows of a model table."""

    def __init__(self, rows: pa.Table):
        code, at = np.unique(_flat(rows["codes"]).astype(np.uint64), return_index=True)
        self.seen = Table(code, _flat(rows["differences"])[at].astype(np.float32))

    def differences(self, text: str | None) -> tuple[float, float]:
        """log P(toxic) - log P(ordinary) for each byte of the text, and of the passage where it is largest."""
        if not text:
            return 0.0, 0.0
        sums = np.concatenate([[0.0], np.cumsum(self.seen.get(codes(text)), dtype=np.float64)])
        n = len(sums) - 1
        width = min(PASSAGE, n)
        return float(sums[-1] / n), float((sums[width:] - sums[:-width]).max() / width)


def _replaced(batch, model: Model):
    """A batch with its last column, a text, replaced by its two differences."""
    values = np.array([model.differences(x.as_py()) for x in batch.column(batch.num_columns - 1)]).reshape(-1, 2)
    return [*(batch.column(i) for i in range(batch.num_columns - 1)), *(pa.array(np.ascontiguousarray(x), pa.float64()) for x in values.T)], [*batch.schema.names[:-1], *DIFFERENCES]


@gives_back
def _differences(batches, model):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(*_replaced(batch, model.value))


@gives_back
def _blocks(batches, most: int):
    """Batches with the name of a block of texts put first."""
    name, held = uuid.uuid4().hex, 0
    for batch in batches:
        names = []
        for text in batch.column(batch.num_columns - 1):
            if held >= most:
                name, held = uuid.uuid4().hex, 0
            names.append(name)
            held += 200 + (text.as_buffer().size if text.is_valid else 0)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *batch.columns], names=["__block", *batch.schema.names])


@gives_back
def _contexts(batches):
    for batch in batches:
        held: dict[str, list] = {}
        for block, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            held.setdefault(block, []).append(np.unique(codes(text.as_py()) >> _U(8)))
        for block, parts in held.items():
            context = np.unique(np.concatenate(parts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(context), pa.string()), pa.array(context)], names=["__block", "context"])


def differences(rows: DataFrame, model) -> DataFrame:
    """rows with their last column, a text, replaced by the columns of DIFFERENCES; model is a broadcast Model or a model table."""
    schema = StructType([*rows.schema.fields[:-1], *(StructField(x, DoubleType()) for x in DIFFERENCES)])
    if not isinstance(model, DataFrame):
        return rows.mapInArrow(partial(_differences, model=model), schema)
    # Written once, so that a block keeps its name.
    named = staged(rows.mapInArrow(partial(_blocks, most=BLOCK), StructType([StructField("__block", StringType()), *rows.schema.fields])), "toxic-blocks")
    asked = named.select("__block", F.col(f"`{rows.columns[-1]}`")).mapInArrow(_contexts, "__block string, context long")
    parts = asked.join(model, "context")

    def scored(texts: pa.Table, part: pa.Table) -> pa.Table:
        return pa.Table.from_arrays(*_replaced(texts.drop_columns(["__block"]), Model(part)))

    return named.groupBy("__block").cogroup(parts.groupBy("__block")).applyInArrow(scored, schema)


def remainder(key: str = "doc_id"):
    return F.crc32(F.encode(F.col(key).cast("string"), "UTF-8")) % 4


#: Slopes of the whole text's difference and of the passage's, and the offset.
Curve = tuple[float, float, float]


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text"):
    """A model (broadcast, or its table; None without labels of both classes) and its calibration, from the labelled rows that may be learned from."""
    spark = docs.sparkSession
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("__toxic"))
    known = staged(known.withColumn("__part", remainder().cast("int")).filter("__part <> 2"), "toxic-labels")
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).join(small_side(known), "doc_id")
    counted = rows.filter("__part < 2").select("__toxic", "text").mapInArrow(_count, "code long, n_toxic long, n_plain long")
    grams = staged(counted.groupBy("code").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_plain").alias("n_plain")), "toxic-grams")
    share = known.agg(F.avg("__toxic")).first()[0] or 0.0
    if not all(grams.agg(F.sum("n_toxic"), F.sum("n_plain")).first()):
        return None, (0.0, 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    model = staged(model_table(grams), "toxic-model")
    if grams.count() <= MOST_BROADCAST:
        model = spark.sparkContext.broadcast(Model(model.toArrow()))
    later = differences(rows.filter("__part = 3").select(F.col("__toxic").alias("toxic"), "text"), model)
    step = [F.greatest(F.lit(-m), F.least(F.lit(m), F.floor(F.col(x) / s))).alias(f"at_{x}") for x, s, m in zip(DIFFERENCES, STEPS, MOST_STEPS)]
    # At most 2 * 129 * 257 rows, whatever the input.
    sums = later.groupBy("toxic", *step).agg(F.count("*").alias("n"), *[F.avg(x).alias(x) for x in DIFFERENCES]).drop("at___whole", "at___passage").toPandas()
    return model, calibrated(sums["n"].to_numpy(float), sums[DIFFERENCES].to_numpy(float), sums["toxic"].to_numpy(float), share)


def calibrated(w: np.ndarray, x: np.ndarray, y: np.ndarray, share: float) -> Curve:
    """A logistic curve over weighted differences (rows of x), with a weak pull to 0; no slope is below 0."""
    if not len(w):
        return 0.0, 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    mean = (w[:, None] * x).sum(0) / w.sum()
    scale = np.sqrt((w[:, None] * (x - mean) ** 2).sum(0) / w.sum()) + 1e-9
    z = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1)
    a = np.array([0.0, 0.0, np.log((share + 1e-6) / (1 - share + 1e-6))])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(z @ a, -30, 30)))
        pull = np.array([0.1, 0.1, 1e-3])
        step = np.linalg.solve((z * (w * p * (1 - p))[:, None]).T @ z + np.diag(pull), z.T @ (w * (p - y)) + pull * a * [1, 1, 0])
        before, a = a, a - np.clip(step, -1, 1)
        a[:2] = np.maximum(a[:2], 0)
        if np.abs(a - before).max() < 1e-7:
            break
    slopes = a[:2] / scale
    return float(slopes[0]), float(slopes[1]), float(a[2] - slopes @ mean)


def odds(curve: Curve):
    """Logarithm of the odds of a row with the columns of DIFFERENCES."""
    return sum((F.lit(slope) * F.col(x) for slope, x in zip(curve, DIFFERENCES)), F.lit(curve[2]))


def score(docs: DataFrame, model, curve: Curve, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    if model is None:
        out = rows.select("doc_id", *[F.lit(0.0).alias(x) for x in DIFFERENCES])
    else:
        out = differences(rows, model)
    z = F.greatest(F.lit(-40.0), F.least(F.lit(40.0), odds(curve)))
    return out.select("doc_id", (1 / (1 + F.exp(-z))).alias("score"))


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, *train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", F.coalesce(remainder() == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_ordinary(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs with a score below the threshold, with the columns of docs, whatever their names."""
    model, curve = train(docs, labels, key, text)
    limit = float(np.log(threshold / (1 - threshold)))
    if model is None:
        return docs.filter(F.lit(curve[2] < limit))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(f"`{text}`").alias("__text"))
    return differences(rows, model).filter(odds(curve) < limit).select("__row.*")
