"""Temperature mixing of sources.

A source with T tokens gets a weight in proportion to T ** alpha. The exponent is bisected: the largest tempering (smallest
alpha) at which no source is repeated more than a limit and, if one is given, the weights' entropy is no more than a target. The weights
are realised as epochs over permuted blocks: rows hash into a fixed number of blocks, each epoch of a source permutes its blocks,
and the last, partial epoch takes whole blocks while they fit the source's budget.

Only DataFrame functions. The block plan is one row for each source, with the reads of its blocks as packed numbers (about 40 kB); it is
broadcast to the scan while its counted rows stay under common.MOST_BROADCAST_BYTES (about 800 sources), and no text is shuffled then. With more sources
the rows are joined by source and block in a shuffle, which adaptive execution splits where a source is hot. The default budget is the least at which the largest source is read whole once, so no row is dropped; smaller sources repeat.

Defined cases. A null source is a source of its own. Rows without an id go to blocks by their tokens and text, so that many of them spread; equal rows share a
block and are read together. Very long texts count whole and are moved as they are; a block that holds one may not fit the last epoch's budget, and is then
left out of that epoch only. Extra columns pass through under __row, whatever their names. Tokens are bytes / 4, rounded up, at least 1 (also for null and empty
texts). Repeated rows all count. One source, or equal sources: alpha 0 and one epoch. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.llm.common import MOST_BROADCAST_BYTES, hash32, small_side, staged, table, text_or_empty

N_BLOCKS = 1024
REPEAT_LIMIT = 2.0
STEPS = 20
#: Bisection steps that one pass over the source totals answers at once (it evaluates 2 ** DEPTH - 1 inner points).
DEPTH = 4


def tokens(text: str = "text") -> Column:
    return F.greatest(F.lit(1), F.ceil(F.octet_length(text_or_empty(text)) / 4)).cast("long")


def blocked(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", n_blocks: int = N_BLOCKS, seed: str = "mix") -> DataFrame:
    """docs with __source, __tokens and __block."""
    own = F.coalesce(F.col(key).cast("string"), F.concat_ws("/", tokens(text), F.md5(text_or_empty(text).cast("binary"))))
    block = (hash32(seed, own) % n_blocks).cast("int")
    return docs.withColumns({"__source": F.coalesce(F.col(source).cast("string"), F.lit("\0null")), "__tokens": tokens(text), "__block": block})


def exponent(totals: DataFrame, repeat_limit: float | None = REPEAT_LIMIT, target_entropy: float | None = None) -> float:
    """The bisected exponent. totals: one row for each source, with column total.

    With a repetition limit: the smallest alpha in [0, 1] at which (largest total / total) ** (1 - alpha) stays within the limit
    for every source. With a target entropy (nats): the smallest alpha whose weights have no more. With both, both hold, so a target never
    repeats a tiny source beyond the limit. Each pass is one aggregation with partial sums, and only its few numbers come to the driver.
    """

    def good(alphas: list[float]) -> list[bool]:
        asked = [F.pow(F.max("total") / F.min("total"), F.lit(1 - a)).alias(f"r{i}") for i, a in enumerate(alphas)]
        if target_entropy is not None:
            asked += [F.sum(F.pow(F.col("total"), F.lit(a))).alias(f"z{i}") for i, a in enumerate(alphas)]
            asked += [F.sum(F.pow(F.col("total"), F.lit(a)) * a * F.ln("total")).alias(f"x{i}") for i, a in enumerate(alphas)]
        row = totals.agg(*asked).first()

        def holds(i: int) -> bool:
            if row[f"r{i}"] is None:
                return True
            calm = target_entropy is None or math.log(row[f"z{i}"]) - row[f"x{i}"] / row[f"z{i}"] < target_entropy
            return calm and (repeat_limit is None or row[f"r{i}"] <= repeat_limit)

        return [holds(i) for i in range(len(alphas))]

    if good([0.0])[0]:
        return 0.0
    low, high = 0.0, 1.0  # low breaks the limit, high holds
    for _ in range(STEPS // DEPTH):
        inner = [low + (high - low) * i / 2**DEPTH for i in range(1, 2**DEPTH)]
        held = [False, *good(inner), True]
        points = [low, *inner, high]
        at, to = 0, 2**DEPTH
        for _ in range(DEPTH):
            middle = (at + to) // 2
            at, to = (at, middle) if held[middle] else (middle, to)
        low, high = points[at], points[to]
    return high


def block_plan(blocks: DataFrame, alpha: float, budget: int | None = None, seed: str = "mix") -> DataFrame:
    """(__source, epoch, __block, block_rank, weight, alpha): which block is read in which epoch, and when.

    blocks: __source, __block, block_tokens. Windows run over the blocks of a source and epoch: a fixed number of rows at most.
    """
    totals = blocks.groupBy("__source").agg(F.sum("block_tokens").alias("total"))
    scale = totals.agg(F.max("total").alias("most"), F.sum(F.pow(F.col("total"), F.lit(alpha))).alias("mass"))
    tempered = F.pow(F.col("total"), F.lit(alpha))
    # One row: the whole table's largest source and normaliser.
    shares = totals.crossJoin(F.broadcast(scale)).withColumn("weight", F.round(tempered / F.col("mass"), 9))
    repeats = F.pow(F.col("most") / F.col("total"), F.lit(1 - alpha)) if budget is None else F.lit(float(budget)) * tempered / F.col("mass") / F.col("total")
    quota = F.floor(F.round(repeats, 6) * F.col("total") + 0.5).cast("long")
    shares = shares.withColumn("quota", quota).withColumns({"whole": F.expr("quota div total"), "rest": F.expr("quota % total")})
    epochs = shares.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("whole") + 1)))
    order = Window.partitionBy("__source", "epoch").orderBy("place", "__block")
    placed = blocks.join(small_side(staged(epochs, "mix-epochs")), "__source").withColumn("place", hash32(seed, F.col("__source"), F.col("epoch"), F.col("__block")))
    ranked = placed.withColumns({"block_rank": F.row_number().over(order), "upto": F.sum("block_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0))})
    read = ranked.filter((F.col("epoch") <= F.col("whole")) | (F.col("upto") <= F.col("rest")))
    return read.select("__source", F.col("epoch").cast("int").alias("epoch"), "__block", "block_rank", "weight", F.lit(alpha).alias("alpha"))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", repeat_limit: float = REPEAT_LIMIT, target_entropy: float | None = None, budget: int | None = None, n_blocks: int = N_BLOCKS, seed: str = "mix") -> DataFrame:
    """Every read of every row: docs's columns under __row, and __tokens, __block, epoch, block_rank, weight, alpha."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(f"`{key}`").alias("__key"), F.col(f"`{source}`").alias("__src"), F.col(f"`{text}`").alias("__text"))
    rows = blocked(held, "__key", "__src", "__text", n_blocks, seed).drop("__key", "__src", "__text")
    blocks = staged(blocked(held, "__key", "__src", "__text", n_blocks, seed).groupBy("__source", "__block").agg(F.sum("__tokens").alias("block_tokens")), "mix-blocks")
    alpha = exponent(blocks.groupBy("__source").agg(F.sum("block_tokens").alias("total")), repeat_limit, target_entropy)
    plan = staged(block_plan(blocks, alpha, budget, seed), "mix-plan")
    size = plan.agg(F.count("*").alias("reads"), F.count_distinct("__source").alias("sources")).first()
    if size.reads * 8 + size.sources * 24 * n_blocks > MOST_BROADCAST_BYTES:
        out = rows.join(plan, ["__source", "__block"])
    else:
        # A read is epoch * n_blocks + rank; reads of a source by block.
        read = (F.col("epoch").cast("long") * n_blocks + F.col("block_rank") - 1).alias("read")
        per = plan.select("__source", "__block", "weight", read).groupBy("__source", "__block").agg(F.max("weight").alias("weight"), F.sort_array(F.collect_list("read")).alias("reads"))
        # A source has n_blocks rows here at most.
        laid = per.groupBy("__source").agg(F.max("weight").alias("weight"), F.map_from_entries(F.collect_list(F.struct("__block", "reads"))).alias("by"))
        of = laid.select("__source", "weight", F.transform(F.sequence(F.lit(0), F.lit(n_blocks - 1)), lambda i: F.col("by")[i]).alias("__reads"))
        met = rows.join(F.broadcast(of), "__source").withColumn("__read", F.explode(F.get("__reads", F.col("__block"))))
        out = met.select("__source", "__block", "__row", "__tokens", F.expr(f"__read div {n_blocks}").cast("int").alias("epoch"), (F.col("__read") % n_blocks + 1).cast("int").alias("block_rank"), "weight", F.lit(alpha).alias("alpha"))
    return out


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = mix(docs)
    return out.select("__row.doc_id", "__row.source", F.col("__tokens").alias("tokens"), "epoch", F.col("__block").alias("block"), "block_rank", "weight", "alpha")


def _oracle(limit: float = REPEAT_LIMIT) -> str:
    steps = ["s0 AS (SELECT CASE WHEN pow(most / least, 1.0) <= {0} THEN 0.0 ELSE 0.0 END::DOUBLE AS low, CASE WHEN pow(most / least, 1.0) <= {0} THEN 0.0 ELSE 1.0 END::DOUBLE AS high FROM ends)".format(limit)]
    for i in range(STEPS):
        middle = "(low + high) / 2"
        holds = f"pow(most / least, 1 - {middle}) <= {limit}"
        steps.append(f"s{i + 1} AS (SELECT CASE WHEN {holds} THEN low ELSE {middle} END AS low, CASE WHEN {holds} THEN {middle} ELSE high END AS high FROM s{i}, ends)")
    number = lambda x: f"('0x' || substr(md5({x}), 1, 8))::BIGINT"
    return f"""
WITH d AS (
  SELECT doc_id, source, coalesce(source, chr(0) || 'null') AS src, greatest(1, ceil(strlen(coalesce(text, '')) / 4.0))::BIGINT AS tokens,
         ({number("'mix|' || doc_id")} % {N_BLOCKS})::INT AS block FROM documents
), b AS (SELECT src, block, sum(tokens)::BIGINT AS block_tokens FROM d GROUP BY ALL
), t AS (SELECT src, sum(block_tokens)::BIGINT AS total FROM b GROUP BY ALL
), ends AS (SELECT max(total)::DOUBLE AS most, min(total)::DOUBLE AS least FROM t
), {", ".join(steps)}
, a AS (SELECT high AS alpha FROM s{STEPS}
), w AS (
  SELECT src, total, alpha, round(pow(total, alpha) / sum(pow(total, alpha)) OVER (), 9) AS weight,
         floor(round(pow(most / total, 1 - alpha), 6) * total + 0.5)::BIGINT AS quota FROM t, ends, a
), e AS (SELECT *, unnest(range(1, quota // total + 2)) AS epoch FROM w
), k AS (
  SELECT b.*, e.epoch, e.weight, e.alpha, e.total, e.quota, {number("'mix|' || b.src || '|' || e.epoch || '|' || b.block")} AS place FROM b JOIN e USING (src)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY src, epoch ORDER BY place, block) AS block_rank,
         sum(block_tokens) OVER (PARTITION BY src, epoch ORDER BY place, block ROWS UNBOUNDED PRECEDING) AS upto FROM k
)
SELECT d.doc_id, d.source, d.tokens, r.epoch::INT AS epoch, d.block, r.block_rank::INT AS block_rank, r.weight, r.alpha
FROM d JOIN r ON d.src = r.src AND d.block = r.block WHERE r.epoch <= r.quota // r.total OR r.upto <= r.quota % r.total
"""


OP4_SQL = _oracle()
