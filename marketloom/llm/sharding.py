"""Sharding through fixed virtual slots.

A row's virtual slot is a hash of its id, one of a fixed number (thousands) that never changes. Bytes and rows are summed for
each slot, and a small versioned table maps slots to shards. Placing a corpus, levelling shards again or adding a shard edits
that table; rows follow their slot.

Only DataFrame functions. The slot table has at most N_SLOTS rows whatever the corpus, so it is ordered and folded in one task
and broadcast; rows are never gathered by shard, only by slot.

Maps are kept as Parquet, a folder for each version; an old version stays readable. Groups of equal texts are not kept together: their rows
hash by id like all others, so that a text with a third of all rows doesn't fill a shard (text_crc32 shows such groups).

Defined cases. A null text has no bytes, so its size is the overhead of 16. A row without an id hashes by its size and text_crc32, so that
many such rows spread like others; only rows that are equal in id, size and text share a slot by nature. Repeated rows
all count and get places of their own; ties in size go to the lower slot and shard. Very long texts count whole. Extra columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.llm.common import hash32, shared_path, staged, table

N_SLOTS = 4096
OVERHEAD = 16


def slotted(docs: DataFrame, key: str = "doc_id", text: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """(key, size, text_crc32, virtual_slot) of every row."""
    body, own = F.col(f"`{text}`"), F.col(f"`{key}`")
    size = (F.coalesce(F.octet_length(body), F.lit(0)) + OVERHEAD).cast("long")
    crc = F.crc32(F.encode(F.coalesce(body, F.lit("")), "UTF-8")).cast("long")
    slot = hash32(F.coalesce(own.cast("string"), F.concat_ws("/", size, crc))) % n_slots
    return docs.select(own, size.alias("size"), crc.alias("text_crc32"), slot.cast("int").alias("virtual_slot"))


def slot_stats(rows: DataFrame) -> DataFrame:
    """Bytes and rows of each slot in use: at most n_slots rows."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("slot_bytes"), F.count("*").alias("slot_rows"))


def plan_map(stats: DataFrame, n_shards: int, version: int = 1) -> DataFrame:
    """(version, virtual_slot, shard): largest slot first, each to the shard that is lightest so far, ties to the lower number."""
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("slot_bytes")).alias("less"), F.col("virtual_slot").alias("slot"))))

    def place(state, x):
        at = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int")
        loads = F.transform(state["loads"], lambda load, i: F.when(i + 1 == at, load - x["less"]).otherwise(load))
        return F.struct(loads.alias("loads"), F.concat(state["chosen"], F.array(F.struct(x["slot"].alias("virtual_slot"), (at - 1).alias("shard")))).alias("chosen"))

    start = F.struct(F.array_repeat(F.lit(0).cast("long"), n_shards).alias("loads"), F.array().cast("array<struct<virtual_slot:int,shard:int>>").alias("chosen"))
    return stats.agg(F.aggregate(ordered, start, place)["chosen"].alias("chosen")).select(F.lit(version).alias("version"), F.inline("chosen"))


def edit_map(old: DataFrame, stats: DataFrame, n_shards: int) -> DataFrame:
    """The next version of a map for n_shards shards, with few slots moved.

    Each shard that has more than its even part of the bytes gives up its smallest slots beyond that part; given-up slots, and
    slots that the old map doesn't know, go to shards with room. A new shard only receives.
    """
    known = stats.join(old, "virtual_slot", "left").withColumn("version", F.coalesce("version", F.max("version").over(Window.partitionBy()), F.lit(0)))
    even = F.ceil(F.sum("slot_bytes").over(Window.partitionBy()) / n_shards)
    by_shard = Window.partitionBy("shard").orderBy(F.desc("slot_bytes"), "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    held = known.withColumns({"even": even, "held": F.sum("slot_bytes").over(by_shard)})
    moves = F.col("shard").isNull() | ((F.col("held") > F.col("even")) & (F.col("held") > F.col("slot_bytes")))
    marked = held.withColumn("moves", moves)
    loads = F.array_sort(F.collect_list(F.when(~F.col("moves"), F.struct("shard", "slot_bytes"))))
    todo = F.sort_array(F.collect_list(F.when(F.col("moves"), F.struct((-F.col("slot_bytes")).alias("less"), F.col("virtual_slot").alias("slot")))))
    stay = F.collect_list(F.when(~F.col("moves"), F.struct("virtual_slot", "shard")))

    def place(state, x):
        at = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int")
        grown = F.transform(state["loads"], lambda load, i: F.when(i + 1 == at, load - x["less"]).otherwise(load))
        return F.struct(grown.alias("loads"), F.concat(state["chosen"], F.array(F.struct(x["slot"].alias("virtual_slot"), (at - 1).alias("shard")))).alias("chosen"))

    start_loads = F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda s: F.aggregate(loads, F.lit(0).cast("long"), lambda a, x: a + F.when(x["shard"] == s, x["slot_bytes"]).otherwise(F.lit(0).cast("long"))))
    start = F.struct(start_loads.alias("loads"), F.array().cast("array<struct<virtual_slot:int,shard:int>>").alias("chosen"))
    one = marked.agg(F.max("version").alias("version"), F.concat(stay, F.aggregate(todo, start, place)["chosen"]).alias("chosen"))
    return one.select((F.col("version") + 1).alias("version"), F.inline("chosen"))


def assign(rows: DataFrame, slot_map: DataFrame, stats: DataFrame, key: str = "doc_id") -> DataFrame:
    """rows with shard, map version and slot: the row's place in its shard, without gaps from 0.

    A place is the place in the virtual slot plus the rows of the shard's slots before it; the latter comes from the slot table.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slot_map.join(stats.select("virtual_slot", "slot_rows"), "virtual_slot").withColumn("__before", F.coalesce(F.sum("slot_rows").over(before), F.lit(0))).drop("slot_rows")
    inside = Window.partitionBy("virtual_slot").orderBy(F.col(f"`{key}`"), "text_crc32", "size")
    placed = rows.withColumn("__inside", F.row_number().over(inside) - 1)
    # The map has at most N_SLOTS rows.
    return placed.join(F.broadcast(offsets), "virtual_slot").withColumn("slot", (F.col("__before") + F.col("__inside")).cast("long")).drop("__before", "__inside")


def save_map(slot_map: DataFrame, folder: str) -> int:
    """Writes a map as its own version in folder (which all tasks reach); returns the version. A version is never overwritten."""
    version = slot_map.agg(F.max("version")).first()[0]
    if version is not None:
        slot_map.drop("version").coalesce(1).write.mode("errorifexists").parquet(f"{folder}/version={version}")
    return version


def load_map(spark, folder: str, version: int | None = None) -> DataFrame | None:
    """(version, virtual_slot, shard) of one version, by default the latest; None if folder holds no map."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    held = [int(x.getPath().getName().removeprefix("version=")) for x in store.listStatus(path) if x.getPath().getName().startswith("version=")] if store.exists(path) else []
    if not held:
        return None
    chosen = max(held) if version is None else version
    rows = spark.read.schema("virtual_slot int, shard int").parquet(f"{folder}/version={chosen}")
    return rows.select(F.lit(chosen).alias("version"), "virtual_slot", "shard")


def shard(docs: DataFrame, folder: str, n_shards: int, tolerance: float = 0.02, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows with virtual_slot, version, shard and slot, by the map in folder.

    Without a map there, one is planned and saved as version 1. A map is edited, and saved as the next version, if it has other
    shards, doesn't know a slot in use, or its heaviest shard has more than an even part of the bytes and a tolerance.
    """
    rows = staged(slotted(docs, key, text), "shard-rows")
    stats = staged(slot_stats(rows), "slot-stats")
    old = load_map(docs.sparkSession, folder)
    if old is None:
        save_map(plan_map(stats, n_shards), folder)
    else:
        known = stats.join(F.broadcast(old), "virtual_slot", "left")  # at most N_SLOTS rows
        load = known.groupBy("shard").agg(F.sum("slot_bytes").alias("b"))
        state = load.agg(F.max("b").alias("most"), F.sum("b").alias("total"), F.count_if(F.isnull("shard")).alias("new")).first()
        shards = old.agg(F.max("shard")).first()[0] + 1
        if state.total and (shards != n_shards or state.new or state.most > (1 + tolerance) * state.total / n_shards):
            save_map(edit_map(old, stats, n_shards), folder)
    slot_map = load_map(docs.sparkSession, folder)
    if slot_map is None:  # no rows at all
        slot_map = docs.sparkSession.createDataFrame([], "version int, virtual_slot int, shard int")
    return assign(rows, slot_map, stats, key)


def op7_sharding(spark, sf_dir: str, n_shards: int = 40) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents"), shared_path(spark, "slot-maps"), n_shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.col("version").alias("map_version"))
