"""Operator 5: shard assignment by jump consistent hashing.

`jump_hash` (Lamping and Veach, 2014) maps a 64-bit key to one of n shards with
no ring table: the key seeds a generator whose jumps are followed while they
stay below n.  Growing n to n + 1 moves a key only into the new shard.

Defined results: a null key hashes as key 0 with the null flag mixed in; a null
text has size 1 and CRC 0; repeated rows are kept and each gets its own slot;
ties in slot order are broken by (doc_id, crc, size) and equal rows are
interchangeable; an empty table gives an empty result; other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import staged, table
from .textkernel import mix64

SHARDS = 16
#: Rows that one slot bucket is meant to hold; the bucket count follows the data.
ROWS_PER_BUCKET = 200_000
MAX_BUCKETS = 4096
#: Copies of one row in one deal, and deals of a task.
COPIES, DEALS = 10_000, 100


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key; all keys advance together."""
    state = keys.astype(np.uint64, copy=True)
    out = np.zeros(len(state), np.int32)
    live = np.arange(len(state))
    at = np.zeros(len(state), np.int64)
    while len(live):
        out[live] = at
        state = state * np.uint64(2862933555777941757) + np.uint64(1)
        nxt = ((at + 1) * (float(1 << 31) / ((state >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        go = nxt < shards
        live, state, at = live[go], state[go], nxt[go]
    return out


def shards_of(key: Column, shards: int) -> Column:
    """jump_hash of a long key as columns: shard, and grown_shard with one more."""

    @F.pandas_udf("shard int, grown_shard int")
    def assign(k: pd.Series) -> pd.DataFrame:
        null = k.isna().to_numpy()
        raw = k.fillna(0).to_numpy().astype(np.int64).view(np.uint64)
        mixed = mix64(raw + null.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return pd.DataFrame({"shard": jump_hash(mixed, shards), "grown_shard": jump_hash(mixed, shards + 1)})

    return assign(key)


def assign_shards(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Shard, gapless slot within the shard, and the shard after growth by one.

    Slots need a row number inside each shard.  One window per shard would put
    a sixteenth of all rows into one task, so shards are cut into hash buckets
    whose number follows the row count; bucket totals (at most shards x
    MAX_BUCKETS rows) give each bucket its first slot.  Equal rows are counted
    first and expanded last, COPIES a deal, so a key that holds a third of all
    rows is one row until then and many tasks' work after.
    """
    base = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    rows = docs.count()
    buckets = int(min(MAX_BUCKETS, max(8, rows // (shards * ROWS_PER_BUCKET) + 1)))
    unique = staged(
        base.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("to", shards_of(F.col("doc_id"), shards))
        .select("*", "to.shard", "to.grown_shard").drop("to")
        .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(buckets)).cast("int"))
    )
    order = ["doc_id", "text_crc32", "size"]
    inside = Window.partitionBy("shard", "bucket").orderBy(*order)
    numbered = unique.withColumn("local", F.sum("copies").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies"))
    # shards x buckets rows at most: the bound of what is broadcast and of the one-task running sum
    totals = unique.groupBy("shard", "bucket").agg(F.sum("copies").alias("total"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select("shard", "bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("first"))
    placed = numbered.join(F.broadcast(firsts), ["shard", "bucket"])
    few = placed.where(F.col("copies") <= COPIES).withColumn("from", F.lit(0).cast("long"))
    many = placed.where(F.col("copies") > COPIES).withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
    deals = unique.where(F.col("copies") > COPIES).agg(F.coalesce(F.sum(F.ceil(F.col("copies") / COPIES)), F.lit(0))).first()[0]
    if deals:
        # a number of its own: by size, many deals would be put in one task
        few = few.unionByName(many.repartition(max(int(deals) // DEALS, docs.sparkSession.sparkContext.defaultParallelism), F.xxhash64("doc_id", "text_crc32", "from")))
    return (
        few.withColumn("copy", F.explode(F.sequence("from", F.least(F.col("from") + COPIES, "copies") - 1)))
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first") + F.col("local") + F.col("copy")).cast("long").alias("slot"), "grown_shard")
    )


def op5_jump_hash_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))
