"""Sharding by jump consistent hashing: a key finds its shard by a short chain of jumps.

There is no ring table: the shard follows from the key and the shard count
alone, and one more shard takes only the rows that jump into it.  The law is
``key``.  Equal texts under different doc_ids are different keys.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costframe.llm.common import table

SHARDS = 40
#: Parts of each shard whose slots are numbered side by side.
PARTS = 1024


def jump_numpy(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards of unsigned 64-bit keys; all keys jump together until none moves."""
    key, bucket = keys.astype(np.uint64), np.full(len(keys), -1, np.int64)
    nxt = np.zeros(len(keys), np.int64)
    alive = np.arange(len(keys))
    while len(alive):
        bucket[alive] = nxt[alive]
        k = key[alive] * np.uint64(2862933555777941757) + np.uint64(1)
        key[alive] = k
        nxt[alive] = ((bucket[alive] + 1) * (float(1 << 31) / ((k >> np.uint64(33)).astype(np.float64) + 1))).astype(np.int64)
        alive = alive[nxt[alive] < shards]
    return bucket


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0..shards-1 of a long key."""
    @F.pandas_udf("int")
    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_numpy(keys.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return jump(key)


def with_shards(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id") -> DataFrame:
    """``docs`` with ``shard`` and ``grown_shard`` (with one shard more); null keys share one shard."""
    hashed = F.xxhash64(F.col(key))
    return docs.withColumns({"shard": jump_hash(hashed, shards), "grown_shard": jump_hash(hashed, shards + 1)})


def with_slots(rows: DataFrame, order: list[str], key: str = "doc_id", parts: int = PARTS) -> DataFrame:
    """``rows`` with ``slot``: 0, 1, ... in each shard, by ``order``.

    A shard is numbered in ``parts`` pieces side by side; the pieces' counts (at
    most shards * parts rows) give each its first slot.  Rows alike in all of
    ``order`` are alike but for their slot.
    """
    rows = rows.withColumn("part", F.pmod(F.xxhash64(F.col(key), *[F.col(c) for c in order]), F.lit(parts)))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = (rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
             .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    within = Window.partitionBy("shard", "part").orderBy(*order)
    return (rows.withColumn("rank", F.row_number().over(within)).join(first, ["shard", "part"])
            .withColumn("slot", F.col("first") + F.col("rank") - 1).drop("part", "rank", "first"))


def sharded(docs: DataFrame, shards: int = SHARDS, parts: int = PARTS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the text's UTF-8 bytes plus 16.  A null text counts as empty; rows
    with a null doc_id share a shard; repeated rows share a shard and take a
    slot each; other columns are ignored; an empty table gives an empty result.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(body) + 16).cast("long").alias("size"),
                       F.crc32(body.cast("binary")).alias("text_crc32"))
    placed = with_slots(with_shards(rows, shards), ["doc_id", "size", "text_crc32"], parts=parts)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op7_jump_shards(spark, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"))
