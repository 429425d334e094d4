"""Exact deduplication by deterministic block naming; DataFrame functions only.

Each text (white-space runs read as one space) is cut into fixed-size blocks.
Sorting the distinct blocks gives each an integer name; adjacent names form
pairs, which are sorted and named in turn, until one name is left for each
document.  Two documents end with the same (level, name) if and only if their
texts are equal: names are given to values, not to hashes of them.

Blocks are sorted by (64-bit hash, block).  Only one shuffle moves text: it
brings the blocks of one hash together and keeps, beside the hash, how many
different blocks share it (one, save for a hash clash, whose blocks are kept
and told apart by their bytes).  All later shuffles move integers.  A name is
(rank in its bucket) * buckets + bucket, so that naming is a parallel sort of
many buckets.  Blocks are collected as sets before the shuffle, a frequent
block costs one row for each map task, and the joins that hand out names are
plain equi-joins, whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costframe.llm.common import saved, table

BLOCK_BYTES = 4096
BUCKETS = 4096
KEY = ["doc_id", "text_sha256"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _blocks(size: int) -> Column:
    n = F.greatest(F.lit(1), F.ceil(F.octet_length("body") / F.lit(size))).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1),
                       lambda i: F.substring(F.col("body"), i * size + 1, F.lit(size)))


def _ranked(values: DataFrame, hashed: Column, order: list[str], buckets: int) -> DataFrame:
    """``values`` (distinct rows) with an integer ``name`` each, by a sort inside hash buckets."""
    bucket = F.pmod(hashed, F.lit(buckets))
    by = Window.partitionBy("bucket").orderBy(*order)
    return (values.withColumn("bucket", bucket)
            .withColumn("name", (F.row_number().over(by).cast("long") - 1) * buckets + F.col("bucket"))
            .drop("bucket"))


def _gathered(rows: DataFrame, times: Column) -> DataFrame:
    """The names of each document in order; rows repeated in the input fall together, ``times`` counts them."""
    return (rows.groupBy(*KEY).agg(F.array_sort(F.collect_set(F.struct("idx", "name"))).alias("n"), times.alias("times"))
            .select(*KEY, "times", F.col("n.name").alias("names")))


def block_identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES, buckets: int = BUCKETS,
                     hash_of=F.xxhash64) -> DataFrame:
    """(doc_id, text_sha256, times, level, name): the collision-free identity of each distinct (doc_id, text).

    ``times`` is the number of its rows: each has one block with index 0.
    """
    cut = docs.select("doc_id", normalised(F.col("text")).cast("binary").alias("body"))
    cut = cut.select("doc_id", F.sha2("body", 256).alias("text_sha256"), _blocks(block_bytes).alias("blocks"))

    by_hash = (cut.select(F.explode("blocks").alias("block"))
               .groupBy(hash_of(F.col("block")).alias("h")).agg(F.collect_set("block").alias("same")))
    by_hash = saved(by_hash.select("h", F.size("same").alias("n"),
                                   F.when(F.size("same") > 1, F.array_sort("same")).alias("same")), "block-hashes")
    names = _ranked(by_hash.select("h", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("pos")),
                    F.col("h"), ["h", "pos"], buckets)

    met = cut.select(*KEY, F.posexplode(F.transform("blocks", lambda b: hash_of(b))).alias("idx", "h"))
    clashes = by_hash.where("n > 1").select("h", F.posexplode("same").alias("pos", "block"))
    if clashes.isEmpty():
        met = met.withColumn("pos", F.lit(0))
    else:
        told = (cut.select(*KEY, F.posexplode("blocks").alias("idx", "block"))
                .withColumn("h", hash_of(F.col("block"))).join(clashes, ["h", "block"])
                .select(F.col("doc_id").alias("d"), F.col("text_sha256").alias("s"), F.col("idx").alias("i"), "pos")
                .distinct())
        met = (met.join(told, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_sha256") == F.col("s"))
                        & (F.col("idx") == F.col("i")), "left")
               .select(*KEY, "idx", "h", F.coalesce("pos", F.lit(0)).alias("pos")))
    level = saved(_gathered(met.join(names, ["h", "pos"]).select(*KEY, "idx", "name"), F.count_if(F.col("idx") == 0)), "names-0")

    done, k = [], 0
    while True:
        done.append(level.where(F.size("names") == 1)
                    .select(*KEY, "times", F.lit(k).alias("level"), F.col("names")[0].alias("name")))
        rest = level.where(F.size("names") > 1)
        if rest.isEmpty():
            break
        k += 1
        halves = F.transform(F.sequence(F.lit(0), F.expr("(size(names) - 1) div 2").cast("int")), lambda i: F.struct(
            F.get(F.col("names"), i * 2).alias("l"), F.coalesce(F.get(F.col("names"), i * 2 + 1), F.lit(-1)).alias("r")))
        pairs = rest.select(*KEY, "times", F.posexplode(halves).alias("idx", "p")).select(*KEY, "times", "idx", "p.l", "p.r")
        named = _ranked(pairs.select("l", "r").distinct(), F.xxhash64("l", "r"), ["l", "r"], buckets)
        level = saved(_gathered(pairs.join(named, ["l", "r"]).select(*KEY, "times", "idx", "name"), F.max("times")), f"names-{k}")
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES, buckets: int = BUCKETS,
                hash_of=F.xxhash64) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    A null text counts as empty; empty texts are equal to each other.  Of equal
    texts the smallest doc_id is kept; a null doc_id loses to any other and a
    group of nulls alone has keep_id null.  Of rows that repeat a doc_id with
    its text, one is kept; each has its row.  Other columns are ignored.  An
    empty table gives an empty result.
    """
    same = ["level", "name"]
    # the levels are written tables, so both uses read those
    rows = block_identities(docs, block_bytes, buckets, hash_of)
    groups = (rows.groupBy(*same).agg(F.min("doc_id").alias("least"), F.sum("times").alias("size"))
              .where("size > 1"))
    # written, so that both sides of the join are plain exchanges: a hot group's rows can then be split
    return (rows.join(saved(groups, "groups"), same, "left")
            .withColumn("keep_id", F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("least")))
            .select("doc_id", "keep_id", F.coalesce("size", F.lit(1)).cast("long").alias("group_size"), "text_sha256",
                    F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                    "text_sha256"))


def op2_block_naming(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, d.text_sha256
FROM d JOIN g ON d.text_sha256 = g.text_sha256
"""
