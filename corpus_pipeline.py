"""Corpus pipeline: quality filter, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet to the shared scratch folder and reads it again as the
next stage's input.  The stages handle null and repeated doc_ids: where a stage
decides on documents, a document is a (doc_id, text), named by ``_with_name``.
SQL can't express the trained classifier or the signatures, so the pipeline is
tested against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costframe.llm.common import fresh_name, saved, table
from costframe.llm.decontaminate import leaks
from costframe.llm.mixing import copies
from costframe.llm.near_dedup import near_dedup
from costframe.llm.quality import accepted
from costframe.llm.sharding import with_shards, with_slots

NEAR_WORDS = 5


def _with_name(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a name for each distinct (doc_id, text), and the name's column."""
    name = fresh_name(docs, "name")
    return docs.withColumn(name, F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64("doc_id", "text").cast("string"))), name


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the factorisation machine takes for good; those below 0.5 go."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of links of similarity 0.8 or more over five-word shingles."""
    named, name = _with_name(docs)
    marks = near_dedup(named.select(F.col(name).alias("doc_id"), "text"), NEAR_WORDS)
    kept = marks.where("kept").select(F.col("doc_id").alias(name)).distinct()
    return named.join(kept, name, "left_semi").dropDuplicates([name]).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    named, name = _with_name(docs)
    bad = leaks(named.select(F.col(name).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return named.join(bad.select(F.col("doc_id").alias(name)).distinct(), name, "left_anti").select(*docs.columns)


def _packed(docs: DataFrame) -> DataFrame:
    """``docs`` with each row's columns as one struct, so that no helper column can meet one of theirs."""
    return docs.select("doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    taken = copies(_packed(docs), keep=["doc_id", "source", "row"]).where("copies > 0")
    return taken.select(F.explode(F.sequence(F.lit(1), F.col("copies"))), "row").select("row.*")


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard of 40, their slot in it, their shard of 41, their size and checksum.

    These columns stand behind an underscore where ``docs`` has columns of their names.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = _packed(docs).withColumns({"size": (F.octet_length(body) + 16).cast("long"), "text_crc32": F.crc32(body.cast("binary"))})
    placed = with_slots(with_shards(rows.select("doc_id", "size", "text_crc32", "row")), ["doc_id", "size", "text_crc32"])
    return placed.select("row.*", *[F.col(c).alias(fresh_name(docs, c)) for c in ("size", "text_crc32", "shard", "grown_shard", "slot")])


STAGES = [
    ("quality classifier", quality_stage),
    ("near-dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
