"""Co-located merges: a bucketed, sorted catalog table.

The table is partitioned by day and bucketed by the record key, so the rows of a
key lie in the same bucket of their day.  A restatement is joined bucket by
bucket: only the load is shuffled, into the table's own buckets, and the touched
days of the target are read where they lie.  The merged rows come out bucket by
bucket too, so each task writes the files of its bucket.

The number of buckets is fixed when the table is made; choose it so that a
bucket of a day stays around the size of a file (``buckets_for``).  A table made
from many rows gets more: a merge sorts a bucket of all touched days in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import files
from .tables import DUPLICATE, ORDINAL, WRITE_PART_BYTES, aligned

_CONF = {
    # A table bucketed by the record key alone serves a join on (day, record key).
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.bucketing.enabled": "true",
    # Buckets are read as buckets whatever their number is, and not merged.
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    "spark.sql.bucketing.coalesceBucketsInJoin.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


@contextmanager
def _settings(spark: SparkSession):
    """Settings of one merge; the session's own come back after it."""
    before = {k: spark.conf.get(k, None) for k in _CONF}
    for k, v in _CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def buckets_for(day_bytes: int, part_bytes: int = WRITE_PART_BYTES) -> int:
    """Buckets for days of about ``day_bytes``: files of ``part_bytes`` at most."""
    return max(1, -(-day_bytes // part_bytes))


# Rows of a bucket over all days; what a task of the first write and of a merge sorts in memory.
BUCKET_ROWS = 500_000


def create_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None, date_col: str = "usage_date",
                    bucket_rows: int = BUCKET_ROWS) -> None:
    """Save ``df`` as a new catalog table, partitioned by day, bucketed and sorted by the other ``keys``.

    It has ``buckets``, or one for each ``bucket_rows`` of its rows (they are counted first) if that is more.
    """
    by = [k for k in keys if k != date_col]
    buckets = max(buckets, -(-df.count() // bucket_rows))
    w = df.repartition(buckets, *by).write.format("parquet").partitionBy(date_col).bucketBy(buckets, *by).sortBy(*by)
    (w.option("path", path) if path else w).saveAsTable(name)


def _bucket_spec(spark: SparkSession, name: str) -> tuple[int, list[str], list[str]]:
    """(number, columns) of the table's buckets and its partition columns, from the catalog."""
    rows = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r.data_type}
    if "Num Buckets" not in rows:
        raise ValueError(f"{name} is not bucketed")
    by = [c.strip(" `") for c in rows["Bucket Columns"].strip("[]").split(",")]
    return int(rows["Num Buckets"]), by, [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def merged_buckets(spark: SparkSession, name: str, staged: DataFrame, keys: Sequence[str], days: Sequence,
                   ordinal: str | None = None, date_col: str = "usage_date") -> DataFrame:
    """The touched days of the table after the load: its winners where there are any, else the table's rows.

    The load is dealt into the table's buckets once; its winners per key and the
    join with the target need no further exchange, and the target none at all.
    A key twice inside one load raises.
    """
    buckets, by, _ = _bucket_spec(spark, name)
    target = spark.table(name).where(F.col(date_col).isin(list(days)))
    ordc = ordinal or ORDINAL
    src = staged if ordinal else staged.withColumn(ORDINAL, F.lit(0))
    src = src.select(*aligned(src.drop(ordc), target).columns, ordc).repartition(buckets, *by)
    w = Window.partitionBy(*by, date_col).orderBy(F.col(ordc).desc())
    marked = src.withColumns({"_rn": F.row_number().over(w), "_next": F.lead(ordc).over(w)})
    message = F.concat(F.lit(DUPLICATE + ": "), F.to_json(F.struct(*keys)))
    won = marked.where(F.when(F.col("_next") == F.col(ordc), F.raise_error(message)).otherwise(F.col("_rn") == 1)).drop("_rn", "_next", ordc)
    t, s = target.alias("t"), won.withColumn("_new", F.lit(True)).alias("s").hint("merge")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in [*by, date_col]]
    both = t.join(s, on, "full_outer")
    return both.select(*[F.when(F.col("s._new"), F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c) for c in target.columns])


def upsert_bucketed(spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str], ordinal: str | None = None,
                    date_col: str = "usage_date") -> dict:
    """Load ``source`` into a table made by :func:`create_bucketed` (K2, K5, K7; see ``upsert_table``).

    The load is staged, its days are listed, and the table's days are replaced
    (dynamic partition overwrite).  Keys must not be null.
    """
    staged_path = scratch_path(spark, "bucket-staging")
    obs = Observation("bucket_staged")
    source.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(staged_path)
    rows = obs.get.get("rows", 0)
    if rows:
        staged = spark.read.schema(source.schema).parquet(staged_path)
        days = sorted(r[0] for r in staged.select(date_col).distinct().collect())
        with _settings(spark):
            out = merged_buckets(spark, name, staged, keys, days, ordinal, date_col)
            try:
                out.write.mode("overwrite").insertInto(name)
            except Exception as e:
                if DUPLICATE in str(e):
                    raise ValueError(next(line for line in str(e).splitlines() if DUPLICATE in line)) from e
                raise
    files.delete(spark, staged_path)
    return {"staged_rows": rows, "days": len(days) if rows else 0}
