"""Table scan by name or path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_scan(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by qualified name, or a Parquet table by path.

    Catalog tables carry their partition list in the metastore, so a
    day-partitioned table is pruned without listing its folders.
    """
    if "/" in name_or_path or name_or_path.startswith(("file:", "s3", "gs:", "hdfs:", "abfs")):
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)
