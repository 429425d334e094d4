"""Monthly invoice CSV scan (S11): one named file, a folder or a glob."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files

# Characters that Hadoop's globbing gives a meaning, escaped in listed paths.
GLOB_MARKS = r"([\\\[\]{}*?])"


def invoice_scan(spark: SparkSession, path_or_glob: str) -> DataFrame:
    """All rows as text plus ``file_name`` (decoded, for the month lookup) and ``file_path``.

    Columns go by each file's own header: files with the same header line share a
    scan, the scans are joined by column name, and a column that a file lacks reads
    as NULL.  Only header lines and paths (one a file) come to the driver.
    Every column is text, also a percent column that is all numeric in one month.
    A folder without invoices, or one that isn't there, gives no rows.
    """
    if not files.glob_any(spark, path_or_glob):
        return spark.createDataFrame([], "file_name string, file_path string")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path_or_glob).select("path").collect()
    scans = [_scan(spark, names, paths) for names, paths in files.csv_headers(spark, [r.path for r in listed]).items()]
    if not scans:
        return spark.createDataFrame([], "file_name string, file_path string")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _scan(spark: SparkSession, names: Sequence[str], paths: list[str]) -> DataFrame:
    """Files that share a header (a byte order mark and blank names aside)."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    escaped = [re.sub(GLOB_MARKS, r"\\\1", p) for p in paths]
    df = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(escaped)
    return df.withColumns({"file_name": F.url_decode(F.col("_metadata.file_name")),
                           "file_path": F.col("_metadata.file_path")})
