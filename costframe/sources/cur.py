"""Cost-and-usage report scan: manifest -> gzip CSV parts.

Layout: ``<root>/<report>/<period>/<report>-Manifest.json`` names the report
parts of the latest assembly in ``reportKeys`` (keys relative to the bucket
root).  Older assembly folders beside it are never listed, only the keys the
manifest names are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files

MANIFEST_SCHEMA = ("assemblyId string, reportKeys array<string>, "
                   "columns array<struct<category:string,name:string>>")


def manifest_path(root: str, report: str, period: str) -> str:
    return f"{root.rstrip('/')}/{report}/{period}/{report}-Manifest.json"


def read_manifests(spark: SparkSession, root: str, report: str,
                   periods: Sequence[str] | None = None) -> DataFrame:
    """One row per (period, assembly, report key); missing manifests are skipped."""
    if periods is None:
        paths = files.glob(spark, manifest_path(root, report, "*"))
    else:
        paths = [p for period in periods for p in files.glob(spark, manifest_path(root, report, period))]
    if not paths:
        return spark.createDataFrame(
            [], "period string, assembly_id string, header array<string>, report_key string")
    m = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(paths)
    header = F.transform("columns", lambda c: F.concat_ws("/", c["category"], c["name"]))
    return m.select(
        F.regexp_extract(F.col("_metadata.file_path"), r"/([0-9]{8}-[0-9]{8})/[^/]*$", 1).alias("period"),
        F.col("assemblyId").alias("assembly_id"),
        header.alias("header"),
        F.explode("reportKeys").alias("report_key"))


def csv_scan(spark: SparkSession, paths: Sequence[str], header: Sequence[str] | None = None) -> DataFrame:
    """gzip CSV with header, every column text, quoted newlines allowed.

    gzip is not splittable, so each part is one task; parallelism comes from
    the number of parts.  No type inference: every column stays a string.
    With ``header`` (the manifest's column list) the schema is declared, so
    no job reads a header first, and every part's header is checked against
    it (a part laid out differently fails instead of being read by position).
    """
    reader = (spark.read.option("header", True).option("multiLine", True)
              .option("escape", '"').option("encoding", "UTF-8").option("inferSchema", False))
    if header:
        reader = reader.schema(T.StructType([T.StructField(h, T.StringType()) for h in header])) \
                       .option("enforceSchema", False)
    return reader.csv(list(paths))


def csv_by_name(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parts whose manifest declares no columns: each goes by its own header.

    Parts with the same header share a scan, the scans are joined by column
    name, and a column that a part lacks reads as NULL.  One job reads the header
    lines (one a part come to the driver); parts without one have no rows.
    """
    alike = files.csv_headers(spark, list(paths))
    if not alike:
        return spark.createDataFrame([], T.StructType())
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [csv_scan(spark, group, names) for names, group in alike.items()])


def cur_scan(spark: SparkSession, root: str, report: str, periods: Sequence[str] | None = None,
             bucket_root: str | None = None) -> DataFrame:
    """All rows of the parts the manifests name, with their period and assembly.

    Parts of one manifest share the header it declares (without one, each part
    goes by its own); different periods may not, so each period is read on its
    own and the periods are unioned by column name.  The manifest list is
    metadata (one row per part file), collected to plan the reads; rows never
    pass through the driver.
    """
    bucket = (bucket_root or root).rstrip("/")
    keys = read_manifests(spark, root, report, periods).collect()
    by_period: dict[tuple[str, str], list[str]] = {}
    headers: dict[tuple[str, str], list[str] | None] = {}
    for r in keys:
        by_period.setdefault((r.period, r.assembly_id), []).append(f"{bucket}/{r.report_key}")
        headers[(r.period, r.assembly_id)] = list(r.header) if r.header else None
    frames = []
    for (period, assembly), paths in sorted(by_period.items()):
        header = headers[(period, assembly)]
        rows = csv_scan(spark, paths, header) if header else csv_by_name(spark, paths)
        frames.append(rows.withColumns({"billing_period": F.lit(period), "assembly_id": F.lit(assembly)}))
    if not frames:
        return spark.createDataFrame([], "billing_period string, assembly_id string")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
