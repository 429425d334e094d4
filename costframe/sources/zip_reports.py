"""Zipped call/message reports as a Python data source.

Landed layout: see :mod:`costframe.sources.cdr`.  Each archive is an input
partition of its own; the task streams its first CSV member as Arrow batches, so
an archive is never one row and its fields are never JSON text parsed again.
Filters on product, requested direction and request day are pushed into the
listing: folders that they exclude are not listed.  A missing or empty landing
folder is an empty load.
"""

from __future__ import annotations

import datetime as dt
import json
import zipfile
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cdr import BATCH_ROWS, RAW_FIELDS, csv_rows
from .files import arrow_fs

FORMAT = "zipped_reports"
# Fixed value: the folder name of a null partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
#: Landing folders from the root down, and the columns that they give.
LEVELS = (("product", "product"), ("direction", "direction_requested"), ("start", "request_day"))

SCHEMA = T.StructType([T.StructField("product", T.StringType()), T.StructField("direction_requested", T.StringType()),
                       T.StructField("request_day", T.DateType()), T.StructField("raw_json", T.StringType()),
                       *[T.StructField(f"raw_{f}", T.StringType()) for f in RAW_FIELDS]])


@dataclass
class Archive(ds.InputPartition):
    path: str
    values: tuple  # of LEVELS


def _test(f: ds.Filter) -> Callable[[object], bool] | None:
    """What a pushed filter asks of a folder's value; null answers no, as in SQL.  None: not for a listing."""
    if isinstance(f, ds.EqualTo):
        return lambda v: v is not None and v == f.value
    if isinstance(f, ds.EqualNullSafe):
        return lambda v: v == f.value
    if isinstance(f, ds.In):
        return lambda v: v is not None and v in f.value
    if isinstance(f, ds.GreaterThan):
        return lambda v: v is not None and v > f.value
    if isinstance(f, ds.GreaterThanOrEqual):
        return lambda v: v is not None and v >= f.value
    if isinstance(f, ds.LessThan):
        return lambda v: v is not None and v < f.value
    if isinstance(f, ds.LessThanOrEqual):
        return lambda v: v is not None and v <= f.value
    if isinstance(f, ds.IsNotNull):
        return lambda v: v is not None
    if isinstance(f, ds.IsNull):
        return lambda v: v is None
    return None


def _value(name: str, text: str):
    if text == NULL_FOLDER:
        return None
    text = unquote(text)
    if name != "start":
        return text
    try:
        return dt.date.fromisoformat(text)
    except ValueError:
        return None


class ZipReader(ds.DataSourceReader):
    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.pushed: dict[str, list[ds.Filter]] = {}
        self.listed: list[str] = []  # folders, for tests

    def pushFilters(self, filters):
        columns = {c for _, c in LEVELS}
        for f in filters:
            column = getattr(f, "attribute", (None,))
            if len(column) == 1 and column[0] in columns and _test(f) is not None:
                self.pushed.setdefault(column[0], []).append(f)
            else:
                yield f

    def _children(self, filesystem, folder: str):
        from pyarrow import fs as pafs

        self.listed.append(folder)
        found = filesystem.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        return sorted((f for f in found if not f.base_name.startswith((".", "_")) or f.base_name == NULL_FOLDER), key=lambda f: f.path)

    def partitions(self) -> list[Archive]:
        filesystem, top = arrow_fs(self.root)
        scheme = self.root[:len(self.root) - len(top)] if self.root.endswith(top) else ""
        folders = [(top, ())]
        for name, column in LEVELS:
            tests = [_test(f) for f in self.pushed.get(column, [])]
            inner = []
            for folder, values in folders:
                for f in self._children(filesystem, folder):
                    if f.is_file or not f.base_name.startswith(f"{name}="):
                        continue
                    value = _value(name, f.base_name[len(name) + 1:])
                    if all(t(value) for t in tests):
                        inner.append((f.path, (*values, value)))
            folders = inner
        return [Archive(scheme + f.path, values) for folder, values in folders
                for f in self._children(filesystem, folder) if f.is_file and f.base_name.endswith(".zip")]

    def read(self, partition: Archive | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no archive at all
            return
        filesystem, path = arrow_fs(partition.path)
        with filesystem.open_input_file(path) as raw, zipfile.ZipFile(raw) as archive:
            rows = []
            for row in csv_rows(archive):
                rows.append(row)
                if len(rows) >= BATCH_ROWS:
                    yield _batch(rows, partition.values)
                    rows = []
            if rows:
                yield _batch(rows, partition.values)


def _batch(rows: list[dict], values: tuple) -> pa.RecordBatch:
    n = len(rows)
    kinds = (pa.string(), pa.string(), pa.date32())
    cols = [pa.array([v] * n, k) for v, k in zip(values, kinds, strict=True)]
    # keys in order, so that the text identifies the row whatever the columns' order
    cols.append(pa.array([json.dumps(r, sort_keys=True) for r in rows], pa.string()))
    cols += [pa.array([r.get(f) for r in rows], pa.string()) for f in RAW_FIELDS]
    return pa.RecordBatch.from_arrays(cols, names=SCHEMA.names)


class ZipReports(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> ZipReader:
        return ZipReader(self.options["path"])


def zip_report_scan(spark: SparkSession, root: str, products: Sequence[str] | None = None,
                    since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """Rows of the landed archives in the columns of ``zip_csv_scan``.

    ``products`` and the request-day window [since, until) are pushed into the listing.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ZipReports)
    rows = spark.read.format(FORMAT).load(root)
    if products is not None:
        rows = rows.filter(F.col("product").isin(list(products)))
    if since is not None:
        rows = rows.filter(F.col("request_day") >= F.lit(since))
    if until is not None:
        rows = rows.filter(F.col("request_day") < F.lit(until))
    start = F.concat(F.date_format("request_day", "yyyy-MM-dd"), F.lit("T00:00:00Z"))
    return rows.select("product", "direction_requested", start.alias("request_start"), "raw_json", *[F.col(f"raw_{f}").alias(f) for f in RAW_FIELDS])
