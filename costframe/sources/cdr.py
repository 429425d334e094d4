"""Zipped call/message report scan.

Landed layout: ``<root>/product=<P>/direction=<D>/start=<YYYY-MM-DD>/*.zip``,
one zip per pulled report (a product without direction is landed under
``direction=__HIVE_DEFAULT_PARTITION__``, which reads back as NULL).  Folder
names become the landing columns by partition discovery, so a product list
is a partition filter.

The only Python on executors is the unzip: each zip is one row of the
``binaryFile`` source, ``mapInPandas`` streams its first CSV member out as
one JSON object per row in bounded batches, and Spark types the text with
``from_json``.  Absent CSV columns read as NULL, present-but-empty ones as ''.
"""

from __future__ import annotations

import csv
import datetime as dt
import io
import json
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw report fields typed by the scan (others stay in raw_json).
RAW_FIELDS = [
    "account_id", "message_id", "call_id", "uuid", "id", "direction", "from", "to", "network",
    "network_name", "country", "country_name", "date_received", "date_finalized", "date_start",
    "date_end", "creation_date", "status", "currency", "total_price", "client_ref", "duration",
]

BATCH_ROWS = 10_000
_ROW_SCHEMA = ("product string, direction_requested string, request_start string, path string, "
               "row_no long, raw_json string")


def _open_path(path: str):
    """A seekable file for a Spark file path, opened in the task."""
    from .files import arrow_fs

    filesystem, inner = arrow_fs(path)
    return filesystem.open_input_file(inner)


def csv_rows(zf: zipfile.ZipFile) -> Iterator[dict]:
    """The rows of an archive's first CSV member, streamed."""
    member = next((n for n in zf.namelist() if n.endswith(".csv")), None)
    if member is None:
        return
    with zf.open(member) as fh:
        yield from csv.DictReader(io.TextIOWrapper(fh, encoding="utf-8", newline=""), restkey="null")


def _zip_rows(zf: zipfile.ZipFile, meta: tuple, cols: list[str]) -> Iterator[pd.DataFrame]:
    buf = []
    for n, row in enumerate(csv_rows(zf)):
        # keys in order, so that the text identifies the row whatever the columns' order
        buf.append((*meta, n, json.dumps(row, sort_keys=True)))
        if len(buf) >= BATCH_ROWS:
            yield pd.DataFrame(buf, columns=cols)
            buf = []
    if buf:
        yield pd.DataFrame(buf, columns=cols)


_COLS = ["product", "direction_requested", "request_start", "path", "row_no", "raw_json"]


def _unzip_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Zips whose bytes came with the row (binaryFile ``content``)."""
    for pdf in batches:
        for prod, direc, start, path, content in zip(pdf["product"], pdf["direction_requested"],
                                                     pdf["request_start"], pdf["path"], pdf["content"]):
            with zipfile.ZipFile(io.BytesIO(bytes(content))) as zf:
                yield from _zip_rows(zf, (prod, direc, start, path), _COLS)


def _unzip_paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Zips opened by path in the task: only the current batch is in memory."""
    for pdf in batches:
        for prod, direc, start, path in zip(pdf["product"], pdf["direction_requested"],
                                            pdf["request_start"], pdf["path"]):
            with _open_path(path) as fh, zipfile.ZipFile(fh) as zf:
                yield from _zip_rows(zf, (prod, direc, start, path), _COLS)


def zip_csv_scan(spark: SparkSession, root: str, products: Sequence[str] | None = None,
                 since: dt.date | None = None, until: dt.date | None = None,
                 read_content: bool = True) -> DataFrame:
    """Rows of every landed zip: landing columns + typed raw fields + raw_json.

    ``products`` and the request-day window [since, until) are partition
    filters, applied to the file listing before anything is unzipped.
    ``read_content=False`` selects only the path (binaryFile then reads no
    bytes) and each task streams its zip from the file system, for reports
    too large to carry as one row.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(root)
    if products is not None:
        files = files.filter(F.col("product").isin(list(products)))
    if since is not None:
        files = files.filter(F.col("start").cast("date") >= F.lit(since))
    if until is not None:
        files = files.filter(F.col("start").cast("date") < F.lit(until))
    landed = files.select(
        F.col("product").cast("string").alias("product"),
        F.col("direction").cast("string").alias("direction_requested"),
        F.concat(F.date_format(F.col("start").cast("date"), "yyyy-MM-dd"),
                 F.lit("T00:00:00Z")).alias("request_start"),
        "path", *(["content"] if read_content else []))
    rows = landed.mapInPandas(_unzip_rows if read_content else _unzip_paths, _ROW_SCHEMA)
    schema = T.StructType([T.StructField(f, T.StringType()) for f in RAW_FIELDS])
    typed = rows.withColumn("r", F.from_json("raw_json", schema))
    return typed.select("product", "direction_requested", "request_start", "raw_json",
                        *[F.col("r").getField(f).alias(f) for f in RAW_FIELDS])
