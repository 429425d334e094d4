"""Land fixture DataFrames as the raw files each source reads.

Used by the round-trip queries and the tests: the fixture views are written in
the vendors' raw layouts (gzip CSV parts + manifests, zipped CSV reports,
JSON pages, invoice CSVs) under the shared scratch folder, then read back
through ``costframe.sources``.  Files that Spark's writers cannot name (zips,
dated invoice CSVs) are written by the executors, one bounded group each,
through ``pyarrow.fs`` so any shared file system works.
"""

from __future__ import annotations

import io
import json
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.dates import billing_period
from .session import FREE_SHUFFLES, settings
from .sources import files
from .sources.cur import manifest_path


def _open_output(path: str):
    filesystem, inner = files.arrow_fs(path)
    filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return filesystem.open_output_stream(inner)


# Rows per report part.  A gzip part is read by one task, so it must not grow with its period.
CUR_PART_ROWS = 250_000
# Parts that a writer keeps open, one a period; rows of further periods are sorted first.
CUR_OPEN_PARTS = 120


def land_cur(spark: SparkSession, raw: DataFrame, bucket_root: str, report: str,
             assembly: str = "assembly-1", part_rows: int = CUR_PART_ROWS) -> list[str]:
    """Write raw report rows as gzip CSV parts per billing period and one
    manifest per period naming them.  Returns the periods written.

    Every task writes its own rows, a part open for each of their periods and
    a new one after ``part_rows``: the raw text, several times the size of what
    it is made from, is neither shuffled nor sorted.  The rows are counted first
    (one number comes to the driver), so that the writers, and with them the
    parts, follow the size of the report and not the pieces that it comes in.
    """
    base = f"{bucket_root.rstrip('/')}/{report}"
    date_text = F.col("`lineItem/UsageStartDate`")
    staged = raw.withColumn("_period", billing_period(F.substring(date_text, 1, 10).cast("date")))
    data_dir = f"{base}/_parts/{assembly}"
    with settings(spark, FREE_SHUFFLES | {"spark.sql.maxConcurrentOutputFileWriters": str(CUR_OPEN_PARTS)}):
        writers = max(2, spark.sparkContext.defaultParallelism, -(-raw.count() // part_rows))
        (staged.coalesce(writers)
               .write.mode("overwrite").option("header", True).option("compression", "gzip")
               .option("escape", '"').option("maxRecordsPerFile", part_rows).partitionBy("_period").csv(data_dir))
    columns = [dict(zip(("category", "name"), c.split("/", 1))) if "/" in c else {"category": "", "name": c}
               for c in raw.columns]
    periods = []
    for folder in files.glob(spark, f"{data_dir}/_period=*"):
        period = folder.rsplit("=", 1)[1]
        keys = [files.relative_to(p, bucket_root) for p in files.list_files(spark, folder, ".csv.gz")]
        manifest = {"assemblyId": assembly, "reportKeys": keys, "columns": columns}
        files.write_text(spark, manifest_path(bucket_root, report, period), json.dumps(manifest))
        periods.append(period)
    return periods


# Rows per landed file part: a pull larger than this is split into parts, so
# no writer task ever holds more than one part in memory.
PART_ROWS = 50_000


def _parts(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Spread each group over ceil(rows / PART_ROWS) parts by a row hash.

    The per-group counts are a partial aggregate (one row per group); rows
    never wait in one task for their group, however large it is.
    """
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    cond = [df[c].eqNullSafe(counts[c]) for c in by]
    joined = df.join(counts, cond, "inner").select(df["*"], counts["_n"])
    n_parts = F.ceil(F.col("_n") / F.lit(PART_ROWS)).cast("long")
    return joined.withColumn("_part", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cols]), n_parts)).drop("_n")


def land_cdr(spark: SparkSession, raw: DataFrame, root: str) -> int:
    """Write each (product, requested direction, request day) pull as zip
    parts under ``product=/direction=/start=`` folders; a text member
    precedes the CSV in every zip."""
    root = root.rstrip("/")
    cols = [c for c in raw.columns if c not in ("product", "direction_requested", "request_start")]
    keyed = _parts(raw.withColumn("_start", F.substring("request_start", 1, 10)),
                   ["product", "direction_requested", "_start"], cols)

    def write_zip(pdf: pd.DataFrame) -> pd.DataFrame:
        prod = pdf["product"].iloc[0]
        direc = pdf["direction_requested"].iloc[0]
        start = pdf["_start"].iloc[0]
        part = int(pdf["_part"].iloc[0])
        folder = "__HIVE_DEFAULT_PARTITION__" if direc is None or pd.isna(direc) else direc
        path = f"{root}/product={prod}/direction={folder}/start={start}/report-{part:05d}.zip"
        text = io.StringIO()
        pdf[cols].to_csv(text, index=False)
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("readme.txt", "report export\n")
            zf.writestr("report.csv", text.getvalue())
        with _open_output(path) as out:
            out.write(data.getvalue())
        return pd.DataFrame({"rows": [len(pdf)]})

    done = keyed.groupBy("product", "direction_requested", "_start", "_part").applyInPandas(
        write_zip, "rows long")
    return done.agg(F.sum("rows")).first()[0] or 0


def land_pages(spark: SparkSession, buckets: DataFrame, root: str, days_per_page: int = 7) -> None:
    """Write buckets as JSON pages (one page object per line), a week of
    buckets per page."""
    page = F.floor(F.datediff(F.substring("starting_at", 1, 10).cast("date"), F.lit("1970-01-01"))
                   / days_per_page).cast("bigint")
    pages = (buckets.withColumn("_page", page)
             .groupBy("_page").agg(F.collect_list(F.struct("starting_at", "ending_at", "results")).alias("data"))
             .select("data", F.lit(True).alias("has_more"),
                     F.concat(F.lit("page_"), (F.col("_page") + 1).cast("string")).alias("next_page")))
    pages.write.mode("overwrite").json(root)


def land_invoices(spark: SparkSession, raw: DataFrame, root: str) -> int:
    """Write one CSV per invoice file name (the name carries the month); a
    file beyond the part size is split into numbered parts of that name."""
    root = root.rstrip("/")
    cols = [c for c in raw.columns if c != "file_name"]
    keyed = _parts(raw, ["file_name"], cols)

    def write_csv(pdf: pd.DataFrame) -> pd.DataFrame:
        name, part = pdf["file_name"].iloc[0], int(pdf["_part"].iloc[0])
        if part:
            stem, dot, ext = name.rpartition(".")
            name = f"{stem}-part{part}{dot}{ext}"
        path = f"{root}/{name}"
        with _open_output(path) as out:
            out.write(pdf[cols].to_csv(index=False).encode("utf-8"))
        return pd.DataFrame({"rows": [len(pdf)]})

    done = keyed.groupBy("file_name", "_part").applyInPandas(write_csv, "rows long")
    return done.agg(F.sum("rows")).first()[0] or 0
