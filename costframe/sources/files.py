"""File-system helpers on the cluster's Hadoop file system (metadata only).

These list and write *small* control files (manifests); data files are always
read and written by Spark itself.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob; an unmatched pattern gives [] (no PATH_NOT_FOUND)."""
    fs, hpath = _fs(spark, pattern)
    found = fs.globStatus(hpath)
    if found is None:
        return []
    return sorted(str(s.getPath().toString()) for s in found)


def glob_any(spark: SparkSession, pattern: str) -> bool:
    """Whether anything matches a glob."""
    fs, hpath = _fs(spark, pattern)
    found = fs.globStatus(hpath)
    return found is not None and len(found) > 0


def list_files(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    """Data files directly inside ``folder`` (no recursion), by name suffix."""
    fs, hpath = _fs(spark, folder)
    if not fs.exists(hpath):
        return []
    return sorted(str(s.getPath().toString()) for s in fs.listStatus(hpath)
                  if s.isFile() and s.getPath().getName().endswith(suffix)
                  and not s.getPath().getName().startswith(("_", ".")))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small text file (a manifest) through the Hadoop file system."""
    fs, hpath = _fs(spark, path)
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return bool(fs.exists(hpath))


def size(spark: SparkSession, path: str) -> int:
    """Bytes under a folder (file-system metadata only)."""
    fs, hpath = _fs(spark, path)
    return int(fs.getContentSummary(hpath).getLength()) if fs.exists(hpath) else 0


def relative_to(path: str, root: str) -> str:
    """``path`` relative to ``root`` when it lies under it (scheme-insensitive)."""
    def strip(p: str) -> str:
        for scheme in ("file://", "file:"):
            if p.startswith(scheme):
                return p[len(scheme):]
        return p
    p, r = strip(path), strip(root).rstrip("/")
    return p[len(r) + 1:] if p.startswith(r + "/") else p


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a folder this library created (its own staging data)."""
    fs, hpath = _fs(spark, path)
    return bool(fs.delete(hpath, True)) if fs.exists(hpath) else False


def move(spark: SparkSession, source: str, to: str) -> None:
    """Rename a folder inside one file system; what is at ``to`` is replaced."""
    fs, hpath = _fs(spark, source)
    target = _fs(spark, to)[1]
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(hpath, target):
        raise OSError(f"could not rename {source} to {to}")


def csv_headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each header, its names in order; blank names go by their place.

    One job reads the first record of every file (gzip or plain, a line break in
    a quoted name included) and no more of it; files without a record are left out.
    """
    def read(batches):
        import csv
        import gzip
        import io

        for pdf in batches:
            found = []
            for path in pdf["path"]:
                filesystem, inner = arrow_fs(path)
                with filesystem.open_input_stream(inner, compression=None) as raw:
                    data = gzip.GzipFile(fileobj=raw) if inner.endswith(".gz") else raw
                    record = next(csv.reader(io.TextIOWrapper(data, encoding="utf-8-sig", newline="")), None)
                found.append([n or f"_c{i}" for i, n in enumerate(record)] if record else None)
            yield pdf.assign(header=found)

    if not paths:
        return {}
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), 200))
    out: dict[tuple[str, ...], list[str]] = {}
    for r in sorted(listed.mapInPandas(read, "path string, header array<string>").where("header IS NOT NULL").collect(), key=lambda r: r.path):
        out.setdefault(tuple(r.header), []).append(r.path)
    return out


def arrow_fs(path: str):
    """(pyarrow file system, path inside it) for a Spark file path, so Python
    code in tasks reads and writes the same shared folders as Spark
    (local ``file:`` paths, hdfs, s3/s3a, gs)."""
    from pyarrow import fs as pafs

    if path.startswith("file:"):
        local = path[len("file:"):]
        while local.startswith("//"):
            local = local[1:]
        return pafs.LocalFileSystem(), local
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    if path.startswith("s3a://"):
        path = "s3://" + path[len("s3a://"):]
    return pafs.FileSystem.from_uri(path)
