"""Session defaults and the shared scratch folder.

The library never builds its own cluster settings into the queries: it only
needs the session time zone to be UTC (timestamps in the landed data are UTC
instants) and a shared folder for tables it writes on the way (upsert targets,
landed fixture files, streaming checkpoints).  That folder is the one the
cluster names in ``spark.checkpoint.dir``; a private one is made only when the
session has none, as in local tests.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

_LOCAL_FALLBACK: dict[int, str] = {}


def get_session(master: str | None = None, app: str = "costframe",
                shuffle_partitions: int | None = None, extra_conf: dict | None = None) -> SparkSession:
    """A session with the settings every job here assumes.

    AQE stays on (runtime coalescing of small shuffle partitions, skew-join
    splitting, broadcast conversion only when a side is measured small).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master and master.startswith("local"):
        # One machine, local disk: listing day folders serially on the driver
        # beats a listing job.  Clusters keep the distributed listing.
        builder = (builder.config("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000")
                   # local disk: no .crc side file per data file (Parquet
                   # checksums its own pages); halves file-system calls.
                   .config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
                   .config("spark.hadoop.fs.file.impl.disable.cache", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library relies on to any session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# Shuffle files go when their query ends (Spark 4.1; an older one keeps them until a driver's GC).
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the queries of one block; then as they were before."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    Order: ``spark.checkpoint.dir`` from the session conf, then the
    SparkContext's conf and checkpoint dir; only when all are unset (local
    tests) a private temp folder is made and registered as the checkpoint dir.
    """
    try:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001 - unset conf raises on some versions
        conf_dir = None
    if conf_dir:
        return conf_dir.rstrip("/")
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    ctx_dir = sc.getCheckpointDir()
    if ctx_dir:
        return ctx_dir.rstrip("/")
    key = id(sc)
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir is not set: intermediate tables need a folder that all executors share")
    if key not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[key] = tempfile.mkdtemp(prefix="costframe-ckpt-")
        sc.setCheckpointDir(_LOCAL_FALLBACK[key])
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared scratch root."""
    return f"{scratch_root(spark)}/costframe/{name}-{uuid.uuid4().hex[:12]}"


def as_local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python file APIs can open local paths."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path
