"""Typed load, keyed upsert and day-partitioned writes (K1-K8).

The reference stages each load into a truncated table and runs a MERGE that
updates matched keys and inserts the rest, never deleting.  Here:

* :func:`conform` is the typed staging projection with the REQUIRED check.
* :func:`collapse_loads` turns one or many loads into one row per key
  (highest load ordinal wins; a key twice inside one load fails the job).
  One window on the key: one shuffle, one sort.
* :func:`merge` is the MERGE as a plan: target anti-join source keys, union
  source.  Catalyst/AQE pick broadcast only when the source side is measured
  small, sort-merge otherwise.
* :func:`upsert_table` runs it against a day-partitioned Parquet table,
  touching only the days the source carries (listed by name, replaced by
  dynamic partition overwrite), with one exchange: rows of the load and of
  those days meet in the hash layout that the days are written in.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import FREE_SHUFFLES, scratch_path, settings
from ..sources import files

ORDINAL = "load_ordinal"
DUPLICATE = "duplicate key inside one load"


def conform(df: DataFrame, schema: T.StructType, required: Sequence[str] = (),
            keep: Sequence[str] = ()) -> DataFrame:
    """Select the schema's columns in order, cast to its types; a NULL in a
    required column fails the job (K1).  ``keep`` carries bookkeeping columns
    (a load ordinal) after the schema's."""
    cols = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`").cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if f.name in required:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"required column {f.name} is NULL"))
                       .cast(f.dataType)).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols, *[F.col(k) for k in keep])


def collapse_loads(source: DataFrame, keys: Sequence[str], ordinal: str | None = None,
                   on_duplicate: str = "raise") -> DataFrame:
    """One row per key out of one or more loads (lazy).

    ``ordinal`` orders the loads (later wins, as when loads are merged one
    after another).  A key present twice in the same load raises (the
    default) or, with ``on_duplicate='any'``, keeps one of them.

    One window over the key: a single shuffle on the key and one sort by
    (key, ordinal desc).  Inside a key, two neighbours with the same ordinal
    are a duplicate within one load.
    """
    keys = list(keys)
    src = source if ordinal else source.withColumn(ORDINAL, F.lit(0))
    ordc = ordinal or ORDINAL
    w = Window.partitionBy(*keys).orderBy(F.col(ordc).desc())
    marked = src.withColumn("_rn", F.row_number().over(w)).withColumn("_next", F.lead(ordc).over(w))
    keep = F.col("_rn") == 1
    if on_duplicate == "raise":
        keep = F.when(F.col("_next") == F.col(ordc), F.raise_error(F.concat(
            F.lit(DUPLICATE + ": "),
            F.to_json(F.struct(*[F.col(k) for k in keys]))))).otherwise(keep)
    return marked.filter(keep).select(*[c for c in source.columns if c != ordc])


def aligned(source: DataFrame, target: DataFrame) -> DataFrame:
    """``source`` in the target's column order; columns that the target lacks fail the load."""
    extra = [c for c in source.columns if c not in target.columns]
    if extra:
        raise ValueError(f"the target table has no column {', '.join(extra)}")
    return source.select(*target.columns)


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE: matched keys take every non-key column from the source (NULLs
    included), unmatched source keys are inserted, target-only keys stay (K2)."""
    keys = list(keys)
    kept = target.join(source.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(aligned(source, target))


def replace_days(target: DataFrame, source: DataFrame, date_col: str = "usage_date") -> DataFrame:
    """Whole days in the source replace the same days in the target (K6)."""
    days = source.select(date_col).distinct()
    kept = target.join(days, on=date_col, how="left_anti")
    return kept.unionByName(aligned(source, target))


# Target bytes of Parquet per write task (and so per file).
WRITE_PART_BYTES = 256 << 20
# Bytes of Parquet merged at once, in all or per core if that is more; a load well beyond has about so many waves.
WAVE_BYTES = 128 << 20
WAVE_CORE_BYTES = 16 << 20
MOST_WAVES = 16


def write_table(df: DataFrame, path: str, date_col: str = "usage_date", new_table: bool = False) -> None:
    """Day-partitioned Parquet write that replaces only the days present (K4).

    The rebalance hint leaves the layout to AQE; loads come through
    :func:`upsert_table`, which lays days out by their sizes.
    """
    _write_days(df.hint("rebalance", date_col), path, date_col, new_table)


def _write_days(df: DataFrame, path: str, date_col: str, new_table: bool) -> None:
    if new_table:
        # A table that does not exist yet has no days to keep: plain write,
        # no per-day replace step.
        df.write.mode("errorifexists").partitionBy(date_col).parquet(path)
        return
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(date_col)
       .parquet(path))


def read_days(spark: SparkSession, path: str, days: Sequence,
              date_col: str = "usage_date") -> DataFrame | None:
    """Only the given day folders of a day-partitioned table, found by one listing
    of folder names; no other day is opened.  ``None`` when none of the days exists yet."""
    present = day_folders(spark, path, days, date_col)
    if not present:
        return None
    return spark.read.option("basePath", path).parquet(*present)


def day_bytes(spark: SparkSession, path: str, days: Sequence, date_col: str = "usage_date") -> dict[str, int]:
    """Bytes of those of ``days`` that the table has, by name: one glob over the folder names and
    a listing of the folders that match (no file is opened); as many rows reach the driver as days."""
    pattern = f"{path.rstrip('/')}/{date_col}={{{','.join(sorted(str(d) for d in days))}}}"
    if not days or not files.glob_any(spark, pattern):
        return {}
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(pattern)
    day = F.regexp_extract("path", f"/{date_col}=([0-9-]+)/", 1).alias("day")
    return {r.day: r.bytes for r in listed.groupBy(day).agg(F.sum("length").alias("bytes")).collect()}


def day_folders(spark: SparkSession, path: str, days: Sequence, date_col: str = "usage_date") -> list[str]:
    """The folders of those of ``days`` that the table has."""
    return [f"{path.rstrip('/')}/{date_col}={d}" for d in sorted(day_bytes(spark, path, days, date_col))]


def day_layout(sizes: dict, least_tasks: int, part_bytes: int = WRITE_PART_BYTES) -> list[tuple]:
    """(day, pack, parts) for days of the given sizes in bytes.

    A write task gets ``part_bytes``, or less where that would leave fewer than
    ``least_tasks``.  Successive small days share a pack; a day well above a
    task's share is a pack of its own, cut into ``parts``.
    """
    total = sum(sizes.values())
    tasks = max(1, -(-total // part_bytes), min(len(sizes), least_tasks))
    share = max(1, -(-total // tasks))
    out, pack, held = [], 0, 0
    for day in sorted(sizes):
        size = sizes[day]
        if 2 * size > 3 * share:
            pack, held = pack + (held > 0), 0
            out.append((day, pack, -(-size // share)))
            pack += 1
            continue
        if held and held + size > share:
            pack, held = pack + 1, 0
        out.append((day, pack, 1))
        held += size
    return out


def day_waves(sizes: dict, limit: int) -> list[dict]:
    """``sizes`` cut into runs of successive days of ``limit`` bytes at most; a larger day is a run of its own."""
    waves: list[dict] = []
    held = 0
    for day in sorted(sizes):
        if not waves or held + sizes[day] > limit:
            waves.append({})
            held = 0
        waves[-1][day] = sizes[day]
        held += sizes[day]
    return waves


def merged_days(loads: DataFrame, target: DataFrame | None, keys: Sequence[str], layout: DataFrame, tasks: int,
                date_col: str, ordinal: str | None, keep_ordinal: bool) -> DataFrame:
    """One row per key of ``loads`` and the ``target`` days, in the layout that they are written in.

    One exchange on (pack, part of the key's hash) and one sort do all: the
    sort puts the rows of a key together, the winner first, so that the window
    finds later loads, duplicates inside a load and the target's own row.  The
    winner is the load's, of the highest ordinal; with ``keep_ordinal`` the
    target's stored ordinal competes, and the load's wins a tie.
    """
    keys, ordc = list(keys), ordinal or ORDINAL
    src = loads if ordinal else loads.withColumn(ORDINAL, F.lit(0))
    cols = [c for c in (target if target is not None else loads).columns if c != ordc]
    rows = aligned(src.drop(ordc), target.drop(ordc)) if target is not None else src.drop(ordc)
    rows = src.select(*rows.columns, F.col(ordc), F.lit(1).alias("_side"))
    if target is not None:
        if keep_ordinal and ordc not in target.columns:
            raise ValueError(f"the target table has no column {ordc}")
        own = F.col(ordc) if keep_ordinal else F.lit(None).cast(src.schema[ordc].dataType).alias(ordc)
        rows = rows.unionByName(target.select(*cols, own, F.lit(0).alias("_side")))
    parts = F.pmod(F.hash(*[k for k in keys if k != date_col] or [date_col]), F.col("_parts"))
    rows = rows.join(F.broadcast(layout), date_col).withColumn("_part", parts).repartition(tasks, "_pack", "_part")
    first = [F.col(ordc).desc_nulls_last(), F.col("_side").desc()]
    w = Window.partitionBy(date_col, "_pack", "_part", *[k for k in keys if k != date_col]).orderBy(*(first if keep_ordinal else first[::-1]))
    marked = rows.withColumns({"_rn": F.row_number().over(w), "_next": F.lead(ordc).over(w), "_next_side": F.lead("_side").over(w)})
    twice = (F.col("_side") == 1) & (F.col("_next_side") == 1) & F.col(ordc).eqNullSafe(F.col("_next"))
    message = F.concat(F.lit(DUPLICATE + ": "), F.to_json(F.struct(*keys)))
    kept = marked.filter(F.when(twice, F.raise_error(message)).otherwise(F.col("_rn") == 1))
    return kept.select(*cols, *([ordc] if keep_ordinal else [])).sortWithinPartitions(date_col)


def upsert_days(spark: SparkSession, target_path: str, source: DataFrame, keys: Sequence[str],
                date_col: str = "usage_date", ordinal: str | None = None,
                mode: str = "upsert", keep_ordinal: bool = False) -> tuple[dict, list]:
    """:func:`upsert_table`, with the list of the days that it replaced."""
    with settings(spark, FREE_SHUFFLES):
        return _upsert_days(spark, target_path, source, list(keys), date_col, ordinal, mode, keep_ordinal)


def _upsert_days(spark: SparkSession, target_path: str, source: DataFrame, keys: list[str], date_col: str,
                 ordinal: str | None, mode: str, keep_ordinal: bool) -> tuple[dict, list]:
    staged_path = scratch_path(spark, "staging")
    obs = Observation("staged")
    source.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(staged_path)
    staged_rows = obs.get.get("rows", 0)
    if not staged_rows:
        files.delete(spark, staged_path)
        return {"staged_rows": 0, "days": 0}, []
    staged = spark.read.schema(source.schema).parquet(staged_path)
    per_day = {r[0]: r[1] for r in staged.groupBy(date_col).agg(F.count(F.lit(1))).collect()}
    if None in per_day:
        raise ValueError(f"a row of the load has no {date_col}")
    days = sorted(per_day)
    new_table = not files.exists(spark, target_path)
    replaced = {} if new_table else day_bytes(spark, target_path, days, date_col)
    present = [f"{target_path.rstrip('/')}/{date_col}={d}" for d in sorted(replaced)]
    row_bytes = max(1, files.size(spark, staged_path) // staged_rows)
    sizes = {d: n * row_bytes + replaced.get(str(d), 0) for d, n in per_day.items()}
    target = spark.read.option("basePath", target_path).parquet(*present) if present else None
    if target is not None and mode == "replace_days":
        aligned(staged.drop(ordinal or ORDINAL), target)
        target = None
    cores = spark.sparkContext.defaultParallelism

    def merged(loads: DataFrame, rows: DataFrame | None, wave: dict) -> DataFrame:
        layout = day_layout(wave, 4 * cores)
        tasks = sum(parts for _, pack, parts in layout if parts > 1) + len({pack for _, pack, parts in layout if parts == 1})
        plan = spark.createDataFrame(layout, T.StructType([T.StructField(date_col, staged.schema[date_col].dataType),
                                                           T.StructField("_pack", T.IntegerType()), T.StructField("_parts", T.IntegerType())]))
        return merged_days(loads, rows, keys, plan, tasks, date_col, ordinal, keep_ordinal)

    waves = day_waves(sizes, max(WAVE_BYTES, cores * WAVE_CORE_BYTES, -(-sum(sizes.values()) // MOST_WAVES)))
    try:
        if len(waves) == 1:
            _write_days(merged(staged, target, sizes), target_path, date_col, new_table)
        else:
            _write_waves(spark, staged, target, waves, merged, staged_path, target_path, date_col, new_table)
    except Exception as e:
        found = re.search(rf"{DUPLICATE}: [^\n]*?\}}", str(e))
        if found:
            raise ValueError(found.group(0)) from e
        raise
    # The merged days are committed: the staging copy is no longer needed.
    # (On failure it stays, and a re-run stages afresh.)
    files.delete(spark, staged_path)
    return {"staged_rows": staged_rows, "days": len(days)}, days


def _write_waves(spark: SparkSession, staged: DataFrame, target: DataFrame | None, waves: list[dict],
                 merged: Callable[[DataFrame, DataFrame | None, dict], DataFrame], staged_path: str,
                 target_path: str, date_col: str, new_table: bool) -> None:
    """The merged days, wave by wave, beside the table; all move in when the last one is there.

    A wave opens the staged files that have its days (one row a file reaches the
    driver), and files that no later wave needs go after it, so that the disk
    holds a row about once: staged, in the wave's exchange, or merged.
    """
    spans = staged.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min(date_col).alias("first"), F.max(date_col).alias("last")).collect()
    folder, _, name = target_path.rstrip("/").rpartition("/")
    merging = f"{folder}/.{name}-merging-{uuid.uuid4().hex[:12]}"
    try:
        for wave in waves:
            first, last = min(wave), max(wave)
            of_wave = F.col(date_col).between(F.lit(first), F.lit(last))
            loads = spark.read.schema(staged.schema).parquet(*[f"{staged_path}/{s.file}" for s in spans if s.first <= last and s.last >= first]).filter(of_wave)
            rows = target.filter(of_wave) if target is not None else None
            merged(loads, rows, wave).write.mode("append").partitionBy(date_col).parquet(merging)
            for s in spans:
                if first <= s.last <= last:
                    files.delete(spark, f"{staged_path}/{s.file}")
        if new_table:
            files.move(spark, merging, target_path)
        else:
            for path in files.glob(spark, f"{merging}/{date_col}=*"):
                files.move(spark, path, f"{target_path.rstrip('/')}/{path.rsplit('/', 1)[1]}")
    finally:
        files.delete(spark, merging)


def upsert_table(spark: SparkSession, target_path: str, source: DataFrame, keys: Sequence[str],
                 date_col: str = "usage_date", ordinal: str | None = None,
                 mode: str = "upsert", keep_ordinal: bool = False) -> dict:
    """Load ``source`` into the day-partitioned table at ``target_path``.

    1. Stage the load as it is, flat Parquet in the shared scratch folder
       (no shuffle).  Staging cuts the lineage: a lost executor re-reads
       staged files, never the raw input.
    2. Empty load: nothing is touched (K7).
    3. Count the staged rows of each day (one column is read, counts combine
       map-side) and add the bytes of the target's files of those days: the layout.
    4. Merge the staged rows with those days of the target in that layout
       (:func:`merged_days`: one exchange) and overwrite them (dynamic
       partition overwrite).  A load beyond ``WAVE_BYTES`` goes in waves of
       successive days, an exchange each, whose shuffle files go before the
       next (:func:`_write_waves`).  A key twice inside one load fails the job
       before anything is replaced.

    ``keep_ordinal`` is the merge on condition: the table keeps the ordinal of
    the load that each row came from (from its first load on), and a row
    changes only if the load's ordinal is not older, so loads may arrive in any
    order.  Keys must not be null (``conform`` checks it).
    """
    return upsert_days(spark, target_path, source, keys, date_col, ordinal, mode, keep_ordinal)[0]


def load_summary(df: DataFrame, by: Sequence[str], date_col: str = "usage_date") -> DataFrame:
    """Rows staged per load and the days they span (K8)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"),
                               F.min(date_col).alias("first_date"),
                               F.max(date_col).alias("last_date"))
