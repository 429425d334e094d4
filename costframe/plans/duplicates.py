"""Duplicate keys without moving the keys.

Keys that are claimed unique don't combine, so counting them by a group-by sends
every key of the table through a shuffle.  Here a first scan sends only places
in a hash space, sorted and packed to a few bytes a row; a place seen twice is a
suspect.  A second scan keeps the rows at a suspect's place, and only those are
shuffled and counted by their keys.  Equal keys have equal places, so no
duplicate is lost, and the count by keys drops the ones that merely clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import scratch_path
from .checks import duplicate_keys

#: Suspects that are broadcast at most, 8 bytes each; a table with more is counted by its keys.
SUSPECT_LIMIT = 1 << 22
#: Places that a task sorts at once.
RUN = 1 << 22
#: Places of a part of the hash space that meet in one call, about.
PART = 1 << 23
PACKED = "part long, places long, width int, data binary"


def hash_bits(rows: int) -> int:
    """Bits of the hash space for a table of ``rows``: 64 places a row at least, and
    so many that no more than about 2**19 pairs of different keys share a place."""
    return min(62, max(16, max(rows * 64, rows * rows >> 20).bit_length()))


def place(keys: Sequence[str], bits: int) -> Column:
    """Where a key lies in a hash space of 2**bits places."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits)


def _packed(places: np.ndarray, shift: int) -> Iterator[dict]:
    """The run's places by part, each at most twice, as steps from one to the next."""
    places = np.sort(places)
    keep = np.ones(len(places), bool)
    keep[2:] = places[2:] != places[:-2]
    places = places[keep]
    part = places >> shift
    cuts = np.flatnonzero(np.diff(part)) + 1
    for run in np.split(places, cuts):
        number = int(run[0] >> shift)
        steps = np.diff(run, prepend=number << shift)
        steps = steps.astype(np.min_scalar_type(steps.max()))
        yield {"part": number, "places": len(run), "width": steps.itemsize,
               "data": pa.compress(steps.tobytes(), codec="zstd", asbytes=True)}


def _twice(part: int, runs: list[tuple[int, int, bytes]], shift: int) -> np.ndarray:
    """The places that occur more than once in the packed runs of a part."""
    every = np.empty(sum(n for n, _, _ in runs), np.int64)
    at = 0
    for n, width, data in runs:
        steps = np.frombuffer(pa.decompress(data, n * width, codec="zstd", asbytes=True), f"u{width}")
        np.cumsum(steps, dtype=np.int64, out=every[at:at + n])
        at += n
    every += part << shift
    every.sort()
    return np.unique(every[1:][every[1:] == every[:-1]])


def suspects(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """(place): the places in the hash space at which two rows or more lie.

    What moves is one packed run for each (run of a task, part).  A part holds
    about ``PART`` places by the hash's spread, and a key, however frequent, has
    two of them in a run at most, so a part's size doesn't depend on hot keys.
    """
    bits = hash_bits(rows)
    shift = bits - min(bits - 1, (rows // PART).bit_length())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int64()), ("places", pa.int64()), ("width", pa.int32()), ("data", pa.binary())])
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy())
            n += batch.num_rows
            if n >= RUN:
                yield pa.RecordBatch.from_pylist(list(_packed(np.concatenate(held), shift)), schema)
                held, n = [], 0
        if n:
            yield pa.RecordBatch.from_pylist(list(_packed(np.concatenate(held), shift)), schema)

    def meet(runs: pa.Table) -> pa.Table:
        part = runs.column("part")[0].as_py()
        cols = (runs.column(c).to_pylist() for c in ("places", "width", "data"))
        return pa.table({"place": pa.array(_twice(part, list(zip(*cols)), shift), pa.int64())})

    packed = df.select(place(keys, bits).alias("place")).mapInArrow(pack, PACKED)
    return packed.groupBy("part").applyInArrow(meet, "place long")


def duplicate_keys_by_suspects(df: DataFrame, keys: Sequence[str], limit: int = SUSPECT_LIMIT) -> DataFrame:
    """Keys that occur more than once, with their count: the rows of :func:`duplicate_keys`.

    Reads ``df`` three times: its number of rows (from footers, for Parquet), its
    keys for the suspects, its keys again for the rows at their places.  The
    suspects are staged in the shared scratch folder and counted on the way; up
    to ``limit`` they are broadcast.  Beyond it (a table full of duplicates)
    the keys are counted straight.  Null keys count as equal, as in a group-by.
    """
    spark = df.sparkSession
    df = df.select(*keys)
    rows = df.count()
    path, seen = scratch_path(spark, "suspects"), Observation()
    suspects(df, keys, rows).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    if seen.get.get("n", 0) > limit:
        return duplicate_keys(df, keys)
    at = "place"
    while at in (c.lower() for c in df.columns):
        at = "_" + at
    found = spark.read.schema("place long").parquet(path).withColumnRenamed("place", at)
    rows_there = df.withColumn(at, place(keys, hash_bits(rows))).join(F.broadcast(found), at, "left_semi")
    return duplicate_keys(rows_there, keys)
