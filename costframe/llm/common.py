"""Helpers shared by the operators: paths, packed text access and word hashing.

The numpy helpers see texts where Arrow keeps them: one byte buffer and an
offsets array.  A batch is walked in slices of about ``limit`` bytes, so the
scratch arrays of a task stay small however long its input is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costframe.session import scratch_path

U = np.uint64
#: Fixed odd multiplier of the prefix hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)
#: Bytes hashed at once; a longer run of words is hashed in several steps.
HASH_SPAN = 1 << 19
SLICE_BYTES = 1 << 19

_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, U), "down": np.ones(1, U)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the lineage
    at committed files, which outlive any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(name: str = "text"):
    """The text column with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of BASE and of its inverse; kept between batches."""
    if len(_POWERS["up"]) < n:
        for key, base in (("up", BASE), ("down", BASE_INV)):
            a = np.full(n, base, U)
            a[0] = 1
            np.multiply.accumulate(a, out=a)
            _POWERS[key] = a
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits (shifts and odd multipliers)."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def packed(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, offsets, data = col.buffers()
    if len(col) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, off


def text_slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of whole texts of about ``limit`` bytes."""
    buf, off = packed(col)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def spaces(buf: np.ndarray) -> np.ndarray:
    """True where a byte is 20 or 09 to 0D (hexadecimal)."""
    return (buf == 32) | ((buf - np.uint8(9)) <= 4)


def word_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of adjacent texts, and where each text's words begin (n + 1)."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word = ~spaces(buf)
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, off, "left")


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return np.where((buf - np.uint8(65)) <= 25, buf | np.uint8(32), buf)


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; spans ascend and don't overlap."""
    out = np.empty(len(starts), U)
    i, n = 0, len(starts)
    while i < n:
        a = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, a + HASH_SPAN, "right")))
        s, e = starts[i:j] - a, ends[i:j] - a
        part = buf[a:a + int(e[-1])]
        up, down = powers(max(len(part), HASH_SPAN) + 1)
        run = np.empty(len(part) + 1, U)
        run[0] = 0
        np.cumsum((part.astype(U) + U(1)) * up[:len(part)], out=run[1:])
        out[i:j] = (run[e] - run[s]) * down[s]
        i = j
    return mix(out + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the windows of ``n`` successive word hashes (none if there are fewer words)."""
    if len(words) < n:
        return np.zeros(0, U)
    g = words[:len(words) - n + 1].copy()
    for k in range(1, n):
        g = g * U(0xC2B2AE3D27D4EB4F) + words[k:len(words) - n + 1 + k]
    return mix(g)


def sums_by(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between successive ``bounds`` (n + 1 of them), 0 for an empty run."""
    run = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return run[bounds[1:]] - run[bounds[:-1]]


def bitmap_of(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of a column of long hashes modulo ``bits``, in pieces of 4 KB that Spark puts together.

    It takes ``bits`` / 8 bytes, however many hashes there are; a full one passes everything.
    """
    at = F.pmod(F.col(hashes.columns[0]), F.lit(bits))
    pieces = (hashes.select(F.floor(at / 32768).cast("int").alias("piece"), (at % 32768).alias("bit"))
              .groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("map")).collect())
    out = np.zeros((-(-bits // 32768), 4096), np.uint8)
    for r in pieces:
        out[r.piece] = np.frombuffer(bytes(r.map), np.uint8)
    return out.ravel()


def in_bitmap(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
