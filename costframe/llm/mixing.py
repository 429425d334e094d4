"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target in words: the sources share ``total`` times all words
by their weights, none above ``most`` times its own words (water-filling).  A
document of a source with ratio r = target / size is taken floor(r) times, and
once more with probability r - floor(r).  The extra copies are drawn dependently:
two documents with open probabilities trade words, p_a s_a against p_b s_b, at
random but fair odds, until one of them is 0 or 1.  The words of the pair don't
change, so a source's taken words differ from its target by less than one
document, and every document keeps its probability.

Pairing is a reduction tree.  A leaf is a (hash bucket, source) cell; a task
reads its cells as a sorted stream and holds one open document at a time.  The
open ones of each cell meet in the next, coarser level, until one per source is
left, which is drawn by its own odds.  Order and draws come from hashes of id
and text; rows alike in both follow each other and draw by their rank among
them, so reruns agree whatever the partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costframe.llm.common import fresh_name, saved, table

WEIGHTS = (5, 2, 1)
TOTAL = 1.5
MOST = 2.0
#: Buckets of each level of the tree; the last has one cell for each source.
LEVELS = (1024, 32, 1)
SEED = 17
#: Turns a draw for each further row of equal rows; fixed value, the golden section, which spreads them evenly.
TURN = 0.6180339887498949


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Works on one row for each source.  In the order of cap / weight, the sources
    up to some point are held at their caps and the rest share what remains by
    weight: the first source whose cap its share does not exceed ends the run.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    by = by.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank - 1) % len(weights) + 1))
    by = by.withColumn("cap", F.col("source_size") * most)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tight = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    by = by.withColumns({
        "words": F.sum("source_size").over(everything) * total,
        "before": F.coalesce(F.sum("cap").over(tight.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "open": F.sum("weight").over(tight.rowsBetween(0, Window.unboundedFollowing))})
    level = (F.col("words") - F.col("before")) / F.col("open")
    by = by.withColumn("share", F.when(F.col("cap") / F.col("weight") >= level, level))
    return by.withColumn("level", F.max("share").over(everything)).select(
        "source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), "cap")).alias("target"))


def _play(size: np.ndarray, p: np.ndarray, draw: np.ndarray, cell: np.ndarray, carry):
    """Runs the stream on: (final p of each row, or nan if still open; the carry's final p, if it closed; new carry).

    ``carry`` is (cell, size, p) of an open document before these rows, or None;
    the new one is (cell, size, p, row), with row -1 for the old one.
    """
    out = np.full(len(p), np.nan)
    closed = None
    held = (*carry, -1) if carry else None
    ended = []
    for k in range(len(p)):
        if not 0 < p[k] < 1 or size[k] <= 0:
            out[k] = p[k] if size[k] > 0 else 0.0
            continue
        if held is not None and held[0] != cell[k]:
            ended.append(held)
            held = None
        if held is None:
            held = (cell[k], float(size[k]), float(p[k]), k)
            continue
        c, sa, pa_, row = held
        sb, pb = float(size[k]), float(p[k])
        gain, loss = min((1 - pa_) * sa, pb * sb), min(pa_ * sa, (1 - pb) * sb)
        if draw[k] * (gain + loss) < loss:
            if (1 - pa_) * sa <= pb * sb:
                a, b = 1.0, pb - gain / sb
            else:
                a, b = pa_ + gain / sa, 0.0
        elif pa_ * sa <= (1 - pb) * sb:
            a, b = 0.0, pb + loss / sb
        else:
            a, b = pa_ - loss / sa, 1.0
        a, b = min(max(a, 0.0), 1.0), min(max(b, 0.0), 1.0)
        held = None
        for value, s, r in ((a, sa, row), (b, sb, k)):
            if 0 < value < 1 and held is None:
                held = (c, s, value, r)
            elif r >= 0:
                out[r] = value
            else:
                closed = value
    return out, closed, held, ended


def _ranks(cell: np.ndarray, key: np.ndarray, before):
    """(rank of each row in its run of equal cell and key, the last run); ``before`` is the last run of the rows ahead."""
    if not len(key):
        return np.zeros(0), before
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])
    at = np.arange(len(key))
    rank = at - np.maximum.accumulate(np.where(new, at, 0))
    if before and before[:2] == (cell[0], key[0]):
        first = len(key) if new[1:].sum() == 0 else 1 + int(np.argmax(new[1:]))
        rank[:first] += before[2] + 1
    return rank, (cell[-1], key[-1], int(rank[-1]))


def _level(rows: DataFrame, buckets: int, names: dict[str, str], last: bool) -> DataFrame:
    """One level of the tree: every row with its ``p`` moved on (open ones strictly between 0 and 1)."""
    key, size, p, draw, cell = (names[c] for c in ("key", "size", "p", "draw", "cell"))
    rows = rows.withColumn(cell, F.xxhash64("source", F.col("source").isNull(), F.pmod(F.col(key), F.lit(buckets))))
    rows = rows.repartition(cell).sortWithinPartitions(cell, key, size, p)
    at = {c: rows.columns.index(names[c]) for c in names}
    n = len(rows.columns)

    def play(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def put(batch: pa.RecordBatch, value) -> pa.RecordBatch:
            cols = [pa.array(value, pa.float64()) if i == at["p"] else batch.column(i) for i in range(n)]
            return pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

        def end(row: pa.RecordBatch, value: float) -> pa.RecordBatch:
            """An open document without a partner: drawn by its own odds at the root."""
            if last:
                # the lower half of the draw's bits: the upper may have settled its last pair
                value = float(row.column(at["draw"])[0].as_py() * (1 << 26) % 1 < value)
            return put(row, [value])

        carry = None  # (cell, size, p, the row)
        run = None  # (cell, key, rank) of the last row
        for batch in batches:
            num = lambda c: batch.column(at[c]).to_numpy(zero_copy_only=False)  # noqa: E731,B023
            rank, run = _ranks(num("cell"), num("key"), run)
            out, closed, held, ended = _play(num("size"), num("p"), (num("draw") + rank * TURN) % 1, num("cell"), carry and carry[:3])
            if carry and closed is not None:
                yield put(carry[3], [closed])
            for c, s, value, row in ended:
                yield end(carry[3] if row < 0 else batch.slice(row, 1), value)
            done = ~np.isnan(out)
            if done.any():
                yield put(batch.filter(pa.array(done)), out[done])
            if held is None:
                carry = None
            else:
                carry = (*held[:3], carry[3] if held[3] < 0 else batch.slice(held[3], 1))
        if carry:
            yield end(carry[3], carry[2])

    return rows.mapInArrow(play, rows.schema).drop(cell)


def copies(docs: DataFrame, name: str = "copies", weights=WEIGHTS, total: float = TOTAL, most: float = MOST,
           levels=LEVELS, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (with doc_id, source, text) and how often the mix takes each row, with its size, source_size and target.

    The added columns are ``name`` and size, source_size, target (behind an
    underscore if ``docs`` has columns of these names).  ``keep`` names the
    columns that move through the tree; all if not given.
    """
    names = {c: fresh_name(docs, c) for c in ("size", "key", "p", "draw", "cell", "floor", "source_size", "target", "of")}
    size, key, p, draw, floor, of = (names[c] for c in ("size", "key", "p", "draw", "floor", "of"))
    drawn = lambda k: F.pmod(F.xxhash64(key, F.lit(seed + k)), F.lit(1 << 52)) / float(1 << 52)
    kept = [F.col(f"`{c}`") for c in (keep or docs.columns)]
    rows = docs.select(*kept, word_count(F.col("text")).alias(size), F.xxhash64("doc_id", "text", F.lit(seed)).alias(key))
    per = source_targets(rows.select("source", F.col(size).alias("size")), weights, total, most)
    per = per.select(F.col("source").alias(of), F.col("source_size").alias(names["source_size"]), F.col("target").alias(names["target"]))
    rows = rows.join(per, F.col("source").eqNullSafe(F.col(of))).drop(of)
    ratio = F.when(F.col(names["source_size"]) > 0, F.col(names["target"]) / F.col(names["source_size"])).otherwise(F.lit(0.0))
    rows = rows.withColumn(floor, F.floor(ratio)).withColumn(p, ratio - F.col(floor)).withColumn(draw, drawn(1))
    tree = {c: names[c] for c in ("key", "size", "p", "draw", "cell")}
    done = None
    for k, buckets in enumerate(levels):
        last = k == len(levels) - 1
        rows = saved(_level(rows, buckets, tree, last), f"mix-{k}")
        settled = rows if last else rows.where((F.col(p) <= 0) | (F.col(p) >= 1))
        done = settled if done is None else done.union(settled)
        if not last:
            rows = rows.where((F.col(p) > 0) & (F.col(p) < 1)).withColumn(draw, drawn(2 + k))
    return done.withColumn(name, (F.col(floor) + F.col(p)).cast("int")).drop(key, p, draw, floor)


def mixture(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): doc_id, size, source_size, target, taken.

    A null text has size 0, and documents without words are never drawn; a null
    source is a source of its own, last in order; null doc_ids take part like
    others; repeated rows are drawn one by one; an empty table gives an empty
    result; sources without words have target 0.  Other columns are ignored.
    """
    out = copies(docs.select("doc_id", "source", "text"), keep=["doc_id", "source"])
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def repeated(docs: DataFrame) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, and its own columns."""
    name = fresh_name(docs, "copies")
    return (copies(docs, name).where(F.col(name) > 0)
            .withColumn(name, F.explode(F.sequence(F.lit(1), F.col(name)))).select(*docs.columns))


def op10_pivotal_mix(spark, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))
