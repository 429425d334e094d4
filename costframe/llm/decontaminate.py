"""Benchmark decontamination: n-gram seeds find passages, Smith-Waterman scores them.

1. The word pairs of the benchmark items are the seeds.  A text that an item
   aligns with at score s has at least s - 1 of them (``shared_seeds``), so it has
   one of the item's rarest seeds, those before the last ``shared - 1``.  Rarity
   is counted in one scan of the documents, behind a bitmap of all seeds.
2. A second scan, with that bitmap and one of the rare seeds, both of fixed
   size, keeps the neighbourhood of each rare seed that has as many seeds near it
   as any item needs: a passage of word hashes with its rare seeds.
3. Seeds and passages are joined on the hash of the rare seeds only.
4. Seeds and words in common bound the score from above, so they are counted first.
5. Smith-Waterman over words (match 1, mismatch and gap -1) scores the pair; row
   by row with whole columns at once.  A copy with edited, added or left-out
   words keeps most of its score.

A document is contaminated by an item if the score is at least half of the
item's words (of ``SPAN`` words for longer items: a long passage of it is enough)
and at least ``WHOLE``; an item of fewer words must be there word for word.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costframe.llm.common import U, bitmap_of, gram_hashes, hash_spans, in_bitmap, lower_ascii, mix, saved, table, text_slices, word_spans

SEED_WORDS = 2
#: So many words of an item must be found, all of a shorter one: a phrase in common is no leak.
WHOLE = 8
#: Bits of the seed bitmap: fixed, whatever the benchmark's size; it only spares work.
BITS = 1 << 25
LEAST = 0.5
SPAN = 60
#: Words kept on each side of a seed that passes, at least; never fewer than an alignment of the longest item can reach.
MARGIN = 128


def smith_waterman(a: np.ndarray, b: np.ndarray) -> int:
    """Best local alignment score of two word sequences: match 1, mismatch -1, gap -1."""
    if len(a) > len(b):
        a, b = b, a
    step = np.arange(len(b) + 1)
    row, best = np.zeros(len(b) + 1, np.int64), 0
    for x in a:
        new = np.maximum(row - 1, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(b == x, 1, -1))
        row = np.maximum.accumulate(new + step) - step
        best = max(best, int(row.max()))
    return best


def needed(words: int, least: float = LEAST, span: int = SPAN) -> float:
    return max(least * min(words, span), min(words, WHOLE))


def _words(col: pa.Array) -> Iterator[np.ndarray]:
    for _, _, buf, off in text_slices(col):
        starts, ends, bounds = word_spans(buf, off)
        h = hash_spans(lower_ascii(buf), starts, ends)
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield h[a:b]


def shared_seeds(words: int, least: float = LEAST, span: int = SPAN) -> int:
    """So many of an item's seeds, by position, are in any text that it aligns with at the threshold.

    Matches less edits make the score, and e edits cut the matches into e + 1 runs
    at most, so at least score - 1 matches follow another in both texts.
    """
    return max(1, ceil(needed(words, least, span)) - 1)


def seeds_of(words: np.ndarray) -> np.ndarray:
    """The seed hashes of an item, in order; the seed of a single word is that word."""
    return gram_hashes(words, SEED_WORDS) if len(words) != 1 else mix(words + U(1))


def seeds_in(words: np.ndarray, single: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the possible seeds in a text, of single words too if there are such items, and their positions."""
    pairs = gram_hashes(words, SEED_WORDS)
    if not single:
        return pairs, np.arange(len(pairs))
    at = np.concatenate([np.arange(len(words)), np.arange(len(pairs))])
    order = np.argsort(at, kind="stable")
    return np.concatenate([mix(words + U(1)), pairs])[order], at[order]


def items_of(benchmark: DataFrame, least: float = LEAST, span: int = SPAN) -> DataFrame:
    """(item_id, item, words, shared, seeds): the word hashes of each item with words, and its seed hashes in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = list(_words(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([w.tobytes() for w in words], pa.binary()), pa.array([len(w) for w in words], pa.int64()),
                 pa.array([shared_seeds(len(w), least, span) for w in words], pa.int64()),
                 pa.array([seeds_of(w).view(np.int64) for w in words], pa.list_(pa.int64()))],
                names=["item_id", "item", "words", "shared", "seeds"])

    kind = benchmark.schema["item_id"].dataType.simpleString()
    return (benchmark.select("item_id", "text").mapInArrow(run, f"item_id {kind}, item binary, words long, shared long, seeds array<long>")
            .where("words > 0").distinct())


def seed_counts(docs: DataFrame, bitmap: np.ndarray, bits: int, single: bool) -> DataFrame:
    """(seed, times): how often each seed that passes the bitmap occurs, counted beside the scan first."""
    told = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, U)]
            for w in _words(batch.column(0)):
                g, _ = seeds_in(w, single)
                found.append(g[in_bitmap(told.value, g.view(np.int64) % bits)])
            seed, times = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array(times, pa.int64())], names=["seed", "times"])

    return docs.select("text").mapInArrow(run, "seed long, times long").groupBy("seed").agg(F.sum("times").alias("times"))


def rare_seeds(items: DataFrame, counts: DataFrame) -> DataFrame:
    """(item_id, item, shared, seed): each item's rarest seeds, up to where fewer than ``shared`` are left; those in no text are left out."""
    every = items.select("item_id", "item", "shared", F.explode("seeds").alias("seed"))
    every = every.groupBy("item_id", "item", "shared", "seed").agg(F.count(F.lit(1)).alias("places")).join(counts, "seed", "left")
    order = (Window.partitionBy("item_id", "item").orderBy(F.coalesce("times", F.lit(0)).desc(), "seed")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (every.withColumn("left", F.sum("places").over(order)).where("left >= shared and times is not null")
            .select("item_id", "item", "shared", "seed"))


def passages(docs: DataFrame, every: np.ndarray, rare: np.ndarray, bits: int, least: int, reach: int, margin: int,
             single: bool) -> DataFrame:
    """(doc_id, passage, seeds): runs of words around the rare seeds that have ``least`` seeds of any kind within ``reach`` words."""
    told = docs.sparkSession.sparkContext.broadcast((every, rare))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, runs, seeds = [], [], []
            for row, w in enumerate(_words(batch.column(1))):
                g, at = seeds_in(w, single)
                bit = g.view(np.int64) % bits
                hits = np.flatnonzero(in_bitmap(told.value[0], bit))
                if len(hits) < least:
                    continue
                first = np.flatnonzero(at[hits[least - 1:]] - at[hits[:len(hits) - least + 1]] <= reach)
                edge = np.zeros(len(hits) + 1, np.int64)
                edge[first] += 1
                edge[first + least] -= 1
                hits = hits[np.cumsum(edge[:-1]) > 0]
                hits = hits[in_bitmap(told.value[1], bit[hits])]
                for part in np.split(hits, np.flatnonzero(np.diff(at[hits]) > 2 * margin) + 1) if len(hits) else []:
                    rows.append(row)
                    runs.append(w[max(0, at[part[0]] - margin):at[part[-1]] + SEED_WORDS + margin].tobytes())
                    seeds.append(np.unique(g[part]).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(runs, pa.binary()),
                                              pa.array(seeds, pa.list_(pa.int64()))], names=["doc_id", "passage", "seeds"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, passage binary, seeds array<long>")


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, span: int = SPAN, margin: int = MARGIN, bits: int = BITS) -> DataFrame:
    """(doc_id, item_id, score, seed_passages): one row for each document and item that it contains.

    score is the best alignment over ``min(words of the item, span)``;
    seed_passages is the number of passages of the rarest seed that the pair was joined by.  Words are
    runs without ASCII white space, A-Z lower-cased.  Null and empty texts contain
    nothing; items without words are not looked for; a null doc_id or item_id stands like any other; repeated rows give one row; other
    columns are ignored; an empty table on either side gives an empty result.
    """
    items = saved(items_of(benchmark, least, span), "items")
    size = items.agg(F.min("shared"), F.max("words"), F.min("words")).first()
    fewest, reach, single = size[0] or 1, 2 * (size[1] or 0), size[2] == 1
    every = bitmap_of(items.select(F.explode("seeds").alias("seed")), bits)
    seeds = saved(rare_seeds(items, seed_counts(docs, every, bits, single)), "seeds")
    found = passages(docs, every, bitmap_of(seeds.select("seed"), bits), bits, fewest, reach, max(margin, reach), single)
    found = saved(found.withColumn("run", F.xxhash64("doc_id", "passage")), "passages")
    hits = found.select("run", F.explode("seeds").alias("seed"))
    rarity = hits.join(seeds.select("seed").distinct(), "seed", "left_semi").groupBy("seed").agg(F.count(F.lit(1)).alias("passages"))
    pairs = (hits.join(seeds.join(rarity, "seed"), "seed").groupBy("run", "item_id", "item", "shared")
             .agg(F.min("passages").alias("seed_passages")))
    pairs = found.select("run", "doc_id", "passage").dropDuplicates(["run"]).join(pairs, "run").select(
        "doc_id", "item_id", "passage", "item", "seed_passages", "shared")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for p, q, shared in zip(batch.column(2), batch.column(3), batch.column(5).to_pylist()):
                a, b = np.frombuffer(q.as_buffer(), U), np.frombuffer(p.as_buffer(), U)
                need = needed(len(a), least, span)
                like = np.isin(seeds_of(a), seeds_in(b, len(a) == 1)[0]).sum() >= shared and np.isin(a, b).sum() >= need
                best = smith_waterman(a, b) if like else 0
                scores.append(best / min(len(a), span) if best >= need else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()), batch.column(4)],
                                             names=["doc_id", "item_id", "score", "seed_passages"])

    kinds = [df.schema[c].dataType.simpleString() for df, c in ((docs, "doc_id"), (benchmark, "item_id"))]
    return (pairs.mapInArrow(run, f"doc_id {kinds[0]}, item_id {kinds[1]}, score double, seed_passages long")
            .where("score > 0").groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), F.min("seed_passages").alias("seed_passages")))


def op9_smith_waterman(spark, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
