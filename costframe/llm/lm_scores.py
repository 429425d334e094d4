"""Stupid-backoff scores from n-gram counts over the whole corpus.

    s(w | u) = c(u w) / c(u)         if u w is in the table (count >= min_count)
             = alpha * c(w) / N      otherwise, and for a text's first word

Three relations, all keyed by hash:

* n-grams of documents: documents are dealt to blocks by hash; a block holds its
  distinct n-grams, sorted by 64-bit hash, with their counts in the block;
* the count table: n-grams of one hash range of all blocks meet in a partition
  and their counts are summed (the blocks have summed before the shuffle, so a
  frequent n-gram costs one entry for each block);
* the join back: each partition answers each block with the table's counts for
  the block's n-grams, in the order asked; blocks score their documents.

A row for each n-gram and document would move about 25 bytes for each word and
order, here a packed entry takes about 6 for each distinct n-gram of a block:
hashes travel as byte planes of the differences of their sorted run.  Both uses
of the blocks read one exchange of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costframe.llm.common import U, gram_hashes, hash_spans, lower_ascii, sums_by, table, text_slices, word_spans

ALPHA = 0.4
MIN_COUNT = 2
#: Bytes of text in a block on average, and in terms of which the count table is cut into as many partitions.
BLOCK_BYTES = 8 << 20
ORDERS = (1, 2)


def planes(a: np.ndarray) -> bytes:
    """An array as the planes of its bytes, so that runs of equal high bytes compress."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes()


def unplaned(data, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def hashes_of(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of adjacent texts, and where each text's begin."""
    starts, ends, bounds = word_spans(buf, off)
    return hash_spans(lower_ascii(buf), starts, ends), bounds


def block_words(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    chunks = texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]
    words, bounds, at = [], [np.zeros(1, np.int64)], 0
    for c in chunks:
        for _, _, buf, off in text_slices(c):
            w, b = hashes_of(buf, off)
            words.append(w)
            bounds.append(b[1:] + at)
            at += len(w)
    return np.concatenate(words) if words else np.zeros(0, U), np.concatenate(bounds)


def grams(words: np.ndarray, bounds: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams inside texts, and the positions of their last words."""
    if order == 1:
        return words, np.arange(len(words))
    first = np.repeat(bounds[:-1], np.diff(bounds))
    last = np.arange(len(words))
    inside = last - first >= order - 1
    g = gram_hashes(words, order)
    return g[last[inside] - order + 1], last[inside]


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """Bytes and words of all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = words = 0
        for batch in batches:
            for _, _, buf, off in text_slices(batch.column(0)):
                size += len(buf)
                words += len(word_spans(buf, off)[0])
        yield pa.RecordBatch.from_arrays([pa.array([size]), pa.array([words])], names=["bytes", "words"])

    got = docs.select("text").mapInArrow(run, "bytes long, words long").agg(F.sum("bytes"), F.sum("words")).first()
    return got[0] or 0, got[1] or 0


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, from sorted rows."""
    held, mark = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = np.column_stack([batch.column(k).to_numpy() for k in keys])
        cuts = np.concatenate([[0], np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1, [len(ids)]])
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if held and mark != tuple(ids[lo]):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            mark = tuple(ids[lo])
    if held:
        yield pa.Table.from_batches(held)


def backoff_scores(docs: DataFrame, alpha: float = ALPHA, min_count: int = MIN_COUNT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_backoff, log_score, mean_log_score.

    log_score is the sum of natural logarithms over the words (runs without ASCII
    white space, A-Z lower-cased), to six decimals; texts without words and null
    texts have 0 words, log_score 0 and a null mean.  n_backoff counts the words
    behind the first that were scored by the shorter gram.  Rows with null doc_ids
    and repeated rows count and are scored like others; other columns are
    ignored; an empty table gives an empty result.
    """
    size, total = corpus_size(docs)
    blocks = max(1, -(-size // block_bytes))
    parts = blocks
    dealt = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
             .withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).repartition("block"))

    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array([(p << 64) // parts for p in range(1, parts)], U)
        for block in _runs(batches, ["block"]):
            words, bounds = block_words(block.column("text"))
            out = []
            for order in ORDERS:
                g, count = np.unique(grams(words, bounds, order)[0], return_counts=True)
                cut = np.concatenate([[0], np.searchsorted(g, edges, "left"), [len(g)]])
                for p in np.flatnonzero(np.diff(cut)):
                    a, b = cut[p], cut[p + 1]
                    out.append((order, int(p), block.column("block")[0].as_py(), planes(np.diff(g[a:b], prepend=U(0))),
                                planes(count[a:b].astype(np.uint32))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                names=["order", "part", "block", "grams", "counts"])

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, ["order", "part"]):
            each = [np.cumsum(unplaned(x.as_buffer(), U), dtype=U) for x in run.column("grams")]
            count = np.concatenate([unplaned(x.as_buffer(), np.uint32) for x in run.column("counts")])
            at = np.unique(np.concatenate(each), return_inverse=True)[1]
            sums = np.bincount(at, count)[at].astype(U)
            cut = np.concatenate([[0], np.cumsum([len(x) for x in each])])
            yield pa.RecordBatch.from_arrays(
                [run.column(c).combine_chunks() for c in ("block", "order", "part")]
                + [pa.array([planes(sums[a:b]) for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
                names=["block", "order", "part", "sums"])

    def score(block: pa.Table, told: pa.Table) -> pa.Table:
        words, bounds = block_words(block.column("text"))
        counts = np.zeros((len(ORDERS), len(words)))
        told = told.sort_by([("order", "ascending"), ("part", "ascending")])
        for k, order in enumerate(ORDERS):
            mine = told.filter(pa.compute.equal(told.column("order"), order)).column("sums")
            sums = np.concatenate([unplaned(x.as_buffer(), U) for x in mine]) if len(mine) else np.zeros(0, U)
            g, last = grams(words, bounds, order)
            counts[k, last] = sums[np.unique(g, return_inverse=True)[1]]
        one, two = counts
        first = np.zeros(len(words), bool)
        first[bounds[:-1][np.diff(bounds) > 0]] = True
        known = (two >= min_count) & ~first
        before = np.concatenate([[1.0], one[:-1]]) if len(one) else one
        with np.errstate(divide="ignore"):
            logs = np.where(known, np.log(np.maximum(two, 1)) - np.log(np.maximum(before, 1)),
                            np.log(np.maximum(one, 1)) - np.log(max(total, 1)) + np.where(first, 0.0, np.log(alpha)))
        n = np.diff(bounds)
        doc = np.repeat(np.arange(len(n)), n)
        sums = np.round(np.bincount(doc, logs, minlength=len(n)), 6) + 0.0
        return pa.table({"doc_id": block.column("doc_id"), "n_words": pa.array(n), "n_backoff": pa.array(
            sums_by((~known & ~first).astype(np.int64), bounds)), "log_score": pa.array(sums), "mean_log_score": pa.array(
            sums / np.maximum(n, 1), mask=n == 0)})

    asked = dealt.sortWithinPartitions("block").mapInArrow(
        requests, "order int, part long, block long, grams binary, counts binary")
    told = (asked.repartition("order", "part").sortWithinPartitions("order", "part", "block")
            .mapInArrow(answers, "block long, order int, part long, sums binary"))
    kind = T.StructType([docs.schema["doc_id"]]).simpleString()[7:-1].replace("doc_id:", "doc_id ")
    return dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        score, f"{kind}, n_words long, n_backoff long, log_score double, mean_log_score double")


def op1_stupid_backoff(spark, sf_dir: str) -> DataFrame:
    return backoff_scores(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x20\x09-\x0D]+') AS ws FROM documents),
t AS (SELECT r, i, ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] END AS u FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)),
one AS (SELECT w, count(*) AS n FROM t GROUP BY w),
two AS (SELECT u, w, count(*) AS n FROM t WHERE u IS NOT NULL GROUP BY u, w HAVING count(*) >= 2),
s AS (SELECT t.r, CASE WHEN two.n IS NOT NULL THEN ln(two.n) - ln(cu.n)
                       ELSE ln(cw.n) - ln((SELECT count(*) FROM t)) + CASE WHEN t.u IS NULL THEN 0 ELSE ln(0.4) END END AS x,
             CASE WHEN two.n IS NULL AND t.u IS NOT NULL THEN 1 ELSE 0 END AS b
      FROM t JOIN one cw ON t.w = cw.w LEFT JOIN one cu ON t.u = cu.w LEFT JOIN two ON t.u = two.u AND t.w = two.w),
g AS (SELECT r, count(*) AS n, sum(b) AS b, round(sum(x), 6) AS x FROM s GROUP BY r)
SELECT d.doc_id, CAST(coalesce(g.n, 0) AS BIGINT) AS n_words, CAST(coalesce(g.b, 0) AS BIGINT) AS n_backoff,
       coalesce(g.x, 0.0) AS log_score, g.x / g.n AS mean_log_score
FROM d LEFT JOIN g ON d.r = g.r
"""
