"""Quality classifier: a factorisation machine over hashed words and structure statistics.

score = sigmoid(w0 + sum w_j x_j + sum_{i<j} <v_i, v_j> x_i x_j), where the pair
sum is taken in linear time as half of sum_f ((sum_j v_jf x_j)**2 - sum_j (v_jf
x_j)**2).  The x_j are damped, length-normalised counts of lower-cased words
hashed to buckets, and standardised statistics of the text: its size (the n_chars
metadata, taken from the text itself), character classes, word and line shapes.

The model is fitted on a bounded, documented sample of labelled rows (the
``sample`` smallest hashes of doc_id among the rows that are not held out); its
features, not texts, come to the driver, and the fitted arrays, of fixed size,
go to the scoring tasks.  Scoring runs beside the scan, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costframe.llm.common import U, fresh_name, hash_spans, lower_ascii, spaces, sums_by, table, text_slices, word_spans

BITS = 15
RANK = 8
#: Labelled rows that the model is fitted on, at most.
SAMPLE = 6000
EPOCHS = 10
BATCH = 200
RATE = 0.08
#: Bytes of text scored at once.
SCORE_BYTES = 1 << 19
DECAY = 1e-4
STATISTICS = ("log characters", "log words", "bytes a word", "upper case", "digits", "punctuation", "bars",
              "marks and signs", "not ASCII", "line breaks a word", "distinct words", "repeated lines",
              "words ending in a mark", "short words", "spread of word size")


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass
class Features:
    """Of some texts: buckets and values of their words (bounds: where each text's begin), and statistics."""

    bounds: np.ndarray
    bucket: np.ndarray
    value: np.ndarray
    stats: np.ndarray


def _distinct_share(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Distinct keys over keys, for each text; 1 for none."""
    n = np.diff(bounds)
    owner = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    return np.where(n > 0, np.bincount(o[new], minlength=len(n)) / np.maximum(n, 1), 1.0)


def features(buf: np.ndarray, off: np.ndarray, bits: int = BITS) -> Features:
    n = len(off) - 1
    low = lower_ascii(buf)
    starts, ends, bounds = word_spans(buf, off)
    h = hash_spans(low, starts, ends)
    words = np.diff(bounds)
    owner = np.repeat(np.arange(n), words)
    key, count = np.unique((owner << bits) | (h >> U(64 - bits)).astype(np.int64), return_counts=True)
    of = key >> bits
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(of, value * value, minlength=n))
    value = value / norm[of] if len(of) else value

    size = np.diff(off)
    some, nw = np.maximum(size, 1), np.maximum(words, 1)
    letter = (low - np.uint8(97)) <= 25
    digit = (buf - np.uint8(48)) <= 9
    mark = ~letter & ~digit & (buf < 128) & ~spaces(buf)
    share = lambda flag: sums_by(flag.astype(np.int64), off)
    length = ends - starts
    mean = sums_by(length, bounds) / nw
    breaks = np.flatnonzero(buf == 10)
    cuts = np.unique(np.concatenate([off[:-1], breaks[breaks + 1 < len(buf)] + 1])) if len(buf) else np.zeros(0, np.int64)
    cuts = cuts[cuts < len(buf)]
    stops = np.append(cuts[1:], len(buf)) if len(cuts) else cuts
    line = np.searchsorted(cuts, off, "left")
    last_mark = mark[ends - 1] if len(ends) else np.zeros(0, bool)
    stats = np.column_stack([
        np.log1p(share((buf & 0xC0) != 0x80)), np.log1p(words), mean,
        share(letter & (buf < 97)) / np.maximum(share(letter), 1), share(digit) / some, share(mark) / some,
        share(buf == 124) / some, share(np.isin(buf, np.frombuffer(b"#$%&*!|<>{}=_~^@\\", np.uint8))) / some,
        share(buf >= 128) / some, share(buf == 10) / nw, _distinct_share(h, bounds),
        1 - _distinct_share(hash_spans(buf, cuts, stops), line),
        sums_by(last_mark.astype(np.int64), bounds) / nw, sums_by((length <= 3).astype(np.int64), bounds) / nw,
        np.sqrt(np.maximum(sums_by(length * length, bounds) / nw - mean * mean, 0)),
    ])
    return Features(np.searchsorted(of, np.arange(n + 1)), key & ((1 << bits) - 1), value, stats)


@dataclass
class Machine:
    """The fitted arrays; their size depends on ``bits`` and ``rank`` alone."""

    bits: int
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    stat_weight: np.ndarray
    stat_factor: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def standard(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.centre) / self.scale, -4, 4)

    def score(self, f: Features) -> np.ndarray:
        z, n = self.standard(f.stats), len(f.stats)
        of = np.repeat(np.arange(n), np.diff(f.bounds))
        margin = self.bias + np.bincount(of, self.weight[f.bucket] * f.value, minlength=n) + z @ self.stat_weight
        for k in range(self.factor.shape[1]):
            t = self.factor[f.bucket, k] * f.value
            zk = z * self.stat_factor[:, k]
            total = np.bincount(of, t, minlength=n) + zk.sum(1)
            margin += 0.5 * (total * total - np.bincount(of, t * t, minlength=n) - (zk * zk).sum(1))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(f: Features, y: np.ndarray, bits: int = BITS, rank: int = RANK, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Logistic loss, Adagrad steps over shuffled batches; the same rows give the same machine."""
    rng = np.random.default_rng(seed)
    m = f.stats.shape[1] if len(y) else len(STATISTICS)
    centre = f.stats.mean(0) if len(y) else np.zeros(m)
    scale = np.maximum(f.stats.std(0), 1e-6) if len(y) else np.ones(m)
    prior = (y.sum() + 1) / (len(y) + 2)
    fm = Machine(bits, float(np.log(prior / (1 - prior))), np.zeros(1 << bits), rng.normal(0, 0.05, (1 << bits, rank)),
                 np.zeros(m), rng.normal(0, 0.05, (m, rank)), centre, scale)
    if not len(y) or y.min() == y.max():
        return fm
    z_all = fm.standard(f.stats)
    seen = {name: np.full_like(getattr(fm, name), 1e-2) for name in ("weight", "factor", "stat_weight", "stat_factor")}
    seen_bias = 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(order), BATCH):
            rows = order[lo:lo + BATCH]
            sizes = f.bounds[rows + 1] - f.bounds[rows]
            of = np.repeat(np.arange(len(rows)), sizes)
            at = np.repeat(f.bounds[rows] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(len(of))
            b, x, z = f.bucket[at], f.value[at], z_all[rows]
            part = Features(np.concatenate([[0], np.cumsum(sizes)]), b, x, f.stats[rows])
            err = (fm.score(part) - y[rows]) / len(rows)
            e = err[of]
            grad = {"weight": np.bincount(b, e * x, minlength=1 << bits), "stat_weight": z.T @ err,
                    "factor": np.empty_like(fm.factor), "stat_factor": np.empty_like(fm.stat_factor)}
            for k in range(rank):
                t, zk = fm.factor[b, k] * x, z * fm.stat_factor[:, k]
                total = np.bincount(of, t, minlength=len(rows)) + zk.sum(1)
                grad["factor"][:, k] = np.bincount(b, e * x * (total[of] - t), minlength=1 << bits)
                grad["stat_factor"][:, k] = ((err * total)[:, None] * z - err[:, None] * z * zk).sum(0)
            for name, g in grad.items():
                a = getattr(fm, name)
                g = g + DECAY * a * (g != 0)
                seen[name] += g * g
                a -= RATE * g / np.sqrt(seen[name])
            seen_bias += err.sum() ** 2
            fm.bias -= RATE * err.sum() / np.sqrt(seen_bias)
    return fm


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS) -> Machine:
    """Fit on at most ``sample`` labelled rows that are not held out; labels are 0 or 1, others don't count."""
    marked = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("quality").alias("quality")).where(~held_out(F.col("doc_id"))))
    chosen = (marked.join(docs.select("doc_id"), "doc_id", "left_semi")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", "quality").agg(F.min("text").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in text_slices(batch.column(2)):
                f = features(buf, off, bits)
                cut = lambda a, kind, w=1: [a[f.bounds[i] * w:f.bounds[i + 1] * w].astype(kind).tobytes() for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).cast(pa.int64()), batch.column(1).slice(lo, hi - lo).cast(pa.int32()),
                     pa.array(cut(f.bucket, np.int32), pa.binary()), pa.array(cut(f.value, np.float64), pa.binary()),
                     pa.array([s.tobytes() for s in f.stats], pa.binary())],
                    names=["doc_id", "quality", "bucket", "value", "stats"])

    got = sorted(rows.mapInArrow(run, "doc_id long, quality int, bucket binary, value binary, stats binary").collect(),
                 key=lambda r: r.doc_id)
    join = lambda col, kind: np.frombuffer(b"".join(bytes(r[col]) for r in got), kind)
    bounds = np.concatenate([[0], np.cumsum([len(r["bucket"]) // 4 for r in got])]).astype(np.int64)
    f = Features(bounds, join("bucket", np.int32).astype(np.int64), join("value", np.float64),
                 join("stats", np.float64).reshape(len(got), len(STATISTICS)))
    return fit(f, np.array([r.quality for r in got], float), bits)


def scored(docs: DataFrame, machine: Machine, score: str = "score") -> DataFrame:
    """``docs`` with a score of 0 to 1 for each row (null text: empty); all columns stay.

    Only the texts go to the Python workers, in slices, and only scores come back.
    """
    model = docs.sparkSession.sparkContext.broadcast(machine)

    @F.arrow_udf(T.DoubleType())
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fm = model.value
        for text in texts:
            out = [fm.score(features(buf, off, fm.bits)) for _, _, buf, off in text_slices(text, SCORE_BYTES)]
            yield pa.array(np.concatenate(out) if out else np.zeros(0))

    return docs.withColumn(score, run(F.coalesce("text", F.lit(""))))


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Null and empty texts are scored as empty; a null doc_id is not held out and
    never learnt from; repeated rows have a row and the same score each; other
    columns are ignored.  Without labels of both kinds every score is the prior.
    """
    out = scored(docs.select("doc_id", "text"), train(docs, labels, sample))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with their own columns."""
    name = fresh_name(docs, "score")
    return scored(docs, train(docs, labels), name).where(F.col(name) >= least).drop(name)


def op4_factorisation_machine(spark, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
