"""Language ID: averaged hashed subword embeddings with a linear softmax.

A text's words are its runs of letters (ASCII letters, lower-cased, and all bytes
beyond ASCII), each put between blanks; its subwords are the windows of 3 to 5
bytes inside one word, hashed to buckets.  The text is the average of its
subwords' embeddings, and a linear softmax over it gives the languages.  Both are
trained together by stochastic gradient descent in numpy on the driver.

The fit reads a bounded sample: ``PER_LANG`` documents of each language (the
smallest hashes) that are not held out, each as at most ``DRAWS`` subwords spread
evenly over its whole text and, again, as a few of these, so that short texts are
learnt too.  A fifth of the sample is kept apart: a temperature makes the scores
probabilities on it, and the least score at which the accepted rows are right
to ``PRECISION`` becomes the bound of rejection.

Embeddings and softmax are linear, so scoring needs one row of language weights
for each bucket; it runs beside the scan, over whole texts, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costframe.llm.common import U, lower_ascii, table, text_slices
from costframe.llm.phrases import best
from costframe.llm.quality import held_out

BITS = 16
SUBWORDS = (3, 4, 5)
DIMENSIONS = 16
#: Documents of a language that the fit reads at most, subwords of each, subwords of its short copy.
PER_LANG = 1500
DRAWS = 256
FEW = 12
EPOCHS = 6
BATCH = 32
RATE = 1.0
#: Share of accepted rows that shall be right.
PRECISION = 0.99
UNKNOWN = "und"
SLICE = 1 << 20
SPREAD = 0x9E3779B97F4A7C15


def buckets(buf: np.ndarray, off: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each subword, where each text's begin) of some adjacent texts."""
    low = lower_ascii(buf)
    letter = ((low - np.uint8(97)) <= 25) | (low >= 128)
    edge = np.zeros(len(low) + 1, bool)
    edge[off] = True
    first = letter.copy()
    first[1:] &= ~letter[:-1] | edge[1:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word = np.cumsum(first)[letter] - 1
    length = np.bincount(word)
    padded = np.full(len(word) + 2 * len(starts), 32, np.uint8)
    padded[np.arange(len(word)) + 2 * word + 1] = low[letter]
    block = np.repeat(np.arange(len(starts)), length + 2)
    wide = padded.astype(U)
    code, found, of = wide, [], []
    row = np.searchsorted(off, starts, "right") - 1
    for n in range(2, max(SUBWORDS) + 1):
        code = code[:-1] | (wide[n - 1:] << U(8 * (n - 1))) if len(code) > 1 else code[:0]
        if n in SUBWORDS and len(code):
            same = block[:len(code)] == block[n - 1:]
            found.append((code[same] + U(n)) * U(SPREAD) >> U(64 - bits))
            of.append(row[block[:len(code)][same]])
    got, of = np.concatenate(found).astype(np.int64), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return got[order], np.searchsorted(of[order], np.arange(len(off)))


@dataclass
class Identifier:
    """The fitted arrays; their size depends on ``bits`` and the number of languages alone."""

    langs: list[str]
    weight: np.ndarray  # bucket x language: embeddings times softmax
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0

    def logits(self, got: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        n = np.diff(bounds)
        out = np.zeros((len(n), len(self.langs)))
        some = n > 0
        if some.any():
            for k in range(len(self.langs)):
                out[some, k] = np.add.reduceat(self.weight[got, k], bounds[:-1][some]) / n[some]
        return out + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def fit(rows: list[np.ndarray], lang: np.ndarray, langs: list[str], bits: int = BITS, seed: int = 3) -> Identifier:
    """``rows`` are the buckets of a text each, ``lang`` their places in ``langs``; the same rows give the same model."""
    rng = np.random.default_rng(seed)
    k = len(langs)
    embed = rng.normal(0, 1 / DIMENSIONS, (1 << bits, DIMENSIONS))
    soft = rng.normal(0, 0.1, (DIMENSIONS, k))
    bias = np.zeros(k)
    apart = np.arange(len(rows)) % 5 == 0
    learn = np.flatnonzero(~apart) if k > 1 else np.zeros(0, int)
    size = np.array([len(r) for r in rows], np.int64)
    bounds = np.concatenate([[0], np.cumsum(size)])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    steps = EPOCHS * -(-len(learn) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(learn)
        for at in range(0, len(order), BATCH):
            some = order[at:at + BATCH]
            n = size[some]
            of = np.repeat(np.arange(len(some)), n)
            b = flat[np.repeat(bounds[some] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(len(of))]
            begin = np.concatenate([[0], np.cumsum(n)[:-1]])
            hidden = np.add.reduceat(embed[b], begin, axis=0) / n[:, None]
            z = hidden @ soft + bias
            z = np.exp(z - z.max(1, keepdims=True))
            err = z / z.sum(1, keepdims=True)
            err[np.arange(len(some)), lang[some]] -= 1
            rate = RATE * (1 - step / steps)
            back = err @ soft.T / n[:, None]
            soft -= rate * hidden.T @ err
            bias -= rate * 0.1 * err.sum(0)
            np.add.at(embed, b, -rate * back[of])
            step += 1
    model = Identifier(langs, embed @ soft, bias)
    check = np.flatnonzero(apart)
    if k > 1 and len(check):
        z = model.logits(np.concatenate([rows[i] for i in check]), np.concatenate([[0], np.cumsum(size[check])]))
        right = lang[check]

        def loss(t: float) -> float:
            model.temperature = t
            return -float(np.log(np.maximum(model.probabilities(z)[np.arange(len(check)), right], 1e-12)).mean())

        model.temperature = min(np.geomspace(0.1, 10, 41), key=loss)
        p = model.probabilities(z)
        order = np.argsort(-p.max(1), kind="stable")
        share = np.cumsum(p.argmax(1)[order] == right[order]) / np.arange(1, len(order) + 1)
        enough = np.flatnonzero(share >= PRECISION)
        model.least = float(p.max(1)[order][enough[-1]]) if len(enough) else 1.0
    return model


def train(docs: DataFrame, per_lang: int = PER_LANG) -> Identifier:
    """Fit on at most ``per_lang`` documents of each language; rows that are held out or lack doc_id, lang or a letter don't count."""
    rows = docs.select("doc_id", "lang", "text").where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.where(F.col("text").rlike(r"\p{L}")).withColumn("draw", F.xxhash64("doc_id"))
    # Two passes, so that only the sample's texts move: ids first, texts joined to them.
    chosen = best(rows.select("lang", "draw", "doc_id").distinct(), "lang", "doc_id", ["draw", "doc_id"], per_lang)
    rows = rows.join(chosen.select("lang", "doc_id"), ["lang", "doc_id"], "left_semi").select("lang", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in text_slices(batch.column(2), SLICE):
                got, bounds = buckets(buf, off)
                n = np.diff(bounds)
                drawn = []
                for k in range(hi - lo):
                    at = np.unique((np.arange(DRAWS) + 0.5) * n[k] // DRAWS).astype(np.int64)
                    drawn.append(got[bounds[k] + at].astype(np.int32).tobytes() if n[k] else b"")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo).cast(pa.int64()),
                                                  pa.array(drawn, pa.binary())], names=["lang", "doc_id", "drawn"])

    got = rows.mapInArrow(run, "lang string, doc_id long, drawn binary").groupBy("lang", "doc_id").agg(F.min("drawn").alias("drawn")).collect()
    langs = sorted({r.lang for r in got})
    number = {name: k for k, name in enumerate(langs)}
    rows, lang = [], []
    for r in sorted(got, key=lambda r: (r.doc_id, r.lang)):
        whole = np.frombuffer(bytes(r.drawn), np.int32).astype(np.int64)
        for part in (whole, whole[(r.doc_id % 7)::max(1, len(whole) // FEW)][:FEW]):
            if len(part):
                rows.append(part)
                lang.append(number[r.lang])
    # The two rows of a document stay on one side of the calibration split.
    order = sorted(range(len(rows)), key=lambda k: (k // 2 // 5, k % 2, k // 2))
    return fit([rows[k] for k in order], np.array([lang[k] for k in order], np.int64), langs)


def languages(docs: DataFrame, model: Identifier | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, lang, text): doc_id, held_out, lang_pred, score, rejected.

    Null texts and those without a letter (Unicode's) are ``und`` with score 0
    and rejected; so is every row if no language can be learnt.  A table of one
    language gives that one.  Null doc_ids are not held out and never learnt
    from; repeated rows get a row each; other columns are ignored.  ``rejected``
    says that the score is below the calibrated bound; the likeliest language is
    given all the same.
    """
    known = model or train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = pa.array([*model.langs, UNKNOWN])
        for batch in batches:
            for lo, hi, buf, off in text_slices(batch.column(3), SLICE):
                named = batch.column(2).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                which, score = np.full(hi - lo, len(model.langs)), np.zeros(hi - lo)
                if model.langs:
                    p = model.probabilities(model.logits(*buckets(buf, off)))
                    which, score = np.where(named, p.argmax(1), which), np.where(named, p.max(1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), names.take(pa.array(which)), pa.array(score),
                     pa.array((score < model.least) | (which == len(model.langs)))], names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("named"), F.coalesce("text", F.lit("")).alias("text"))
    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")


def op13_subword_embeddings(spark, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))
