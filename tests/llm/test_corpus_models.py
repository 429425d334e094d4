"""Collocations, whitening and language ID against brute force and held-out labels."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from costframe.llm import languages, phrases, whitening
from costframe.llm.common import table

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ phrases
def _brute(rows, longest, least, top, covered):
    """Collocations by plain counting in Python integers."""
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for c in ".,;:!?\n\x0b\x0c\r":
            low = low.replace(c, "\n")
        for piece in low.split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            total[lang] += len(words)
            for n in range(1, longest + 1):
                counts.update((lang, tuple(words[k:k + n])) for k in range(len(words) - n + 1))
    chosen = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out: dict[str, list] = {}
    for (lang, p), a in chosen.items():
        inside = [b for (o, q), b in chosen.items() if o == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
        if any(100 * b >= covered * a for b in inside):
            continue
        score, k = min((1000000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


PHRASES = [("en", "The cat sat. the cat sat, THE CAT\tran; a\x01b a b a\x01b"), ("en", "the cat sat on the cat on the cat"), (None, "the cat the cat"),
           ("und", "the cat"), ("en", None), ("fr", ""), ("fr", " . ,, "), ("de", "ü é ü é ü é"), ("en", "the cat sat. the cat sat, THE CAT"), ("", "x y x y"),
           ("en", "a b c d e a b c d e a b c d e " * 3), ("en", "the the the the the the the")]


@pytest.mark.parametrize(("longest", "least", "top", "covered"), [(3, 2, 2000, 50), (4, 1, 3, 50), (2, 2, 5, 100), (5, 2, 50, 80)])
def test_phrases_equal_plain_counting(spark, longest, least, top, covered):
    """Small batches, several ranges and languages; words with control characters sort between a word and its extensions."""
    docs = spark.createDataFrame([(i, lang, text, "p", 1, 2.0) for i, (lang, text) in enumerate(PHRASES)], "doc_id int, lang string, text string, phrase string, n int, f double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = phrases.phrases(docs, longest, least, top, covered).drop("words").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(tuple(r) for r in got) == _brute(PHRASES, longest, least, top, covered)


def test_ranges_that_begin_inside_an_extension(spark):
    """A third of all phrases begin (and end) with one word: its stream spans many ranges."""
    rows = [("en", f"hot w{k} hot. w{k} hot w{k}, hot w{k % 7} hot") for k in range(400)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert phrases.walked(phrases.saved(phrases.count_stream(docs, 3, 1).select(
            "lang", F.when(F.col("phrase") == "", F.array().cast("array<string>")).otherwise(F.split("phrase", " ")).alias("path"), "f"), "test-counts"),
            False).where(F.exists("above", F.isnull)).isEmpty()
        got = phrases.phrases(docs, least=1).drop("words").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(tuple(r) for r in got) == _brute(rows, 3, 1, 2000, 50)


def test_counts_are_spread_over_more_tasks_than_the_shuffle_has(spark):
    """A task merges the n-grams of its partition in memory: a fourth of a shuffle partition, every count in one place."""
    docs = spark.createDataFrame([("en", " ".join(f"w{k % 700}" for k in range(5000)))] * 3, "lang string, text string")
    counts = phrases.count_stream(docs, 2, 1)
    assert counts.rdd.getNumPartitions() == 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = {(r.lang, r.phrase): r.f for r in counts.collect()}
    assert len(got) == counts.count() == 1 + 700 + 700 and got["en", ""] == 15000 and got["en", "w699 w0"] == 21


def test_phrases_of_large_counts_and_long_texts(spark):
    """Products beyond 64 bits, and one text of a few megabytes."""
    docs = spark.createDataFrame([("en", "big deal " * 300_000)], "lang string, text string")
    got = phrases.phrases(docs).collect()
    a = 300_000
    score = 1000000 * (a - 1) ** 2 // a ** 2
    assert [(r.phrase, r.a, r.score) for r in got] == [("big deal big", a - 1, score), ("deal big deal", a - 1, score)]
    assert phrases.phrases(docs.limit(0)).isEmpty()


# ------------------------------------------------------------------ whitening
def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(0)
    for d in (1, 2, 7, 30):
        a = rng.normal(size=(d, d))
        a = a + a.T
        w = np.linalg.eigvalsh(a)
        for s in (*rng.normal(size=5) * 3, w[0] - 1, w[-1] + 1):
            assert whitening.count_above(a, s) == (w > s).sum()
    assert whitening.count_above(np.array([[0.0, 1], [1, 0]]), 0.0) == 1
    assert whitening.count_above(np.zeros((3, 3)), 0.0) == 0


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1, 0.5], [5, 5, 5, 3, 3, 1, 0, 0], [1 + 1e-9, 1, 1 - 1e-9, 1e-3], [2, 2 - 1e-13, 1], [0, 0], [7]])
def test_slices_find_the_leading_spectrum(values):
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(2).normal(size=(d, d)))[0]
    v = (q * np.array(values)) @ q.T
    v = (v + v.T) / 2
    e, u = whitening.leading(v, 4)
    want = np.array([w for w in values if w > 0][:4])
    assert len(e) == len(want) and (len(e) == 0 or np.abs(e - want).max() <= 1e-13 * values[0])
    assert not len(e) or np.abs(u.T @ u - np.eye(len(e))).max() < 1e-13
    assert not len(e) or np.abs(v @ u - u * e).max() <= 1e-12 * values[0]


def test_product_sums_are_exact():
    z = np.array([[3_000_000_000, -5], [7, 1 << 40]])
    assert whitening.product_sums(z).tolist() == [[9 * 10**18 + 49, -15 * 10**9 + 7 * (1 << 40)], [-15 * 10**9 + 7 * (1 << 40), 25 + (1 << 80)]]
    z = np.random.default_rng(1).integers(-50_000_000, 50_000_000, (500, 3))
    assert (whitening.product_sums(z) == z.astype(object).T @ z.astype(object)).all()


def test_whitening_equals_dense_eigenvectors(spark):
    rng = np.random.default_rng(4)
    good = [(i, [float(x) for x in rng.normal(size=5) * [5, 4, 3, 2, 1]]) for i in range(60)]
    good += [(3, good[3][1]), (3, good[3][1]), (None, good[5][1])]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [math.nan] * 5), (104, [1.0, 2.0, math.inf, 0.0, 0.0]), (105, [1.0, 2.0])]
    rows = spark.createDataFrame([(*r, 1, 2, "x") for r in good + bad], "vec_id long, embedding array<float>, n int, x int, whitened string").repartition(7)
    got = whitening.whitened(rows, 4).collect()
    x = np.floor(np.array([np.float32(v).astype(float) for _, v in good]) * 1024) + 100000
    n = len(x)
    y = x - x.mean(0)
    w, u = np.linalg.eigh(y.T @ y / n)
    w, u = w[::-1][:4], u[:, ::-1][:, :4]
    want = y @ u / np.sqrt(w)
    assert len(got) == 4 * n and {r.n for r in got} == {n} and {r.component for r in got} == {1, 2, 3, 4}
    for k in range(4):
        mine = sorted(r.whitened for r in got if r.component == k + 1)
        assert min(np.abs(np.array(mine) - sorted(s * want[:, k])).max() for s in (1, -1)) < 1e-10
        assert abs(next(r.explained for r in got if r.component == k + 1) - w[k] / (y * y).sum() * n) < 1e-12
    whole = [[int(t) for t in v] for v in x]
    total = [sum(c) for c in zip(*whole, strict=True)]
    assert Counter(int(r.deviation) for r in got if r.component == 1) == Counter(sum((n * a - s) ** 2 for a, s in zip(v, total, strict=True)) for v in whole)
    assert max(r.identity_error for r in got) < 1e-10


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whitened(spark.createDataFrame(rows, schema)).collect() == []
    got = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0])], schema)).collect()
    assert sorted((r.component, abs(r.whitened), r.explained) for r in got) == [(1, 1.0, 1.0), (1, 1.0, 1.0)]


# ------------------------------------------------------------------ languages
def test_subwords_equal_a_scalar_walk():
    texts = ["", "A", "Ab, cD9éè x", "  12 ", "é", "word word", "x" * 40]
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    got, bounds = languages.buckets(np.frombuffer(b"".join(raw), np.uint8), off)
    for k, r in enumerate(raw):
        words, now = [], b""
        for b in r.lower() + b" ":
            if 97 <= b <= 122 or b >= 128:
                now += bytes([b])
            elif now:
                words.append(b" " + now + b" ")
                now = b""
        want = Counter((int.from_bytes(w[i:i + n], "little") + n) * languages.SPREAD % (1 << 64) >> (64 - languages.BITS)
                       for w in words for n in languages.SUBWORDS for i in range(len(w) - n + 1))
        assert Counter(got[bounds[k]:bounds[k + 1]].tolist()) == want, texts[k]


def test_languages_are_right_on_held_out_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = languages.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    n, right, taken, wrong = got.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.sum((~F.col("rejected")).cast("int")),
                                     F.sum((~F.col("rejected") & (F.col("lang") != F.col("lang_pred"))).cast("int"))).first()
    assert n > 200 and right >= 0.98 * n and wrong <= 0.02 * taken
    assert got.where("score < 0 or score > 1 or score is null").isEmpty()


def test_odd_texts_and_tables(spark):
    docs = table(spark, SF, "documents").select("doc_id", "lang", "text", F.lit("x").alias("score"), F.lit(1).alias("draw"))
    model = languages.train(docs)
    again = languages.train(docs.repartition(5))
    assert model.langs == again.langs and np.array_equal(model.weight, again.weight) and model.least == again.least
    odd = spark.createDataFrame([(None, None, None), (1, "en", ""), (1, "en", ""), (2, None, "12 !!\n"), (3, "xx", "€ 👍"), (4, "en", "the and of the"), (5, None, "é" * 300_000)],
                                "doc_id long, lang string, text string")
    got = [tuple(r) for r in languages.languages(odd, model).collect()]
    assert [r[2] for r in got[:5]] == ["und"] * 5 and all(r[3] == 0 and r[4] for r in got[:5])
    assert got[5][2] == "en" and got[6][2] in model.langs
    assert languages.languages(odd.limit(0)).isEmpty()
    assert {r.lang_pred for r in languages.languages(odd.where("lang is null or doc_id is null")).collect()} == {"und"}
    one = spark.createDataFrame([(i, "en", "the and") for i in range(9)], "doc_id long, lang string, text string")
    assert {r.lang_pred for r in languages.languages(one).collect()} == {"en"}
