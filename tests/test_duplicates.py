"""Duplicate keys by suspects: the rows of the plain count, and what is moved for them."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from costframe import fixtures as fx
from costframe.plans import duplicates as du
from costframe.plans.checks import duplicate_keys

from conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("keys", [["l_orderkey", "l_linenumber"], ["l_partkey", "l_shipdate"], ["l_returnflag"]])
def test_equals_the_plain_count(spark, keys):
    df = fx.table(spark, SF_SMALL, "lineitem").repartition(5)
    assert rows(du.duplicate_keys_by_suspects(df, keys)) == rows(duplicate_keys(df, keys))


def test_null_keys_and_a_hot_key(spark):
    """Nulls are equal, -0.0 is 0.0, and one key holds half of the rows."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 2 == 0, F.lit(None)).when(F.col("id") < 8, F.lit(0.0) * F.when(F.col("id") < 4, -1).otherwise(1))
        .otherwise(F.col("id").cast("double")).alias("place"), F.lit(None).cast("string").alias("Part"))
    got = rows(du.duplicate_keys_by_suspects(df, ["place", "Part"]))
    assert got == rows(duplicate_keys(df, ["place", "Part"])) and (None, None, 1500) in got


def test_empty_table_and_too_many_suspects(spark):
    df = spark.range(50).select((F.col("id") % 10).alias("k"))
    assert rows(du.duplicate_keys_by_suspects(df.limit(0), ["k"])) == []
    assert rows(du.duplicate_keys_by_suspects(df, ["k"], limit=9)) == [(k, 5) for k in range(10)]


def test_packed_runs_of_many_parts_and_tasks(monkeypatch):
    """Places that meet from several runs, parts of every kind, steps of every width."""
    rng = np.random.default_rng(3)
    shift = 58
    runs = [np.concatenate([rng.integers(0, 1 << 62, 500), np.arange(40) + 7, [1 << 60] * 30]) for _ in range(4)]
    packed = [p for r in runs for p in du._packed(r, shift)]
    assert sum(p["places"] for p in packed) < sum(map(len, runs)) and {p["width"] for p in packed} == {8}
    packed += list(du._packed(np.arange(300), shift))
    got = [du._twice(n, [(p["places"], p["width"], p["data"]) for p in packed if p["part"] == n], shift) for n in {p["part"] for p in packed}]
    at, n = np.unique(np.concatenate([*runs, np.arange(300)]), return_counts=True)
    assert sorted(np.concatenate(got).tolist()) == at[n > 1].tolist()


def test_space_grows_with_the_table():
    """Few clashes at every size: 64 places a row, and no more than 2**19 pairs of keys on one place."""
    for n in (0, 1, 1000, 10**7, 10**9, 10**12):
        bits = du.hash_bits(n)
        assert 16 <= bits <= 62 and 2**bits >= 64 * n and n * n / 2 / 2**bits <= 2**20


def test_only_packed_places_and_suspects_move(spark):
    """Unique keys of 40 letters: the first exchange moves a few bytes for each, the second none."""
    df = spark.range(200_000).select(F.concat(F.lit("x" * 30), F.lpad(F.col("id").cast("string"), 10, "0")).alias("k")).repartition(4)
    packed = du.suspects(df, ["k"], 200_000)
    assert packed.count() <= 1 << 11
    p = plan(du.duplicate_keys_by_suspects(df, ["k"]))
    assert "BroadcastHashJoin" in p and "LeftSemi" in p and "partial_count" in p
    assert p.index("BroadcastHashJoin") > p.index("partial_count")
    bits = du.hash_bits(200_000)
    run = np.array([r[0] for r in df.limit(50_000).select(du.place(["k"], bits)).collect()])
    assert sum(len(x["data"]) for x in du._packed(run, bits)) < 3 * len(run)
