"""Loads in waves of days, and the shuffle files that landings and loads leave."""

from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from costframe import landing
from costframe.landing import land_cur
from costframe.operators import tables as tb
from costframe.session import settings
from costframe.sources import files
from costframe.sources.cur import cur_scan

KEYS = ["usage_date", "record_id"]
SCHEMA = "usage_date date, record_id string, total_price double, load_ordinal int"
D = [dt.date(2024, 1, 20) + dt.timedelta(days=k) for k in range(12)]


@pytest.fixture(params=[1, 10**9], ids=["waves", "one"])
def waves(request, monkeypatch):
    monkeypatch.setattr(tb, "WAVE_BYTES", request.param)
    monkeypatch.setattr(tb, "WAVE_CORE_BYTES", 0)
    monkeypatch.setattr(tb, "MOST_WAVES", 3)
    return request.param == 1


def shuffled(spark) -> int:
    """Bytes of shuffle files on disk."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(i).length() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_"))


def freed(spark, most: int) -> bool:
    """Files go in the background."""
    until = time.time() + 20
    while shuffled(spark) > most and time.time() < until:
        time.sleep(0.2)
    return shuffled(spark) <= most


def load(spark, days, value, ordinal=0, ids="abc"):
    return spark.createDataFrame([(d, f"{i}{d.day}", value, ordinal) for d in days for i in ids], SCHEMA).repartition(3)


def table(spark, path):
    return sorted((r.usage_date, r.record_id, r.total_price) for r in spark.read.parquet(path).collect())


def beside(spark, workdir):
    return [p for p in files.glob(spark, f"{workdir}/.*") if "merging" in p]


def test_waves_hold_successive_days():
    sizes = {d: 10 for d in D} | {D[7]: 400}
    found = tb.day_waves(sizes, 45)
    assert [d for w in found for d in w] == D and {d: n for w in found for d, n in w.items()} == sizes
    assert [len(w) for w in found] == [4, 3, 1, 4] and max(sum(w.values()) for w in found if D[7] not in w) <= 45
    assert tb.day_waves(sizes, 10**6) == [sizes]


@pytest.mark.parametrize("keep", [False, True])
def test_loads_in_waves_give_the_same_table(spark, workdir, waves, keep, monkeypatch):
    merged = []
    run = tb.merged_days
    monkeypatch.setattr(tb, "merged_days", lambda *a: merged.append(1) or run(*a))
    path = f"{workdir}/t"
    how = {"ordinal": "load_ordinal", "keep_ordinal": keep}
    first = load(spark, D[:8], 1.0).unionByName(load(spark, D[:8:2], 2.0, 1, "a"))
    assert tb.upsert_days(spark, path, first, KEYS, **how) == ({"staged_rows": 28, "days": 8}, D[:8])
    assert 3 <= len(merged) <= 4 if waves else len(merged) == 1
    want = {(d, f"{i}{d.day}"): 2.0 if i == "a" and k % 2 == 0 else 1.0 for k, d in enumerate(D[:8]) for i in "abc"}
    assert table(spark, path) == sorted((*k, v) for k, v in want.items())
    # days of the table, and days that it lacks
    tb.upsert_table(spark, path, load(spark, D[5:], 5.0, 2, "bz"), KEYS, **how)
    want |= {(d, f"{i}{d.day}"): 5.0 for d in D[5:] for i in "bz"}
    assert table(spark, path) == sorted((*k, v) for k, v in want.items())
    if not keep:
        tb.upsert_table(spark, path, load(spark, D[9:], 7.0, 3, "q"), KEYS, mode="replace_days", **how)
        want = {k: v for k, v in want.items() if k[0] < D[9]} | {(d, f"q{d.day}"): 7.0 for d in D[9:]}
        assert table(spark, path) == sorted((*k, v) for k, v in want.items())
    assert beside(spark, workdir) == []


@pytest.mark.parametrize("new_table", [False, True])
def test_a_duplicate_in_the_last_wave_replaces_nothing(spark, workdir, waves, new_table):
    path = f"{workdir}/t"
    if not new_table:
        tb.upsert_table(spark, path, load(spark, D, 1.0), KEYS, ordinal="load_ordinal")
    twice = load(spark, D, 2.0).unionByName(load(spark, D[-1:], 3.0, 0, "c"))
    with pytest.raises(ValueError, match="duplicate key inside one load.*record_id"):
        tb.upsert_table(spark, path, twice, KEYS, ordinal="load_ordinal")
    if not new_table:
        assert {r[2] for r in table(spark, path)} == {1.0}
    assert beside(spark, workdir) == []


def test_a_load_leaves_no_shuffle_files(spark, workdir, waves):
    source = load(spark, D, 1.0, ids=[f"{n:05d}" for n in range(300)]).localCheckpoint()
    before = shuffled(spark)
    tb.upsert_table(spark, f"{workdir}/t", source, KEYS, ordinal="load_ordinal")
    assert freed(spark, before)


def test_landing_does_not_shuffle_the_report(spark, workdir, monkeypatch):
    """What a landing shuffles does not grow with the report, and its shuffle files go."""
    text = F.concat(F.lit("row "), F.col("id").cast("string"), F.lit(", "), F.sha2(F.col("id").cast("string"), 512))
    day = F.concat(F.lit("2024-0"), (F.col("id") % 5 + 1).cast("string"), F.lit("-07T00:00:00Z"))
    raw = spark.range(0, 20000, 1, 3).select(text.alias("identity/LineItemId"), day.alias("lineItem/UsageStartDate"))
    with monkeypatch.context() as m:
        m.setattr(landing, "FREE_SHUFFLES", {})
        before = shuffled(spark)
        assert len(land_cur(spark, raw, f"{workdir}/a", "costs", part_rows=1000)) == 5
        assert shuffled(spark) - before < 10_000
    before = shuffled(spark)
    land_cur(spark, raw.repartition(5), f"{workdir}/b", "costs")
    assert freed(spark, before)
    for folder in "ab":
        got = cur_scan(spark, f"{workdir}/{folder}", "costs").select(*[f"`{c}`" for c in raw.columns])
        assert sorted(got.collect()) == sorted(raw.collect())


def test_parts_follow_the_rows_and_not_the_pieces_of_a_report(spark, workdir):
    raw = spark.range(0, 400, 1, 300).select(F.col("id").cast("string").alias("identity/LineItemId"), F.lit("2024-03-07").alias("lineItem/UsageStartDate"))
    land_cur(spark, raw, workdir, "costs")
    assert len(cur_scan(spark, workdir, "costs").inputFiles()) <= max(2, spark.sparkContext.defaultParallelism)


def test_settings_are_as_before_after_a_failure(spark):
    keys = {"spark.sql.maxConcurrentOutputFileWriters": "7", "spark.sql.shuffle.partitions": "3"}
    before = {k: spark.conf.get(k) for k in keys}
    with pytest.raises(ZeroDivisionError), settings(spark, keys):
        assert {k: spark.conf.get(k) for k in keys} == keys
        1 / 0  # noqa: B018
    assert {k: spark.conf.get(k) for k in keys} == before
