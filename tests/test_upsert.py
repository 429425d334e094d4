"""Keyed upsert: algebraic checks (idempotent, last wins, no deletes, NULL
overwrites, duplicate and NULL keys fail) and the day-partitioned write path."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from costframe.operators.tables import (collapse_loads, conform, merge, replace_days, upsert_table,
                                        write_table)
from costframe.schemas import CDR_SCHEMA, required

KEYS = ["usage_date", "record_id"]
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
SCHEMA = "usage_date date, record_id string, total_price double, status string"


def rows(df):
    return sorted((r.usage_date, r.record_id, r.total_price, r.status) for r in df.collect())


def test_merge_updates_inserts_never_deletes(spark):
    target = spark.createDataFrame([(D1, "a", 1.0, "ok"), (D1, "b", 2.0, "ok"), (D2, "c", 3.0, "ok")], SCHEMA)
    source = spark.createDataFrame([(D1, "a", None, "restated"), (D2, "d", 4.0, "new")], SCHEMA)
    out = merge(target, collapse_loads(source, KEYS), KEYS)
    assert rows(out) == [(D1, "a", None, "restated"), (D1, "b", 2.0, "ok"),
                         (D2, "c", 3.0, "ok"), (D2, "d", 4.0, "new")]


def test_merge_is_idempotent(spark):
    target = spark.createDataFrame([(D1, "a", 1.0, "ok"), (D2, "c", 3.0, "ok")], SCHEMA)
    source = spark.createDataFrame([(D1, "a", 9.0, "x"), (D2, "d", 4.0, "new")], SCHEMA)
    once = merge(target, collapse_loads(source, KEYS), KEYS)
    twice = merge(once, collapse_loads(source, KEYS), KEYS)
    assert rows(once) == rows(twice)


def test_later_load_wins(spark):
    loads = spark.createDataFrame([(D1, "a", 1.0, "first", 1), (D1, "a", 2.0, "second", 2),
                                   (D1, "b", 5.0, "only", 1)],
                                  SCHEMA + ", load_ordinal int")
    out = collapse_loads(loads, KEYS, "load_ordinal")
    assert rows(out) == [(D1, "a", 2.0, "second"), (D1, "b", 5.0, "only")]


def test_duplicate_key_in_one_load_fails(spark):
    source = spark.createDataFrame([(D1, "a", 1.0, "x"), (D1, "a", 2.0, "y")], SCHEMA)
    with pytest.raises(Exception, match="duplicate key"):
        collapse_loads(source, KEYS).collect()


def test_same_key_other_day_is_another_row(spark):
    source = spark.createDataFrame([(D1, "a", 1.0, "x"), (D2, "a", 2.0, "y")], SCHEMA)
    assert collapse_loads(source, KEYS).count() == 2


def test_conform_rejects_null_key(spark):
    df = spark.createDataFrame([(None, "a", "SMS", "SMS")],
                               "usage_date date, record_id string, product string, category string")
    with pytest.raises(Exception, match="required column usage_date"):
        conform(df, CDR_SCHEMA, required(CDR_SCHEMA)).collect()


def test_conform_casts_and_orders(spark):
    df = spark.createDataFrame([("2024-01-01", "a", "SMS", "SMS", "1.5")],
                               "usage_date string, record_id string, product string, category string, "
                               "total_price string")
    out = conform(df, CDR_SCHEMA, required(CDR_SCHEMA))
    assert out.columns == [f.name for f in CDR_SCHEMA.fields]
    r = out.first()
    assert r.usage_date == D1 and r.total_price == 1.5 and r.raw is None


def test_replace_days_drops_whole_days(spark):
    target = spark.createDataFrame([(D1, "a", 1.0, "ok"), (D1, "b", 2.0, "ok"), (D2, "c", 3.0, "ok")], SCHEMA)
    source = spark.createDataFrame([(D1, "a", 7.0, "restated")], SCHEMA)
    assert rows(replace_days(target, source)) == [(D1, "a", 7.0, "restated"), (D2, "c", 3.0, "ok")]


def test_upsert_table_touches_only_source_days(spark, workdir):
    target = spark.createDataFrame([(D1, "a", 1.0, "ok"), (D2, "c", 3.0, "ok")], SCHEMA)
    path = f"{workdir}/t"
    write_table(target, path)
    d2_files = sorted(f for f in spark.read.parquet(path).inputFiles() if "usage_date=2024-01-02" in f)
    source = spark.createDataFrame([(D1, "a", 5.0, "restated"), (D1, "z", 6.0, "new")], SCHEMA)
    info = upsert_table(spark, path, source, KEYS)
    assert info == {"staged_rows": 2, "days": 1}
    out = spark.read.parquet(path)
    assert rows(out) == [(D1, "a", 5.0, "restated"), (D1, "z", 6.0, "new"), (D2, "c", 3.0, "ok")]
    # the untouched day keeps its files
    assert sorted(f for f in out.inputFiles() if "usage_date=2024-01-02" in f) == d2_files
    before = rows(out)
    # same load again: same table
    upsert_table(spark, path, source, KEYS)
    assert rows(spark.read.parquet(path)) == before


def test_upsert_table_empty_source_is_noop(spark, workdir):
    target = spark.createDataFrame([(D1, "a", 1.0, "ok")], SCHEMA)
    path = f"{workdir}/t"
    write_table(target, path)
    info = upsert_table(spark, path, target.limit(0), KEYS)
    assert info["staged_rows"] == 0
    assert rows(spark.read.parquet(path)) == [(D1, "a", 1.0, "ok")]


def test_upsert_table_first_load_creates(spark, workdir):
    source = spark.createDataFrame([(D1, "a", 1.0, "ok"), (D2, "b", 2.0, "ok")], SCHEMA)
    path = f"{workdir}/new"
    upsert_table(spark, path, source, KEYS)
    out = spark.read.parquet(path)
    assert rows(out) == [(D1, "a", 1.0, "ok"), (D2, "b", 2.0, "ok")]


def test_upsert_table_replace_days_mode(spark, workdir):
    target = spark.createDataFrame([(D1, "a", 1.0, "ok"), (D1, "b", 2.0, "ok"), (D2, "c", 3.0, "ok")], SCHEMA)
    path = f"{workdir}/t"
    write_table(target, path)
    source = spark.createDataFrame([(D1, "a", 7.0, "restated")], SCHEMA)
    upsert_table(spark, path, source, KEYS, mode="replace_days")
    assert rows(spark.read.parquet(path)) == [(D1, "a", 7.0, "restated"), (D2, "c", 3.0, "ok")]


def test_collapse_plan_shuffles_once(spark):
    source = spark.createDataFrame([(D1, "a", 1.0, "x", 1)], SCHEMA + ", load_ordinal int")
    plan = collapse_loads(source, KEYS, "load_ordinal")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert F is not None


def test_upsert_table_rejects_duplicate_load(spark, workdir):
    source = spark.createDataFrame([(D1, "a", 1.0, "x"), (D1, "a", 2.0, "y")], SCHEMA)
    with pytest.raises(ValueError, match="duplicate key"):
        upsert_table(spark, f"{workdir}/dup", source, KEYS)


def test_upsert_table_several_loads_last_wins(spark, workdir):
    path = f"{workdir}/t"
    write_table(spark.createDataFrame([(D1, "a", 1.0, "ok"), (D1, "b", 2.0, "ok")], SCHEMA), path)
    loads = spark.createDataFrame([(D1, "a", 3.0, "l1", 1), (D1, "a", 4.0, "l2", 2), (D1, "c", 5.0, "l1", 1)],
                                  SCHEMA + ", load_ordinal int")
    upsert_table(spark, path, loads, KEYS, ordinal="load_ordinal")
    assert rows(spark.read.parquet(path)) == [(D1, "a", 4.0, "l2"), (D1, "b", 2.0, "ok"), (D1, "c", 5.0, "l1")]


def test_duplicate_in_older_load_fails(spark):
    loads = spark.createDataFrame([(D1, "a", 1.0, "x", 1), (D1, "a", 2.0, "y", 1), (D1, "a", 3.0, "z", 2)],
                                  SCHEMA + ", load_ordinal int")
    with pytest.raises(Exception, match="duplicate key"):
        collapse_loads(loads, KEYS, "load_ordinal").collect()


def test_hot_day_is_split_across_tasks(spark, workdir):
    # One day holds a third of the rows: the (day, key) range layout cuts it
    # into several write tasks instead of one.
    hot = [(D1, f"h{i:05d}", float(i), "x") for i in range(3000)]
    cold = [(D2 + dt.timedelta(days=i % 20), f"c{i:05d}", float(i), "x") for i in range(6000)]
    path = f"{workdir}/skew"
    upsert_table(spark, path, spark.createDataFrame(hot + cold, SCHEMA), KEYS)
    files = [f for f in spark.read.parquet(path).inputFiles() if "usage_date=2024-01-01" in f]
    assert len(files) >= 2, files
    assert spark.read.parquet(path).count() == 9000


def test_upsert_table_only_new_days(spark, workdir):
    path = f"{workdir}/t"
    write_table(spark.createDataFrame([(D1, "a", 1.0, "ok")], SCHEMA), path)
    info = upsert_table(spark, path, spark.createDataFrame([(D2, "b", 2.0, "new")], SCHEMA), KEYS)
    assert info == {"staged_rows": 1, "days": 1}
    assert rows(spark.read.parquet(path)) == [(D1, "a", 1.0, "ok"), (D2, "b", 2.0, "new")]


def test_upsert_table_many_days_lists_once(spark, workdir):
    # Whatever the number of days, one listing finds their folders.
    from costframe.operators import tables as tb

    path = f"{workdir}/t"
    write_table(spark.createDataFrame([(D1, "a", 1.0, "ok"), (D2, "b", 2.0, "ok")], SCHEMA), path)
    source = spark.createDataFrame([(D1, "a", 5.0, "new"), (D2, "c", 6.0, "new")], SCHEMA)
    assert upsert_table(spark, path, source, KEYS)["days"] == 2
    assert rows(spark.read.parquet(path)) == [(D1, "a", 5.0, "new"), (D2, "b", 2.0, "ok"), (D2, "c", 6.0, "new")]
