"""Co-located merges into a bucketed catalog table."""

from __future__ import annotations

import datetime as dt
import re
import uuid

import pytest

from costframe.operators import bucketed as bk

KEYS = ["usage_date", "record_id"]
D1, D2, D3 = (dt.date(2024, 1, k) for k in (1, 2, 3))
SCHEMA = "usage_date date, record_id string, total_price double, status string"


def rows(df):
    return sorted((r.usage_date, r.record_id, r.total_price, r.status) for r in df.collect())


@pytest.fixture()
def table(spark, workdir):
    name = f"bucketed_{uuid.uuid4().hex[:8]}"
    start = [(D1, "a", 1.0, "ok"), (D1, "b", 2.0, "ok"), (D2, "c", 3.0, "ok"), (D2, "a", 4.0, "ok")]
    bk.create_bucketed(spark.createDataFrame(start, SCHEMA), name, KEYS, 4, f"{workdir}/{name}")
    yield name
    spark.sql(f"DROP TABLE {name}")


def test_merges_updates_and_inserts(spark, table):
    source = spark.createDataFrame([(D1, "a", None, "restated"), (D3, "d", 5.0, "new")], SCHEMA)
    before = {f for f in spark.table(table).inputFiles() if "2024-01-02" in f}
    for _ in range(2):
        assert bk.upsert_bucketed(spark, table, source, KEYS) == {"staged_rows": 2, "days": 2}
        assert rows(spark.table(table)) == [(D1, "a", None, "restated"), (D1, "b", 2.0, "ok"), (D2, "a", 4.0, "ok"), (D2, "c", 3.0, "ok"), (D3, "d", 5.0, "new")]
    assert {f for f in spark.table(table).inputFiles() if "2024-01-02" in f} == before
    assert bk.upsert_bucketed(spark, table, source.limit(0), KEYS) == {"staged_rows": 0, "days": 0}


def test_only_the_load_is_shuffled(spark, table, workdir):
    load = spark.createDataFrame([(D1, "a", 9.0, "x", 1)], SCHEMA + ", load_ordinal int")
    load.write.parquet(f"{workdir}/load")
    with bk._settings(spark):
        df = bk.merged_buckets(spark, table, spark.read.parquet(f"{workdir}/load"), KEYS, [D1], "load_ordinal")
        p = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1 and "SortMergeJoin" in p, p
    # the target's side of the join: a bucketed scan of the touched day, no exchange
    target_side = p[p.index("SortMergeJoin"):p.index("Exchange")]
    assert "Bucketed: true" in p and "PartitionFilters" in target_side and "2024-01-01" in target_side, p


def test_each_task_writes_its_bucket(spark, table):
    many = spark.createDataFrame([(D1, f"r{k}", float(k), "n") for k in range(500)], SCHEMA).repartition(6)
    bk.upsert_bucketed(spark, table, many, KEYS)
    files = [f for f in spark.table(table).inputFiles() if "2024-01-01" in f]
    assert len(files) == 4 and spark.table(table).count() == 504


def test_last_load_wins_and_duplicates_fail(spark, table):
    loads = spark.createDataFrame([(D1, "a", 5.0, "l1", 1), (D1, "a", 6.0, "l2", 2)], SCHEMA + ", load_ordinal int")
    bk.upsert_bucketed(spark, table, loads, KEYS, ordinal="load_ordinal")
    assert (D1, "a", 6.0, "l2") in rows(spark.table(table))
    before = rows(spark.table(table))
    with pytest.raises(ValueError, match="duplicate key inside one load"):
        bk.upsert_bucketed(spark, table, spark.createDataFrame([(D1, "b", 1.0, "x"), (D1, "b", 2.0, "y")], SCHEMA), KEYS)
    assert rows(spark.table(table)) == before


def test_settings_come_back(spark, table):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key, None)
    bk.upsert_bucketed(spark, table, spark.createDataFrame([(D1, "a", 1.0, "x")], SCHEMA), KEYS)
    assert spark.conf.get(key, None) == before


def test_a_plain_table_is_refused(spark, workdir):
    name = f"plain_{uuid.uuid4().hex[:8]}"
    spark.createDataFrame([(D1, "a", 1.0, "x")], SCHEMA).write.option("path", f"{workdir}/plain").saveAsTable(name)
    with pytest.raises(ValueError, match="not bucketed"):
        bk.upsert_bucketed(spark, name, spark.createDataFrame([(D1, "a", 1.0, "x")], SCHEMA), KEYS)
    spark.sql(f"DROP TABLE {name}")


def test_a_bucket_of_all_days_is_bounded(spark, workdir):
    """A merge task sorts a bucket of the touched days: more rows are more buckets, and the merge uses them all."""
    name = f"bucketed_{uuid.uuid4().hex[:8]}"
    rows_in = spark.createDataFrame([(d, f"r{k}", float(k), "ok") for d in (D1, D2, D3) for k in range(300)], SCHEMA)
    bk.create_bucketed(rows_in, name, KEYS, 4, f"{workdir}/{name}", bucket_rows=100)
    assert bk._bucket_spec(spark, name)[0] == 9
    bk.upsert_bucketed(spark, name, rows_in.where("total_price < 200").replace("ok", "new"), KEYS)
    assert len(spark.table(name).inputFiles()) == 27
    want = [(d, f"r{k}", float(k), "new" if k < 200 else "ok") for d in (D1, D2, D3) for k in range(300)]
    assert rows(spark.table(name)) == sorted(want)
    spark.sql(f"DROP TABLE {name}")


def test_buckets_follow_the_size_of_a_day():
    assert [bk.buckets_for(n, 100) for n in (0, 100, 101, 950)] == [1, 1, 2, 10]
