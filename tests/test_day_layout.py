"""One-pass upserts: the day layout, their plan, merges on condition, and day sums kept current."""

from __future__ import annotations

import datetime as dt
import itertools

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from costframe import catalog as cat
from costframe import fixtures as fx
from costframe.operators import tables as tb
from costframe.plans import daysums as ds
from costframe.plans import reports as rp

KEYS = ["usage_date", "record_id"]
D = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(40)]
SCHEMA = "usage_date date, record_id string, total_price double, load_ordinal string"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_layout_cuts_hot_days_and_packs_small_ones():
    sizes = {d: 10 for d in D} | {D[7]: 4000}
    layout = tb.day_layout(sizes, least_tasks=20, part_bytes=1 << 20)
    by = {d: (pack, parts) for d, pack, parts in layout}
    assert sorted(by) == D and by[D[7]][1] >= 10
    assert [d for d in D if by[d][0] == by[D[7]][0]] == [D[7]]
    assert {parts for d, (_, parts) in by.items() if d != D[7]} == {1}
    assert len({pack for pack, _ in by.values()}) <= 4  # the others share the packs beside it
    big = tb.day_layout({d: 700 for d in D}, least_tasks=1, part_bytes=100)
    assert {parts for _, _, parts in big} == {7} and len({p for _, p, _ in big}) == len(D)
    assert tb.day_layout({D[0]: 0}, 8) == [(D[0], 0, 1)]


def _merged(spark, loads, target, keep=False):
    layout = spark.createDataFrame([(d, 0, 2) for d in D[:3]], "usage_date date, _pack int, _parts int")
    return tb.merged_days(loads, target, KEYS, layout, 2, "usage_date", "load_ordinal", keep)


def test_upsert_plan_has_one_exchange_and_no_sampling(spark, workdir):
    rows = spark.createDataFrame([(D[0], "a", 1.0, "1"), (D[1], "b", 2.0, "1")], SCHEMA)
    rows.write.parquet(f"{workdir}/staged")
    tb.write_table(rows.drop("load_ordinal"), f"{workdir}/t")
    p = plan(_merged(spark, spark.read.parquet(f"{workdir}/staged"), spark.read.parquet(f"{workdir}/t")))
    assert p.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in p and "SortMergeJoin" not in p, p


@pytest.mark.parametrize("order", list(itertools.permutations("012")))
def test_loads_in_any_order_give_the_newest(spark, workdir, order):
    path = f"{workdir}/{''.join(order)}"
    pulls = {"0": [(D[0], "a", 0.0), (D[1], "b", 0.0)], "1": [(D[1], "b", 1.0), (D[2], "c", 1.0)], "2": [(D[2], "c", 2.0), (D[2], "d", 2.0)]}
    for n in order:
        load = spark.createDataFrame([(*r, n) for r in pulls[n]], SCHEMA)
        tb.upsert_table(spark, path, load, KEYS, ordinal="load_ordinal", keep_ordinal=True)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select(*SCHEMA.replace(" date", "").replace(" string", "").replace(" double", "").split(", ")).collect())
    assert got == [(D[0], "a", 0.0, "0"), (D[1], "b", 1.0, "1"), (D[2], "c", 2.0, "2"), (D[2], "d", 2.0, "2")]


def test_same_ordinal_again_restates(spark, workdir):
    for price in (1.0, 5.0):
        tb.upsert_table(spark, f"{workdir}/t", spark.createDataFrame([(D[0], "a", price, "7")], SCHEMA), KEYS, ordinal="load_ordinal", keep_ordinal=True)
    assert [r.total_price for r in spark.read.parquet(f"{workdir}/t").collect()] == [5.0]


def test_condition_needs_the_stored_ordinal(spark, workdir):
    load = spark.createDataFrame([(D[0], "a", 1.0, "7")], SCHEMA)
    tb.upsert_table(spark, f"{workdir}/t", load, KEYS, ordinal="load_ordinal")
    with pytest.raises(ValueError, match="no column load_ordinal"):
        tb.upsert_table(spark, f"{workdir}/t", load, KEYS, ordinal="load_ordinal", keep_ordinal=True)


@pytest.mark.parametrize("keep", [False, True])
def test_duplicate_in_an_older_load_fails_and_leaves_the_table(spark, workdir, keep):
    path = f"{workdir}/t"
    tb.upsert_table(spark, path, spark.createDataFrame([(D[0], "a", 1.0, "0")], SCHEMA), KEYS, ordinal="load_ordinal", keep_ordinal=keep)
    loads = spark.createDataFrame([(D[0], "a", 2.0, "1"), (D[0], "a", 3.0, "1"), (D[0], "a", 4.0, "2")], SCHEMA)
    with pytest.raises(ValueError, match="duplicate key inside one load.*record_id"):
        tb.upsert_table(spark, path, loads, KEYS, ordinal="load_ordinal", keep_ordinal=keep)
    assert [r.total_price for r in spark.read.parquet(path).collect()] == [1.0]


def test_upsert_days_names_the_days(spark, workdir):
    load = spark.createDataFrame([(D[3], "a", 1.0, "0"), (D[1], "b", 1.0, "0")], SCHEMA)
    assert tb.upsert_days(spark, f"{workdir}/t", load, KEYS, ordinal="load_ordinal")[1] == [D[1], D[3]]
    assert tb.upsert_days(spark, f"{workdir}/t", load.limit(0), KEYS, ordinal="load_ordinal") == ({"staged_rows": 0, "days": 0}, [])


def test_report_from_day_sums_reads_only_the_sums_of_its_months(spark, workdir):
    path = f"{workdir}/sums"
    ds.refresh_day_sums(spark, fx.bill(spark, SF_SMALL).filter(F.year("usage_start_time") == 1998), path)
    p = plan(ds.cost_from_day_sums(spark.read.parquet(path), cat.AS_OF_SUMMER))
    assert path in p and "PartitionFilters: [isnotnull(usage_month" in p and p.count("FileScan") == 1
    assert "partial_sum" in p and "TakeOrderedAndProject" in p


@pytest.mark.parametrize("offset", [0, -1])
def test_day_sums_equal_the_report_over_rows_in_any_month(spark, workdir, offset):
    """Winter and summer, rows of the hour before local midnight, months in arrears, scopes, and a day that lost its rows."""
    path = f"{workdir}/sums-{offset}"
    bill = fx.bill(spark, SF_SMALL).filter(F.year("usage_start_time").isin(1997, 1998))
    ds.refresh_day_sums(spark, bill, path, fee_skus=cat.FEE_SKUS)
    gone = dt.date(1998, 1, 20)
    left = bill.filter(F.to_date(F.col("usage_start_time").cast("timestamp")) != F.lit(gone))
    ds.refresh_day_sums(spark, left, path, [gone], fee_skus=cat.FEE_SKUS)
    sums = spark.read.parquet(path)
    for as_of in (cat.AS_OF_SUMMER, cat.AS_OF_WINTER, dt.date(1998, 4, 1)):
        for scope in ({}, {"projects": cat.PLATFORM_PROJECTS, "services": cat.PLATFORM_SERVICES}):
            want = rp.cost_breakdown(left, as_of, month_offset=offset, fee_skus=cat.FEE_SKUS, limit=None, **scope).collect()
            got = ds.cost_from_day_sums(sums, as_of, month_offset=offset, limit=None, **scope).collect()
            assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_first_day_sums_are_written_once(spark, workdir, monkeypatch):
    """A new table needs no staging copy; making an existing one again keeps its sums until the new ones are there."""
    path = f"{workdir}/first"
    bill = fx.bill(spark, SF_SMALL).filter(F.year("usage_start_time") == 1998)
    with monkeypatch.context() as m:
        m.setattr(ds, "scratch_path", lambda *_: pytest.fail("the sums of a new table are staged"))
        ds.refresh_day_sums(spark, bill, path)
    want = [tuple(r) for r in rp.cost_breakdown(bill, cat.AS_OF_SUMMER, limit=None).collect()]
    for _ in range(2):
        assert [tuple(r) for r in ds.cost_from_day_sums(spark.read.parquet(path), cat.AS_OF_SUMMER, limit=None).collect()] == want != []
        ds.refresh_day_sums(spark, bill, path)
