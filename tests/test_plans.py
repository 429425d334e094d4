"""Plan shape: filters reach the scan, aggregates are partial before the
shuffle, nothing is a cartesian product, top-k is TakeOrderedAndProject."""

from __future__ import annotations

import datetime as dt

from conftest import SF_SMALL

from costframe import catalog as cat
from costframe import fixtures as fx
from costframe.operators.tables import write_table
from costframe.plans import reports as rp


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_breakdown_plan(spark):
    p = plan(rp.cost_breakdown(fx.bill(spark, SF_SMALL), cat.AS_OF_SUMMER))
    assert "TakeOrderedAndProject" in p
    assert "partial_sum" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_breakdown_prunes_day_partitions(spark, workdir):
    from pyspark.sql import functions as F

    b = fx.bill(spark, SF_SMALL).withColumn("usage_date", F.to_date("usage_start_time"))
    write_table(b.filter(F.year("usage_date") == 1998), f"{workdir}/bill")
    table = spark.read.parquet(f"{workdir}/bill")
    p = plan(rp.cost_breakdown(table, dt.date(1998, 8, 19), projects=["3"], services=["Brand#11"], usage_day_col="usage_date"))
    assert "PartitionFilters: [isnotnull(usage_date" in p
    assert "PushedFilters: [" in p and "usage_start_time" in p
    # only the month's day folders (plus the edge days) are scanned
    assert "usage_date#" in p and "1998-07-31" in p and "1998-09-01" in p


def test_cur_report_pushes_date_filter(spark, workdir):
    from pyspark.sql import functions as F

    write_table(fx.cur(spark, SF_SMALL).filter(F.year("usage_date") == 1998), f"{workdir}/cur")
    p = plan(rp.cur_cost_by_service(spark.read.parquet(f"{workdir}/cur"), cat.AS_OF_SUMMER))
    assert "PartitionFilters: [isnotnull(usage_date" in p
    assert "partial_sum" in p


def test_duplicate_keys_is_partial_aggregate(spark):
    from costframe.plans.checks import duplicate_keys

    p = plan(duplicate_keys(fx.table(spark, SF_SMALL, "lineitem"), ["l_orderkey", "l_linenumber"]))
    assert "partial_count" in p


def test_scope_audit_filter_reaches_scan(spark):
    from costframe.plans.checks import scope_audit

    df = scope_audit(spark, fx.bill(spark, SF_SMALL), "service", ["Brand#11"], ["service.id"])
    assert "CartesianProduct" not in plan(df)


def test_breakdown_never_explodes_credits(spark):
    p = plan(rp.cost_breakdown(fx.bill(spark, SF_SMALL), cat.AS_OF_SUMMER))
    assert "Generate" not in p          # credit sums stay inside the row (HOFs)


def test_coverage_by_combines_before_shuffle(spark):
    from costframe.plans.checks import coverage_by

    lines = plan(coverage_by(fx.cur(spark, SF_SMALL), "cur", "product_name")).splitlines()
    # (group, day) pairs are made distinct map-side, right below their exchange
    at = next(i for i, ln in enumerate(lines) if "Exchange hashpartitioning(group" in ln and "day" in ln)
    assert "HashAggregate(keys=[group" in lines[at + 1], "\n".join(lines)



def test_freshness_from_folders_equals_scan(spark, workdir):
    from pyspark.sql import functions as F

    from costframe.plans.checks import freshness, freshness_from_folders

    path = f"{workdir}/cur-fresh"
    write_table(fx.cur(spark, SF_SMALL).filter(F.year("usage_date") == 2001), path)
    as_of = dt.date(2001, 11, 10)
    a = freshness(spark.read.parquet(path), "cur", as_of).collect()
    b = freshness_from_folders(spark, path, "cur", as_of).collect()
    assert a == b and a[0].lag_days == 6 and a[0].fresh is False


def test_side_by_side_prunes_the_export(spark, workdir):
    from pyspark.sql import functions as F

    b = fx.bill(spark, SF_SMALL).withColumn("usage_date", F.to_date("usage_start_time"))
    write_table(b.filter(F.year("usage_date") == 1998), f"{workdir}/bill-sides")
    p = plan(rp.sources_side_by_side(spark.read.parquet(f"{workdir}/bill-sides"), fx.cur(spark, SF_SMALL), fx.cdr(spark, SF_SMALL), bill_as_of=cat.AS_OF_SUMMER,
                                     cur_as_of=cat.AS_OF_SUMMER, cdr_as_of=cat.CDR_AS_OF, usage_day_col="usage_date"))
    assert "PartitionFilters: [isnotnull(usage_date" in p and "1998-07-31" in p


def test_lateral_view_leaves_no_view_behind(spark):
    before = {t.name for t in spark.catalog.listTables()}
    rp.credit_columns_lateral(spark, fx.bill(spark, SF_SMALL)).limit(1).collect()
    assert {t.name for t in spark.catalog.listTables()} == before
