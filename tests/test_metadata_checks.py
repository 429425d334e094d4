"""Checks from metadata and bitmaps, suggestions for scope ids, VARIANT raw rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from costframe.operators import cdr
from costframe.operators import tables as tb
from costframe.plans import checks as ch

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in (0, 1, 2, 5, 9)]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_listing_answers_without_opening_files(spark, workdir):
    df = spark.createDataFrame([(d, f"r{k}") for k, d in enumerate(DAYS * 3)], "usage_date date, id string")
    tb.write_table(df, f"{workdir}/t")
    days = ch.day_listing(spark, f"{workdir}/t")
    p = plan(ch.coverage(days, "t"))
    assert "parquet" not in p.lower().replace("*.parquet", "") and "content" not in p
    as_of = dt.date(2024, 1, 11)
    assert rows(ch.coverage(days, "t")) == rows(ch.coverage(df, "t"))
    assert rows(ch.coverage_gaps(days, "t")) == rows(ch.coverage_gaps(df, "t"))
    assert rows(ch.freshness(days, "t", as_of)) == rows(ch.freshness(df, "t", as_of))


def test_footers_answer_for_flat_tables(spark, workdir):
    df = spark.createDataFrame([(d, f"r{k}") for k, d in enumerate(DAYS)] + [(None, "x")], "usage_date date, id string")
    df.repartition(3).write.parquet(f"{workdir}/flat")
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    assert ch.bounds_from_footers(spark, f"{workdir}/flat", "usage_date") == (DAYS[0], DAYS[-1])
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    as_of = dt.date(2024, 1, 20)
    assert rows(ch.freshness_from_footers(spark, f"{workdir}/flat", "t", as_of)) == rows(ch.freshness(df, "t", as_of))


def test_bitmaps_are_exact(spark):
    days = [dt.date(1, 1, 2), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(2024, 2, 29), dt.date(2024, 3, 2), dt.date(9999, 12, 31)]
    data = [("a", d) for d in days] + [("b", days[3]), ("b", days[4]), ("b", days[4]), (None, days[3]), (None, days[4]), ("c", None)]
    df = spark.createDataFrame(data, "service string, usage_date date")
    maps = ch.day_bitmaps(df, "service")
    assert sorted(((r.group, r.day) for r in ch.days_of(maps).collect()), key=repr) == sorted({x for x in data if x[1]}, key=repr)
    want = ch.coverage_by(df.where("usage_date IS NOT NULL"), "t", "service")
    assert rows(ch.coverage_from_bitmaps(maps, "t")) == rows(want)
    both = ch.merge_bitmaps(ch.day_bitmaps(df.where("service = 'a'"), "service"), maps)
    assert rows(ch.coverage_from_bitmaps(both, "t")) == rows(want)
    assert rows(ch.gaps_from_bitmaps(ch.day_bitmaps(df.where("service = 'b' OR service IS NULL"), "service"), "t")) == sorted(
        [("t", "b", dt.date(2024, 3, 1)), ("t", None, dt.date(2024, 3, 1))], key=repr)


def test_bitmaps_combine_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", DAYS[0])], "service string, usage_date date")
    p = plan(ch.day_bitmaps(df, "service"))
    assert "partial_bitmap_construct_agg" in p and p.count("Exchange") == 1


@pytest.mark.parametrize(("wanted", "have", "distance"), [
    ("services/ABC", "abc", 0), ("abc", "ABC", 0), ("abd", "abc", 1), ("ab", "abc", 1), ("abcd", "abc", 1), ("acb", "abc", None), ("a", "b", 1),
    ("xabc", "abc", 1), ("abc", "projects/abcd", 1), ("abcde", "abc", None), ("", "a", 1), ("abc", "abc", None), ("p/q/abc", "abc", 0)])
def test_suggestions(spark, wanted, have, distance):
    got = ch.scope_suggestions(spark, spark.createDataFrame([(have,), (have,), (None,)], "id string"), "s", [wanted], ["id"]).collect()
    assert [tuple(r) for r in got] == ([] if distance is None else [("s", wanted, have, distance)])


def test_variant_rows_through_an_upsert(spark, workdir):
    schema = "usage_date date, record_id string, raw string"
    first = spark.createDataFrame([(DAYS[0], "a", '{"status":"ok","n":"7","deep":{"k":3}}'), (DAYS[0], "b", "not json")], schema)
    then = spark.createDataFrame([(DAYS[0], "a", '{"status":"late","n":"x"}'), (DAYS[1], "c", None)], schema)
    for load in (first, then):
        tb.upsert_table(spark, f"{workdir}/t", cdr.variant_raw(load), ["usage_date", "record_id"])
    t = spark.read.parquet(f"{workdir}/t")
    assert dict(t.dtypes)["raw"] == "variant"
    t = cdr.promote_variant_field(cdr.promote_variant_field(t, "status"), "n", cast="int")
    assert rows(t.select("record_id", "status", "n")) == [("a", "late", None), ("b", None, None), ("c", None, None)]
    deep = cdr.promote_variant_field(cdr.variant_raw(first), "deep.k", "k", "bigint")
    assert rows(deep.select("record_id", "k")) == [("a", 3), ("b", None)]
    assert F is not None
