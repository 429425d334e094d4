"""Column helpers: number parsing, credits, keys, month windows."""

from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costframe.functions import credits as cr
from costframe.functions import dates as d
from costframe.functions import keys as k
from costframe.functions import numbers as n


def test_tolerant_double(spark):
    texts = ["", "abc", " 1.5 ", "1,234.5", "1.5d", "1_000", "-2e3", ".5", "7.", None, "inf", "NaN"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(n.tolerant_double("t")).collect()]
    assert got == [None, None, 1.5, None, None, None, -2000.0, 0.5, 7.0, None, None, None]


def test_strict_double_fails_on_text(spark):
    ok = spark.createDataFrame([("12.5",), (None,)], "a string")
    assert [r[0] for r in ok.select(n.strict_double("a")).collect()] == [12.5, None]
    bad = spark.createDataFrame([("12.5",), ("twelve",)], "a string")
    with pytest.raises(Exception, match="not a number"):
        bad.select(n.strict_double("a")).collect()


def test_round_sum2_is_exact_half_up(spark):
    df = spark.createDataFrame([(1.005,), (0.0,)], "x double")
    # DOUBLE 1.005 is 1.00499999...; as DECIMAL(26,9) it is 1.005000000 -> 1.01
    assert df.agg(n.round_sum2("x")).first()[0] == 1.01


def test_credit_sum_edge_cases(spark):
    schema = "credits array<struct<type:string,amount:double>>"
    rows = [
        (None,),
        ([],),
        ([("OTHER_UNLISTED", -1.0)],),
        ([("PROMOTION", -1.25), ("PROMOTION", -0.25), ("COMMITTED_USAGE_DISCOUNT", -2.0)],),
        ([("FREE_TIER", None), ("DISCOUNT", -0.5)],),
    ]
    df = spark.createDataFrame(rows, schema)
    got = df.select(cr.cud_credits("credits").alias("c"), cr.other_savings("credits").alias("o")).collect()
    assert [(r.c, r.o) for r in got] == [
        (Decimal("0E-9"), Decimal("0E-9")),
        (Decimal("0E-9"), Decimal("0E-9")),
        (Decimal("0E-9"), Decimal("0E-9")),
        (Decimal("-2.000000000"), Decimal("-1.500000000")),
        (Decimal("0E-9"), Decimal("-0.500000000")),
    ]


def test_dimension_key_matches_python_text(spark):
    df = spark.createDataFrame([("2025-08-01", "m", None)], "d string, a string, b string")
    got = df.select(k.dimension_key("d", ["a", "b"])).first()[0]
    assert got == hashlib.sha256("2025-08-01|m|None".encode()).hexdigest()


def test_first_present_skips_blank(spark):
    df = spark.createDataFrame([("", None, "x", "y")], "a string, b string, c string, d string")
    assert df.select(k.first_present(["a", "b", "c", "d"])).first()[0] == "x"


def test_month_bounds_and_year_roll():
    assert d.month_bounds(dt.date(1998, 1, 10), -1) == (dt.date(1997, 12, 1), dt.date(1998, 1, 1))
    assert d.month_bounds(dt.date(1998, 12, 31)) == (dt.date(1998, 12, 1), dt.date(1999, 1, 1))
    assert d.billing_period_label(dt.date(2024, 12, 3)) == "20241201-20250101"
    assert d.period_labels_to_check(dt.date(2024, 1, 7)) == ["20240101-20240201", "20231201-20240101"]
    assert d.period_labels_to_check(dt.date(2024, 1, 8)) == ["20240101-20240201"]


def test_london_bounds_dst():
    # Summer: London midnight is 23:00 UTC the day before; winter: 00:00 UTC.
    assert d.local_midnight_utc(dt.date(1998, 8, 1)) == dt.datetime(1998, 7, 31, 23, 0)
    assert d.local_midnight_utc(dt.date(1998, 11, 1)) == dt.datetime(1998, 11, 1, 0, 0)


@pytest.mark.parametrize("ts,inside", [
    ("1998-07-31 22:59:59", False),
    ("1998-07-31 23:00:00", True),
    ("1998-08-31 22:59:59", True),
    ("1998-08-31 23:00:00", False),
])
def test_instant_in_month_edges(spark, ts, inside):
    df = spark.createDataFrame([(ts,)], "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))
    pred = d.instant_in_month("ts", df.schema["ts"].dataType, dt.date(1998, 8, 19))
    assert df.filter(pred).count() == (1 if inside else 0)
    ltz = df.select(F.to_utc_timestamp(F.col("ts").cast("timestamp"), "UTC").alias("ts"))
    pred2 = d.instant_in_month("ts", ltz.schema["ts"].dataType, dt.date(1998, 8, 19))
    assert ltz.filter(pred2).count() == (1 if inside else 0)


def test_periods_to_check_column(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 8),)], "d date")
    got = [r[0] for r in df.select(d.periods_to_check("d")).collect()]
    assert got == [["20240101-20240201", "20231201-20240101"], ["20240101-20240201"]]


def test_lookback_excludes_today(spark):
    days = [dt.date(2024, 1, 16), dt.date(2024, 1, 17), dt.date(2024, 1, 18), dt.date(2024, 1, 19)]
    df = spark.createDataFrame([(x,) for x in days], "d date")
    got = sorted(r[0] for r in df.filter(d.lookback("d", dt.date(2024, 1, 19), 2)).collect())
    assert got == [dt.date(2024, 1, 17), dt.date(2024, 1, 18)]


def test_tolerant_double_matches_python_float(spark):
    import re

    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    alphabet = st.sampled_from(list("0123456789+-.eE ,_dxn"))

    @settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(st.lists(st.text(alphabet, min_size=0, max_size=8), min_size=50, max_size=50))
    def check(texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        got = {r.i: r.v for r in df.select("i", n.tolerant_double("t").alias("v")).collect()}
        for i, t in enumerate(texts):
            s = t.strip()
            want = float(s) if re.fullmatch(n.NUMERIC_TEXT, s) else None
            assert got[i] == want, (t, got[i], want)

    check()


def test_today_is_the_zones_own(monkeypatch):
    """CURRENT_DATE(tz) at a fixed instant: the hour before midnight UTC is already tomorrow in a summer London."""
    import datetime as real

    from costframe.functions import dates

    class Clock(real.datetime):
        @classmethod
        def now(cls, tz=None):
            return real.datetime(2024, 7, 1, 23, 30, tzinfo=real.timezone.utc).astimezone(tz)

    monkeypatch.setattr(dates.dt, "datetime", Clock)
    assert dates.today_in("UTC") == real.date(2024, 7, 1)
    assert dates.today_in("Europe/London") == real.date(2024, 7, 2)
    assert dates.today_in("America/New_York") == real.date(2024, 7, 1)
