"""Report parts follow the rows of a period."""

from __future__ import annotations

import json
import re

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from costframe import fixtures as fx
from costframe.landing import land_cur
from costframe.sources import files
from costframe.sources.cur import cur_scan, manifest_path


@pytest.mark.parametrize("same_id", [False, True])
def test_parts_follow_the_rows_of_a_period(spark, workdir, same_id):
    """No part holds more than a small multiple of the part size, however many rows a period has or share an id."""
    raw = fx.cur_raw(spark, SF_SMALL).where(F.col("`lineItem/UsageStartDate`").startswith("1998")).limit(1000).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(3))))
    raw = raw.withColumn("lineItem/LineItemDescription", F.concat("lineItem/LineItemDescription", F.lit(" "), "n")).drop("n").localCheckpoint()
    if same_id:
        raw = raw.withColumn("identity/LineItemId", F.lit("one"))
    periods = land_cur(spark, raw, workdir, "costs", part_rows=20)
    assert len(periods) == 12
    for p in periods:
        with open(re.sub("^file:", "", manifest_path(workdir, "costs", p))) as f:
            assert len(json.load(f)["reportKeys"]) >= 5
    got = cur_scan(spark, workdir, "costs")
    sizes = [r["count"] for r in got.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == raw.count() > 1000 and max(sizes) <= 80
    rows = lambda df: sorted(tuple(v or "" for v in r) for r in df.select(*[f"`{c}`" for c in raw.columns]).collect())
    assert rows(got) == rows(raw)


def test_an_empty_report_lands_nothing(spark, workdir):
    assert land_cur(spark, fx.cur_raw(spark, SF_SMALL).limit(0), workdir, "costs") == []
    assert files.glob(spark, manifest_path(workdir, "costs", "*")) == []
