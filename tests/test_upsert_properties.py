"""Property test: the Spark upsert equals a plain model of MERGE
(update matched keys with the latest load, insert the rest, delete nothing)."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from costframe.operators.tables import collapse_loads, merge

KEYS = ["usage_date", "record_id"]
SCHEMA = "usage_date date, record_id string, total_price double"
DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]
key = st.tuples(st.sampled_from(DAYS), st.sampled_from(list("abcdef")))
price = st.one_of(st.none(), st.integers(0, 99).map(float))


def model(target: dict, loads: list[dict]) -> dict:
    out = dict(target)
    for load in loads:          # merged one after another: the later load wins
        out.update(load)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=st.dictionaries(key, price, max_size=8),
       loads=st.lists(st.dictionaries(key, price, max_size=6), min_size=1, max_size=3))
def test_upsert_matches_model(spark, target, loads):
    t = spark.createDataFrame([(d, k, p) for (d, k), p in target.items()], SCHEMA)
    rows = [(d, k, p, i) for i, load in enumerate(loads) for (d, k), p in load.items()]
    src = spark.createDataFrame(rows, SCHEMA + ", load_ordinal int")
    got = {(r.usage_date, r.record_id): r.total_price
           for r in merge(t, collapse_loads(src, KEYS, "load_ordinal"), KEYS).collect()}
    assert got == model(target, loads)
