"""Incremental load: a file stream with availableNow + foreachBatch upsert."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from costframe.operators.usage import USAGE_KEYS, flatten_usage
from costframe.session import as_local_path
from costframe.sources.buckets import USAGE_RESULT, page_schema
from costframe.streaming.incremental import stream_upsert


def _page(day: str, tokens: int) -> dict:
    return {"data": [{"starting_at": f"{day}T00:00:00Z", "ending_at": f"{day}T23:59:59Z",
                      "results": [{"model": "m", "uncached_input_tokens": tokens}]}],
            "has_more": False, "next_page": None}


def _land(root: str, name: str, page: dict) -> None:
    path = as_local_path(f"{root}/{name}")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(json.dumps(page))


def _transform(pages):
    return flatten_usage(pages.select(F.explode("data").alias("b")).select("b.*"))


def test_stream_upsert_processes_new_pages_once(spark, workdir):
    landing, target, ckpt = f"{workdir}/landing", f"{workdir}/usage", f"{workdir}/ckpt"
    args = (page_schema(USAGE_RESULT), _transform, target, list(USAGE_KEYS), ckpt)
    _land(landing, "p1.json", _page("2025-08-01", 10))
    _land(landing, "p2.json", _page("2025-08-02", 20))
    stream_upsert(spark, landing, *args)
    got = {str(r.usage_date): r.uncached_input_tokens for r in spark.read.parquet(target).collect()}
    assert got == {"2025-08-01": 10, "2025-08-02": 20}

    # nothing new: the checkpoint remembers the files, the table stays
    stream_upsert(spark, landing, *args)
    assert spark.read.parquet(target).count() == 2

    # a re-pull restates day 2 and adds day 3: only the new page is read
    _land(landing, "p3.json", {"data": _page("2025-08-02", 25)["data"] + _page("2025-08-03", 30)["data"]})
    stream_upsert(spark, landing, *args)
    got = {str(r.usage_date): r.uncached_input_tokens for r in spark.read.parquet(target).collect()}
    assert got == {"2025-08-01": 10, "2025-08-02": 25, "2025-08-03": 30}
