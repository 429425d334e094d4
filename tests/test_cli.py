"""The job entry point, run in-process on the test session."""

from __future__ import annotations

import json

from conftest import SF_SMALL

from costframe import fixtures as fx
from costframe.__main__ import main
from costframe.landing import land_cur


def test_cli_load_and_report(spark, workdir, capsys):
    bucket, table = f"{workdir}/bucket", f"{workdir}/cur"
    land_cur(spark, fx.cur_raw(spark, SF_SMALL), bucket, "costs")
    assert main(["load-cur", "--root", bucket, "--report", "costs", "--table", table,
                 "--as-of", "1998-08-05"]) == 0
    loaded = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert loaded["staged_rows"] > 0 and set(loaded["periods"]) == {"19980801-19980901", "19980701-19980801"}
    assert main(["report", "aws-services", "--table", table, "--as-of", "1998-08-19"]) == 0
    rows = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert 0 < len(rows) <= 10 and set(rows[0]) == {"Service Description", "Cost"}
    costs = [r["Cost"] for r in rows]
    assert costs == sorted(costs, reverse=True)
