from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tocsin.functions.rules import execution_time, with_schedule
from tocsin.schema import FIXED_DELAY

NOW = 1_000_000


@pytest.fixture(scope="module")
def requests(spark):
    times = [None, 999_999, 1_000_000, 1_000_001, 9_000_000]
    return spark.createDataFrame(
        [(str(t), t, NOW) for t in times], "id string, scheduled_at bigint, arrival_ms bigint"
    )


def test_effective_time(requests):
    got = {row.id: (row.exec_ms, row.schedule_source) for row in with_schedule(requests).collect()}
    assert got == {
        "None": (1_030_000, "fallback"),
        "999999": (1_030_000, "fallback"),
        "1000000": (1_030_000, "fallback"),
        "1000001": (1_000_001, "provided"),
        "9000000": (9_000_000, "provided"),
    }


def test_fixed_delay(requests):
    got = {row.exec_ms for row in with_schedule(requests, FIXED_DELAY).collect()}
    assert got == {1_300_000}


def test_unknown_policy():
    with pytest.raises(ValueError, match="sometimes"):
        execution_time("sometimes", F.lit(1), F.lit(2))
