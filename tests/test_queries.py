"""Every registered query against DuckDB, and what its plan may not contain."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from compare import database, differences

import __spark_entry__ as entry_point
from tidemark.operators.calendar import calendar_covering
from tidemark.plans import domain
from tidemark.plans import registry
from tidemark.plans.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"
ROOT = Path(entry_point.__file__).resolve().parent
QUERIES = registry.queries()


@pytest.fixture(scope="module")
def duck():
    return database(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert ORACLE.keys() <= entry_point.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    assert differences(df, duck, ORACLE[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert slow not in plan


def test_entry(spark):
    board = entry_point.entry(spark)
    assert board.columns == ["Season", "StationKey", "StationName", "AverageValue", "PeakValue", "Rank", "PeakRank"]
    assert board.count() > 0


def test_leaderboard_plan(spark):
    calendar = calendar_covering(domain.table(spark, SF_DIR, "lineitem"), "l_shipdate")
    winds = domain.fact(spark, SF_DIR, "Wind Speed", "Wind Gust").join(calendar, "DateKey")
    plan = winds.groupBy("Season").agg({"ValueNumeric": "max"})._jdf.queryExecution().executedPlan().toString()
    # the fact meets the calendar by broadcast, only the measured columns are read, and
    # map-side partial aggregates are what is shuffled
    assert "BroadcastHashJoin" in plan and "partial_max" in plan
    assert "l_quantity:double,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_only_new_in_other_zones(zone):
    """Stored rows stay stored whatever zone the driver's host is in."""
    code = """
from pyspark.sql import functions as F
from tidemark.operators.incremental import only_new
from tidemark.session import start_session
spark = start_session("zone", master="local[1]", settings={"spark.ui.enabled": "false"})
rows = spark.createDataFrame([(1, "2024-03-10 00:30:00"), (2, "2024-11-03 01:30:00"), (3, None)], "k int, t string")
for kind in ("timestamp_ntz", "timestamp", "date", "string"):
    x = rows.select("k", F.col("t").cast(kind).alias("t"))
    print(kind, only_new(x, x, ["k", "t"], prune_on="t").count())
"""
    env = {**os.environ, "TZ": zone, "PYTHONPATH": str(ROOT)}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, check=True).stdout
    assert [line.split()[1] for line in out.split("\n") if line] == ["0"] * 4
