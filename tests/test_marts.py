import pytest
from pyspark.sql import functions as F

from tidemark.operators import marts
from tidemark.operators.calendar import generate_dim_date
from tidemark.operators.ranking import rank_desc

FACT = (
    "StationKey string, DateKey int, ObservationTime string, MetricName string, "
    "ValueNumeric double, ValueString string"
)


@pytest.fixture(scope="module")
def fact(spark):
    rows = [
        ("a", 20240115, "12:00:00", "Wind Speed", 3.0, None),
        ("a", 20240116, "12:00:00", "Wind Speed", 6.0, None),
        ("a", 20240115, "12:00:00", "Wind Gust", 9.0, None),
        ("a", 20240115, "12:00:00", "Wind Direction", None, "SW"),
        ("a", 20240116, "12:00:00", "Wind Direction", None, None),
        ("b", 20240115, "12:00:00", "Wind Speed", 4.5, None),
        ("b", 20240715, "12:00:00", "Wind Speed", 1.0, None),
        ("c", 20240115, "12:00:00", "Wind Gust", 99.0, None),
        ("x", 20240115, "12:00:00", "Wind Speed", 50.0, None),
        (None, 20300101, "12:00:00", "Wind Speed", 1.0, None),
    ]
    return spark.createDataFrame(rows, FACT)


@pytest.fixture(scope="module")
def stations(spark):
    rows = [("a", "A", True), ("b", "B", True), ("b", "B old", False), ("c", "C", True), ("x", "X", False)]
    return spark.createDataFrame(rows, "StationKey string, StationName string, IsCurrent boolean")


@pytest.fixture(scope="module")
def calendar(spark):
    return generate_dim_date(spark, "2024-01-01", "2024-12-31")


def test_breakdown(fact):
    rows = {r.MetricName: tuple(r)[1:] for r in marts.metric_breakdown(fact).collect()}
    assert rows == {"Wind Speed": (6, 6, 0), "Wind Gust": (2, 2, 0), "Wind Direction": (2, 0, 1)}


def test_pivot(fact):
    wide = marts.eav_pivot(
        fact, {"Wind Speed": "speed", "Wind Direction": "direction"}, {"Wind Direction"}
    )
    rows = {(r.StationKey, r.DateKey): (r.speed, r.direction) for r in wide.collect()}
    assert rows == {
        ("a", 20240115): (3.0, "SW"),
        ("a", 20240116): (6.0, None),
        ("b", 20240115): (4.5, None),
        ("b", 20240715): (1.0, None),
        ("x", 20240115): (50.0, None),
        (None, 20300101): (1.0, None),
    }


@pytest.mark.parametrize("task_rows", [1_000_000, 1])
def test_leaderboard_ranks_current_stations_per_season(fact, stations, calendar, task_rows):
    board = marts.season_leaderboard(fact, stations, calendar, task_rows=task_rows)
    columns = ("Season", "Rank", "StationName", "AverageValue", "PeakValue")
    rows = sorted(map(tuple, board.select(*columns).collect()), key=str)
    assert rows == sorted(
        [
            ("Summer", 1, "B", 1.0, None),
            ("Winter", 1, "A", 4.5, 9.0),
            ("Winter", 1, "B", 4.5, None),
            ("Winter", 3, "C", None, 99.0),
        ],
        key=str,
    )


def test_orphans(fact, stations, calendar):
    current = stations.filter("IsCurrent")
    rows = sorted(map(tuple, marts.fact_orphans(fact, current, calendar).collect()), key=str)
    assert rows == sorted(
        [("StationKey", "x", 1), ("StationKey", None, 1), ("DateKey", "20300101", 1)], key=str
    )


def test_duplicate_current_keys(stations):
    assert marts.duplicate_current(stations).isEmpty()
    all_current = stations.withColumn("IsCurrent", F.lit(True))
    assert [tuple(r) for r in marts.duplicate_current(all_current).collect()] == [("b", 2)]


@pytest.mark.parametrize("task_rows", [50, 7])
def test_sliced_ranks_equal_window_ranks(spark, task_rows):
    value = F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 3 == 0, 5.0).otherwise(
        F.round(F.pow(F.rand(3), 6) * 1000, 1)
    )
    group = F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 2).cast("string"))
    made = spark.range(600).select("id", group.alias("g"), value.alias("v")).collect()
    rows = spark.createDataFrame([tuple(r) for r in made], "id int, g string, v double")
    plain = rank_desc(rows, "g", "v", at_most=600)
    sliced = rank_desc(rows, "g", "v", at_most=600, task_rows=task_rows)
    assert sliced.columns == plain.columns
    assert sliced.schema["Rank"].dataType == plain.schema["Rank"].dataType
    assert sorted(sliced.collect(), key=str) == sorted(plain.collect(), key=str)


@pytest.mark.parametrize("shares", [1, 4])
def test_season_parts_fold_to_the_same_ranks(spark, fact, stations, calendar, shares):
    odd = [
        ("b", 20240120, "12:00:00", "Wind Speed", float("nan"), None),
        ("c", 20240120, "12:00:00", "Wind Speed", 1e300, None),
        ("a", 20240716, "12:00:00", "Wind Speed", 0.1, None),
        ("a", 20240717, "12:00:00", "Wind Speed", 0.2, None),
    ]
    rows = fact.unionByName(spark.createDataFrame(odd, FACT))
    whole = marts.season_leaderboard(rows, stations, calendar)
    share = F.pmod(F.xxhash64(*rows.columns), F.lit(shares))
    parts = [marts.season_parts(rows.filter(share == n), calendar) for n in range(shares)]
    folded = parts[0]
    for part in parts[1:]:
        folded = folded.unionByName(part)
    found = marts.season_leaderboard_of(folded.repartition(3), stations)
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))
    by_station = {(r.Season, r.StationKey): r.AverageValue for r in found.collect()}
    assert by_station["Winter", "a"] == 4.5 and by_station["Summer", "a"] == 0.15
    assert str(by_station["Winter", "b"]) == "nan" and by_station["Winter", "c"] == 1e300


def test_pivot_of_numbers_or_texts_alone(fact):
    numbers = marts.eav_pivot(fact, {"Wind Gust": "gust"})
    assert {(r.StationKey, r.gust) for r in numbers.collect()} == {("a", 9.0), ("c", 99.0)}
    texts = marts.eav_pivot(fact, {"Wind Direction": "direction"}, {"Wind Direction"}, ["StationKey"])
    assert [tuple(r) for r in texts.collect()] == [("a", "SW")]


def test_pivot_sorts_texts_only(fact):
    wide = marts.eav_pivot(fact, {"Wind Speed": "speed", "Wind Direction": "direction"}, {"Wind Direction"})
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    of_texts = [line for line in plan.split("\n") if "SortAggregate" in line]
    assert of_texts and all("ValueString" in line and "ValueNumeric" not in line for line in of_texts)
