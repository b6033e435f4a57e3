import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.scd2 import (
    current_versions,
    last_snapshot,
    point_in_time,
    read_dimension,
    scd2_advance,
    scd2_apply,
    scd2_changes,
    scd2_stage,
    store_dimension,
)

T1, T2, T3 = (datetime(2024, m, 1, tzinfo=timezone.utc) for m in (1, 2, 3))
MAPPING = {"StationKey": "geohash", "StationName": "name"}
SCHEMA = T.StructType(
    [
        T.StructField("StationKey", T.StringType()),
        T.StructField("StationName", T.StringType()),
        T.StructField("EffStartDate", T.TimestampType()),
        T.StructField("EffEndDate", T.TimestampType()),
        T.StructField("IsCurrent", T.BooleanType()),
        T.StructField("RowHash", T.StringType()),
        T.StructField("SourceSystem", T.StringType()),
    ]
)


def silver(spark, *rows):
    """(geohash, name, hash, day of recording)"""
    df = spark.createDataFrame(rows, "geohash string, name string, _row_hash string, d int")
    return df.withColumn("_processed_at", F.timestamp_seconds(F.col("d") * 86400)).drop("d")


def stage(spark, at, *rows):
    return scd2_stage(silver(spark, *rows), MAPPING, "feed", at)


def seen(dimension):
    month = lambda c: F.month(c)
    rows = dimension.select(
        "StationKey", "RowHash", month("EffStartDate"), month("EffEndDate"), "IsCurrent"
    ).collect()
    return sorted(map(tuple, rows), key=str)


def test_only_the_newest_version_is_staged(spark):
    rows = [("a", "x", "h1", 1), ("a", "y", "h2", 5), ("a", "y", "h2", 5), ("b", "z", "h3", 2), (None, "n", "h", 1)]
    staged = stage(spark, T1, *rows)
    assert seen(staged) == sorted(
        [("a", "h2", 1, None, True), ("b", "h3", 1, None, True), (None, "h", 1, None, True)], key=str
    )
    assert staged.schema.fieldNames() == SCHEMA.fieldNames()


def test_changes_are_new_keys_and_other_hashes(spark):
    dim = stage(spark, T1, ("a", "x", "h1", 1), ("b", "x", None, 1), ("c", "x", None, 1), ("d", "x", "h", 1), (None, "x", "h", 1))
    upd = stage(spark, T2, ("a", "x", "h1", 2), ("b", "x", None, 2), ("c", "x", "h", 2), ("d", "x", None, 2), ("e", "x", None, 2), (None, "x", "h", 2))
    assert sorted(r.StationKey for r in scd2_changes(dim, upd).collect()) == ["c", "d", "e"]


def test_apply_closes_adds_and_keeps(spark):
    dim = stage(spark, T1, ("a", "x", "h1", 1), ("b", "x", "h1", 1), ("gone", "x", "h1", 1))
    upd = stage(spark, T2, ("a", "y", "h2", 2), ("b", "x", "h1", 2), ("n", "x", "h9", 2))
    once = scd2_apply(dim, upd, T2)
    assert seen(once) == [
        ("a", "h1", 1, 2, False),
        ("a", "h2", 2, None, True),
        ("b", "h1", 1, None, True),
        ("gone", "h1", 1, None, True),
        ("n", "h9", 2, None, True),
    ]
    # no gap between the versions
    ends = once.filter("not IsCurrent").select("EffEndDate").collect()
    assert ends == once.filter("RowHash = 'h2'").select("EffStartDate").collect()
    assert seen(scd2_apply(once, upd, T3)) == seen(once)
    back = stage(spark, T3, ("a", "x", "h1", 3))
    assert [s for s in seen(scd2_apply(once, back, T3)) if s[0] == "a"] == [
        ("a", "h1", 1, 2, False),
        ("a", "h1", 3, None, True),
        ("a", "h2", 2, 3, False),
    ]
    assert seen(scd2_advance(once, upd, T3)) == seen(current_versions(once))


def test_missing_keys_are_closed_only_on_request(spark):
    dim = stage(spark, T1, ("a", "x", "h1", 1), ("gone", "x", "h1", 1))
    upd = stage(spark, T2, ("a", "x", "h1", 2))
    assert seen(scd2_apply(dim, upd, T2)) == seen(dim)
    closed = scd2_apply(dim, upd, T2, close_missing=True)
    assert seen(closed) == [("a", "h1", 1, None, True), ("gone", "h1", 1, 2, False)]


def test_other_columns_are_refused(spark):
    dim = stage(spark, T1, ("a", "x", "h1", 1))
    with pytest.raises(ValueError):
        scd2_advance(dim, dim.drop("StationName"), T2)


def test_stored_dimension(spark, folder):
    path = f"{folder}/dim"
    first = stage(spark, T1, ("a", "x", "h1", 1), ("b", "x", "h1", 1))
    assert last_snapshot(spark, path) is None
    with pytest.raises(FileNotFoundError):
        read_dimension(spark, path, SCHEMA)
    assert store_dimension(spark, path, first, T1, schema=SCHEMA)
    assert not store_dimension(spark, path, first, T2, schema=SCHEMA)
    assert last_snapshot(spark, path) == 1

    second = stage(spark, T2, ("a", "y", "h2", 2), ("c", "x", "h1", 2))
    # a run that failed half way leaves rows but no mark of success
    second.write.partitionBy("IsCurrent").parquet(f"{path}/snapshot=2")
    os.remove(f"{path}/snapshot=2/_SUCCESS")
    assert seen(read_dimension(spark, path, SCHEMA)) == seen(first)
    assert store_dimension(spark, path, second, T2, schema=SCHEMA)
    expected = seen(scd2_apply(first, second, T2))
    assert seen(read_dimension(spark, path, SCHEMA)) == expected

    third = stage(spark, T3, ("a", "x", "h1", 3))
    assert store_dimension(spark, path, third, T3, schema=SCHEMA)
    assert seen(read_dimension(spark, path, SCHEMA)) == seen(
        scd2_apply(scd2_apply(first, second, T2), third, T3)
    )
    # earlier states stay readable, and history is not written again
    assert seen(read_dimension(spark, path, SCHEMA, snapshot=2)) == expected
    closed = spark.read.parquet(f"{path}/snapshot=3/IsCurrent=false")
    assert closed.count() == 1
    assert store_dimension(spark, path, third, T3, schema=SCHEMA, close_missing=True)
    assert current_versions(read_dimension(spark, path, SCHEMA)).count() == 1
    assert read_dimension(spark, path, SCHEMA).schema.fieldNames() == SCHEMA.fieldNames()


def test_an_error_while_updating_loses_no_history(spark, folder):
    path = f"{folder}/dim"
    first = stage(spark, T1, ("a", "x", "h1", 1))
    store_dimension(spark, path, first, T1, schema=SCHEMA)
    broken = stage(spark, T2, ("a", "x", "h2", 2)).withColumn(
        "StationName", F.raise_error("no").cast("string")
    )
    with pytest.raises(Exception):
        store_dimension(spark, path, broken, T2, schema=SCHEMA)
    assert seen(read_dimension(spark, path, SCHEMA)) == seen(first)


def brute_force(events, versions, first_open=True):
    first = {}
    for key, start, _end, _name in versions:
        first[key] = min(first.get(key, start), start)
    out = []
    for i, key, at in events:
        for vkey, start, end, name in versions:
            begins = (first_open and start == first[vkey]) or at >= start
            if key == vkey and begins and (end is None or at < end):
                out.append((i, name))
    return sorted(out)


@pytest.mark.parametrize("few, busy", [(32, 1000), (5, 1000), (2, 7), (0, 40)])
@pytest.mark.parametrize("first_open", [True, False])
def test_point_in_time_against_brute_force(spark, few, busy, first_open):
    rng = random.Random(7)
    day0 = datetime(2020, 1, 1, tzinfo=timezone.utc)
    day = lambda n: day0 + timedelta(days=n)
    versions, events = [], []
    for k in range(6):
        cuts = sorted(rng.sample(range(900), 1 if k == 0 else rng.randint(2, 25)))
        ends = cuts[1:] + [None if k % 2 else 950]
        versions += [(f"k{k}", day(a), None if b is None else day(b), f"k{k}@{a}") for a, b in zip(cuts, ends)]
        events += [(len(events) + i, f"k{k}", day(c + d)) for i, (c, d) in enumerate((c, d) for c in cuts for d in (-1, 0, 1))]
    events += [(10_000 + i, f"k{rng.randint(0, 8)}", day(rng.randint(-50, 1100))) for i in range(300)]
    events.append((99_999, None, day(10)))
    dim = spark.createDataFrame(versions, "StationKey string, EffStartDate timestamp, EffEndDate timestamp, name string")
    rows = spark.createDataFrame(events, "id int, StationKey string, at timestamp")
    joined = point_in_time(rows, dim, "at", few_versions=few, first_open=first_open, task_events=busy)
    assert joined.columns == ["id", "StationKey", "at", "EffStartDate", "EffEndDate", "name"]
    got = sorted((r.id, r.name) for r in joined.collect())
    assert got == brute_force(events, versions, first_open)
    kept = point_in_time(rows, dim, "at", few_versions=few, first_open=first_open, keep_unmatched=True, task_events=busy)
    assert kept.select("id").distinct().count() == kept.count() == len(events)
    none = point_in_time(rows.limit(0), dim, "at", few_versions=few)
    assert none.count() == 0


def test_a_late_first_load_still_covers_older_events(spark):
    dim = stage(spark, T2, ("a", "x", "h1", 1))
    event = spark.createDataFrame([("a", T1)], "StationKey string, at timestamp")
    assert point_in_time(event, dim, "at").count() == 1
    assert point_in_time(event, dim, "at", first_open=False).count() == 0


def test_point_in_time_shuffles_events_once(spark, folder):
    span = spark.range(4000)
    dim = span.select(
        (F.col("id") % 4).cast("string").alias("StationKey"),
        F.timestamp_seconds(F.col("id") * 100).alias("EffStartDate"),
        F.timestamp_seconds(F.col("id") * 100 + 400).alias("EffEndDate"),
        F.col("id").alias("version"),
    )
    # one key holds a third of the events, copies of one event another third
    key = F.when(F.col("id") % 3 == 0, "1").otherwise(F.when(F.col("id") % 3 == 1, "2").otherwise((F.col("id") % 4).cast("string")))
    at = F.timestamp_seconds(F.when(F.col("id") % 3 == 1, 777).otherwise((F.col("id") * 31) % 400_000))
    spark.range(30_000).select(key.alias("StationKey"), at.alias("at"), (F.col("id") % 3).alias("kind")).write.parquet(f"{folder}/events")
    events = spark.read.parquet(f"{folder}/events")
    found = point_in_time(events, dim, "at", task_events=500)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(_pk") == 1 and "Window" in plan
    on = (F.col("e.StationKey") == F.col("d.StationKey")) & (F.col("at") >= F.col("EffStartDate")) & (F.col("at") < F.col("EffEndDate"))
    plain = events.alias("e").join(dim.alias("d"), on).select("e.StationKey", "at", "kind", "version")
    first = events.join(dim.groupBy("StationKey").agg(F.min("EffStartDate").alias("f"), F.min("version").alias("version")), "StationKey")
    plain = plain.unionByName(first.filter("at < f").select("StationKey", "at", "kind", "version"))
    assert found.select("StationKey", "at", "kind", "version").exceptAll(plain).isEmpty() and found.count() == plain.count()


def test_versions_that_end_at_once_are_passed_over(spark):
    dim = spark.createDataFrame([("a", T1, T2, "x"), ("a", T2, T2, "gone"), ("a", T2, T3, "y"), ("a", T3, T3, "end")],
                                "StationKey string, EffStartDate timestamp, EffEndDate timestamp, name string")
    event = spark.createDataFrame([("a", T1), ("a", T2), ("a", T3)], "StationKey string, at timestamp")
    rows = {(r.at, r.name) for r in point_in_time(event, dim, "at", few_versions=0, keep_unmatched=True).collect()}
    assert {name for _, name in rows} == {"x", "y", None}
