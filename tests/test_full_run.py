import glob
import os
import re
from datetime import datetime, timezone

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import month_text
from tidemark.operators.incremental import in_parts_of, only_new
from tidemark.operators.scd2 import read_dimension
from tidemark.plans import full_run
from tidemark.plans.full_run import Lake, Run, run_layers
from tidemark.session import PARQUET_CODEC
from tidemark.sources.files import table_exists
from tidemark.sources.landed import batch_id, to_envelopes, write_landed
from tidemark.sources.tables import Target, append_load, has_months, read_months, read_table
from tidemark.streaming import read_batches

DAYS = [datetime(2024, 1, d, 6, tzinfo=timezone.utc) for d in (1, 2, 3, 4)]


def stations(spark, **areas):
    rows = [
        (f"Station {k}", 50.0, -1.0, "se", "GB", "Automatic", k, area, "England", "Europe/London")
        for k, area in areas.items()
    ]
    return spark.createDataFrame(rows, schemas.LANDED_STATION)


def readings(spark, *rows):
    schema = "station_geohash string, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in schemas.READING.fields
    )
    full = [(k, t, 1000, temp, 1000.0, 9.0, "SW", 3.0, 80.0, 3, "falling") for k, t, temp in rows]
    return spark.createDataFrame(full, schema)


def state(spark, lake):
    fact = read_batches(spark, lake.gold_fact, schemas.FACT, lake.fmt)
    temps = fact.filter("MetricName = 'Temperature'").select("StationKey", "DateKey", "ObservationTime", "ValueNumeric")
    dim = read_dimension(spark, lake.gold_dim_station, fmt=lake.fmt)
    return (
        sorted(map(tuple, temps.collect())),
        sorted(map(tuple, dim.select("StationKey", "County", "IsCurrent").collect())),
        fact.count(),
    )


@pytest.mark.parametrize("multi_line, fmt", [(False, "parquet"), (True, "parquet"), (False, "orc")])
def test_days_in_a_row(spark, folder, multi_line, fmt):
    lake, copy = Lake(f"{folder}/lake", fmt), Target(f"{folder}/copy")

    def day(n, feed, obs, run_id=None, mode="all"):
        run_layers(
            spark, lake, Run(run_id or f"run-{n}", DAYS[n], "feed", multi_line), mode,
            stations=feed, readings=obs, calendar=("2024-01-01", "2024-12-31"), copies={"fact": [copy], "dim_station": [Target(f"{folder}/dim")]},
        )

    feed = stations(spark, a="Kent", b="Devon")
    obs = [("a", "2024-01-01T00:00:00Z", 1.0), ("b", "2024-01-01T00:00:00Z", 2.0), ("zz", "2024-01-01T00:00:00Z", 9.0)]
    day(0, feed, readings(spark, *obs))
    first = state(spark, lake)
    # the reading of the unknown station is not fetched
    assert first == (
        [("a", 20240101, "00:00:00", 1.0), ("b", 20240101, "00:00:00", 2.0)],
        [("a", "Kent", True), ("b", "Devon", True)],
        16,
    )
    # the same day once more, also as a repetition of the same run
    day(0, feed, readings(spark, *obs))
    day(0, feed, readings(spark, *obs), run_id="run-0b")
    assert state(spark, lake) == first
    # next day: a reading comes again, one is new, one station changed, one is new
    day(1, stations(spark, a="Essex", b="Devon", c="Fife"),
        readings(spark, obs[0], ("a", "2024-01-02T12:30:00Z", 3.0), ("a", "2024-01-02T12:30:00Z", 3.0)))
    second = state(spark, lake)
    assert second == (
        sorted(first[0] + [("a", 20240102, "12:30:00", 3.0)]),
        [("a", "Essex", True), ("a", "Kent", False), ("b", "Devon", True), ("c", "Fife", True)],
        24,
    )
    # only the station feed: facts stay as they are
    day(2, stations(spark, a="Essex", b="Cornwall"), None, mode="metadata_only")
    assert state(spark, lake) == second
    day(2, None, None, mode="dim_stations")
    assert ("b", "Devon", False) in state(spark, lake)[1]
    assert read_batches(spark, copy.path, schemas.FACT).count() == 24
    assert read_table(spark, f"{folder}/dim").count() == read_dimension(spark, lake.gold_dim_station, fmt=fmt).count()
    for table in ("bronze_observations", "silver_stations", "gold_dim_date", "gold_dim_station", "gold_fact"):
        walked = os.walk(getattr(lake, table))
        stored = [n for at, _, names in walked if "_taken_files" not in at for n in names if n.startswith("part-")]
        assert stored and all(n.endswith(fmt) for n in stored)
    names = read_dimension(spark, lake.gold_dim_station, fmt=fmt).select("StationName").distinct()
    assert {r[0] for r in names.collect()} == {"Station a", "Station b", "Station c"}


def test_a_mode_runs_its_part_only(spark, folder):
    lake = Lake(folder)
    ran = run_layers(
        spark, lake, Run("r", DAYS[0], "feed"), "dim_date", calendar=("2024-01-01", "2024-01-31")
    )
    assert ran == ["dim_date"]
    assert read_table(spark, lake.gold_dim_date).count() == 31
    for table in ("bronze_stations", "silver_stations", "gold_fact", "gold_dim_station"):
        assert not table_exists(spark, getattr(lake, table))
    with pytest.raises(FileNotFoundError):
        run_layers(spark, lake, Run("r", DAYS[0], "feed"), "no such mode")


JOBS = [
    "land_stations", "bronze_stations", "silver_stations", "land_observations",
    "bronze_observations", "silver_observations", "dim_date", "dim_station", "fact",
]


@pytest.mark.parametrize(
    "mode, layers, feeds, expected",
    [
        ("all", full_run.LAYERS, True, JOBS),
        ("whatever", full_run.LAYERS, True, JOBS),
        ("all", full_run.LAYERS, False, [j for j in JOBS if not j.startswith("land_")]),
        ("metadata_only", full_run.LAYERS, True, JOBS[:3]),
        ("observations", full_run.LAYERS, True, JOBS[3:6]),
        ("observations", ["bronze"], True, ["bronze_observations"]),
        ("metadata_only", ["silver"], False, ["silver_stations"]),
        ("all", ["landed"], True, ["land_stations", "land_observations"]),
        ("all", ["gold"], True, ["dim_date", "dim_station", "fact"]),
        ("dim_stations", ["gold"], False, ["dim_station"]),
        ("facts", full_run.LAYERS, True, ["fact"]),
    ],
)
def test_modes_and_layers_select_jobs_in_order(spark, monkeypatch, mode, layers, feeds, expected):
    for name in dir(full_run):
        if name.startswith(("land_", "bronze_", "silver_", "build_")):
            monkeypatch.setattr(full_run, name, lambda *args, **kwargs: None)
    feed = stations(spark, a="Kent") if feeds else None
    ran = run_layers(
        spark, Lake("x"), Run("r", DAYS[0], "feed"), mode, layers, stations=feed, readings=feed
    )
    assert ran == expected


def test_lake_paths():
    lake = Lake("gs://x")
    assert lake.gold_dim_date == "gs://x/gold/dim_date"
    with pytest.raises(AttributeError):
        lake.somewhere_else
    with pytest.raises(AttributeError):
        lake.gold


def test_bronze_keeps_its_declared_columns(spark, folder):
    lake = Lake(folder)
    run_layers(spark, lake, Run("r", DAYS[0], "feed"), "metadata_only", stations=stations(spark, a="Kent"))
    stored = read_table(spark, lake.bronze_stations)
    assert stored.columns == schemas.BRONZE_STATION.fieldNames()
    assert stored.select(F.col("_processed_at").cast("timestamp_ntz")).first()[0] == datetime(2024, 1, 1, 6)


def test_new_fields_of_a_reading_are_taken_along(spark, folder):
    lake = Lake(folder)
    narrow = readings(spark, ("a", "2024-01-01T00:00:00Z", 1.0))
    wide = readings(spark, ("a", "2024-01-02T00:00:00Z", 2.0)).withColumn("snow_depth", F.lit(0.5))
    reading = T.StructType([*schemas.READING.fields, T.StructField("snow_depth", T.DoubleType())])

    def land(n, rows):
        batch = batch_id(DAYS[n])
        write_landed(to_envelopes(rows, "station_geohash", batch), lake.landed_observations, batch)

    land(0, narrow)
    assert full_run.bronze_observations(spark, lake, Run("r0", DAYS[0], "feed"))
    land(1, wide)
    assert full_run.bronze_observations(spark, lake, Run("r1", DAYS[1], "feed"), reading)
    assert not full_run.bronze_observations(spark, lake, Run("r2", DAYS[2], "feed"), reading)
    stored = read_table(spark, lake.bronze_observations, schemas.bronze_observation(reading))
    assert sorted((r.temperature, r.snow_depth) for r in stored.collect()) == [(1.0, None), (2.0, 0.5)]


@pytest.mark.parametrize("multi_line", [False, True])
def test_a_folder_landed_again_loses_nothing(spark, folder, multi_line):
    lake, batch = Lake(folder), batch_id(DAYS[0])

    def land(*rows):
        nested = to_envelopes(readings(spark, *rows), "station_geohash", batch)
        write_landed(nested, lake.landed_observations, batch, multi_line)

    def bronze(n):
        added = full_run.bronze_observations(spark, lake, Run(f"r{n}", DAYS[n], "feed", multi_line))
        stored = read_table(spark, lake.bronze_observations, schemas.BRONZE_OBSERVATION)
        return added, sorted((r.station_geohash, r.temperature) for r in stored.collect())

    early = [("a", "2024-01-01T00:00:00Z", 1.0), ("b", "2024-01-01T00:00:00Z", 2.0)]
    land(*early)
    assert bronze(0) == (True, [("a", 1.0), ("b", 2.0)])
    assert bronze(1) == (False, [("a", 1.0), ("b", 2.0)])
    # the same moment again, now with all stations
    land(*early, ("c", "2024-01-01T00:00:00Z", 3.0), ("d", None, 4.0))
    assert bronze(2) == (True, [("a", 1.0), ("b", 2.0), ("c", 3.0), ("d", 4.0)])
    assert bronze(3)[0] is False


def land_parts(spark, lake, *parts):
    for n, rows in parts:
        batch = batch_id(DAYS[n])
        write_landed(to_envelopes(readings(spark, *rows), "station_geohash", batch), lake.landed_observations, batch)


def bronze_rows(spark, lake):
    stored = read_table(spark, lake.bronze_observations, schemas.BRONZE_OBSERVATION)
    columns = [c for c in stored.columns if c not in ("_extraction_id", "_source_file")]
    return sorted(stored.select(*columns).collect(), key=str)


def test_streamed_bronze_equals_the_batch_form(spark, folder, monkeypatch):
    batch_lake, lake = Lake(f"{folder}/batch"), Lake(f"{folder}/stream")
    one = [("a", "2024-01-01T00:00:00Z", 1.0), ("a", "2024-01-01T00:00:00Z", 1.5), ("b", None, 2.0)]
    two = [("a", "2024-01-01T00:00:00Z", 9.0), ("c", "2024-02-01T00:00:00Z", 3.0), ("b", None, 2.5)]
    run = Run("r", DAYS[3], "feed")
    for n, rows in enumerate((one, two)):
        land_parts(spark, batch_lake, (n, rows))
        full_run.bronze_observations(spark, batch_lake, run)
        land_parts(spark, lake, (n, rows))
        if n:
            # the driver is lost after the load and before the checkpoint knows
            append = full_run.append_load

            def lost(*args, **options):
                append(*args, **options)
                raise RuntimeError("lost")

            monkeypatch.setattr(full_run, "append_load", lost)
            with pytest.raises(Exception, match="lost"):
                full_run.stream_observations(spark, lake, run)
            monkeypatch.setattr(full_run, "append_load", append)
        assert full_run.stream_observations(spark, lake, run) > 0
    assert bronze_rows(spark, lake) == bronze_rows(spark, batch_lake)
    assert len(bronze_rows(spark, lake)) == 3
    assert full_run.stream_observations(spark, lake, run) == 0
    # the other form adds nothing, and a folder landed again is taken by the stream as well
    assert not full_run.bronze_observations(spark, lake, run)
    land_parts(spark, lake, (1, [*two, ("d", "2024-02-02T00:00:00Z", 4.0)]))
    full_run.stream_observations(spark, lake, run)
    assert len(bronze_rows(spark, lake)) == 4


def test_a_streamed_run_from_landing_to_gold(spark, folder):
    lake = Lake(folder)
    for n, temp in ((0, 1.0), (1, 2.0)):
        run = Run(f"r{n}", DAYS[n], "feed", streamed=True)
        rows = readings(spark, ("a", f"2024-01-0{n + 1}T00:00:00Z", temp), ("a", "2024-01-01T00:00:00Z", 1.0))
        run_layers(spark, lake, run, stations=stations(spark, a="Kent"), readings=rows, calendar=("2024-01-01", "2024-01-31"))
    assert state(spark, lake)[0] == [("a", 20240101, "00:00:00", 1.0), ("a", 20240102, "00:00:00", 2.0)]


def test_one_late_reading_adds_one_month(spark, folder):
    lake, run = Lake(folder), Run("r", DAYS[3], "feed")
    months = [f"2023-{m:02}" for m in range(1, 13)]
    land_parts(spark, lake, (0, [("a", f"{m}-05T00:00:00Z", 1.0) for m in months]))
    full_run.bronze_observations(spark, lake, run)
    loads = os.path.join(lake.bronze_observations, "load_id=r")
    assert sorted(n for n in os.listdir(loads) if "=" in n) == [f"load_month={m}" for m in months]
    # whatever lies in the months between is not opened
    for m in months[1:-1]:
        part = os.path.join(loads, f"load_month={m}")
        for name in os.listdir(part):
            with open(os.path.join(part, name), "wb") as f:
                f.write(b"not a table")
    late = [("a", "2023-12-05T00:00:00Z", 5.0), ("a", "2023-12-06T00:00:00Z", 6.0), ("a", "2023-01-05T00:00:00Z", 7.0)]
    land_parts(spark, lake, (1, late))
    assert full_run.bronze_observations(spark, lake, run)
    assert [r.temperature for r in spark.read.parquet(os.path.join(lake.bronze_observations, "load_id=r.2")).collect()] == [6.0]


def test_month_folders_are_what_the_scan_filters(spark, folder):
    lake, run = Lake(folder), Run("r", DAYS[3], "feed")
    land_parts(spark, lake, (0, [("a", "2023-01-05T00:00:00Z", 1.0), ("a", "", 2.0), ("a", None, 3.0)]))
    full_run.bronze_observations(spark, lake, run)
    stored = read_months(spark, lake.bronze_observations, schemas.BRONZE_OBSERVATION)
    batch = stored.drop("load_month")
    new = only_new(batch, stored, full_run.OBSERVATION_KEYS, prune_parts=(month_text("datetime"), "load_month"))
    assert new.count() == 0
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*load_month[^]]*2023-01", plan)
    # beyond a number of months their range is taken
    many = spark.range(1500).select(F.concat(F.lit("m"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("datetime"))
    condition = in_parts_of(many, F.col("datetime"), "x")
    inside = spark.createDataFrame([("m00000",), ("m01499",), ("m01500",), (None,)], "x string").filter(condition)
    assert sorted(r.x or "" for r in inside.collect()) == ["", "m00000", "m01499"]


def test_tables_begun_without_months_stay_so(spark, folder):
    lake, run = Lake(folder), Run("r", DAYS[3], "feed")
    land_parts(spark, lake, (0, [("a", "2023-01-05T00:00:00Z", 1.0)]))
    full_run.bronze_observations(spark, lake, run)
    old = Lake(f"{folder}/old")
    rows = read_table(spark, lake.bronze_observations, schemas.BRONZE_OBSERVATION)
    append_load(rows, old.bronze_observations, "begun")
    land_parts(spark, old, (0, [("a", "2023-01-05T00:00:00Z", 1.0), ("b", "2023-03-05T00:00:00Z", 1.0)]))
    assert full_run.bronze_observations(spark, old, run) and not has_months(spark, old.bronze_observations)
    assert len(bronze_rows(spark, old)) == 2


def test_the_dimension_reads_new_silver_files_only(spark, folder):
    lake = Lake(folder)

    def day(n, feed):
        run = Run(f"r{n}", DAYS[n], "feed")
        run_layers(spark, lake, run, "metadata_only", ["landed", "bronze", "silver"], stations=feed)
        changed = full_run.build_dim_station(spark, lake, run)
        # whoever reads these files again fails
        for name in os.listdir(lake.silver_stations):
            if name.startswith("part-"):
                with open(os.path.join(lake.silver_stations, name), "wb") as f:
                    f.write(b"not a table")
        rows = read_dimension(spark, lake.gold_dim_station).collect()
        return changed, sorted((r.StationKey, r.County, r.IsCurrent) for r in rows)

    assert day(0, stations(spark, a="Kent", b="Devon")) == (True, [("a", "Kent", True), ("b", "Devon", True)])
    second = [("a", "Essex", True), ("a", "Kent", False), ("b", "Devon", True), ("c", "Fife", True)]
    assert day(1, stations(spark, a="Essex", b="Devon", c="Fife")) == (True, second)
    assert day(2, stations(spark, a="Essex")) == (False, second)
    # a run of an earlier moment opens no version before the one that is current
    assert day(0, stations(spark, a="Surrey", b="Bath")) == (True, sorted([*second[:2], ("b", "Bath", True), ("b", "Devon", False), second[3]]))


def test_an_empty_silver_gives_an_empty_dimension(spark, folder):
    lake = Lake(folder)
    spark.createDataFrame([], schemas.SILVER_STATION).write.parquet(lake.silver_stations)
    full_run.build_dim_station(spark, lake, Run("r", DAYS[0], "feed"), [Target(f"{folder}/copy")])
    assert read_dimension(spark, lake.gold_dim_station).count() == 0 == read_table(spark, f"{folder}/copy").count()


def test_parked_readings_return_with_their_station(spark, folder):
    lake = Lake(folder)

    def day(n, feed, *rows):
        run = Run(f"r{n}", DAYS[n], "feed")
        run_layers(spark, lake, run, "metadata_only", ["landed", "bronze", "silver"], stations=feed)
        run_layers(spark, lake, run, "observations", ["landed", "bronze"], readings=readings(spark, *rows))
        stored = read_table(spark, lake.bronze_observations, schemas.BRONZE_OBSERVATION)
        parked = full_run.parked_readings(spark, lake, readings(spark).schema)
        return tuple(sorted((r.station_geohash, r.temperature) for r in df.collect()) for df in (stored, parked))

    late, never = ("b", "2024-01-01T00:00:00Z", 2.0), ("z", None, 9.0)
    first = day(0, stations(spark, a="Kent"), ("a", "2024-01-01T00:00:00Z", 1.0), late, late, never)
    assert first == ([("a", 1.0)], [("b", 2.0), ("z", 9.0)])
    # the feed brings the unknown reading again, which is parked once
    second = day(1, stations(spark, a="Kent"), never, ("a", "2024-01-02T00:00:00Z", 3.0))
    assert second == ([("a", 1.0), ("a", 3.0)], [("b", 2.0), ("z", 9.0)])
    third = ([("a", 1.0), ("a", 3.0), ("b", 2.0)], [("z", 9.0)])
    assert day(2, stations(spark, b="Devon")) == third
    # the same run repeated lands the released readings again, should its folder not have been taken
    assert day(2, stations(spark, b="Devon")) == third
    landed = os.path.join(lake.landed_observations, batch_id(DAYS[2]))
    assert spark.read.json(landed).count() == 1
    assert day(3, stations(spark, b="Devon")) == third
    assert len(os.listdir(lake.landed_unknown_observations)) == 2


def bytes_of(path, column):
    """Stored bytes a row of a column, over all files of a table."""
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/**/part-*.parquet", recursive=True) if "_taken_files" not in f]
    groups = [f.row_group(g) for f in files for g in range(f.num_row_groups)]
    chunks = [g.column(k) for g in groups for k in range(g.num_columns)]
    return sum(c.total_compressed_size for c in chunks if c.path_in_schema == column) / sum(f.num_rows for f in files)


def test_row_hashes_take_little_more_than_what_they_hold(spark, folder):
    lake, copy = Lake(f"{folder}/lake"), Target(f"{folder}/copy")
    # 20 stations with 1,000 days of one reading: the readings of a day would share their hash
    n = F.col("id").cast("int")
    day = F.date_add(F.lit("2021-01-01").cast("date"), F.floor(n / 20).cast("int"))
    moment = F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("datetime")
    measured = [n.cast(f.dataType).alias(f.name) for f in schemas.READING.fields if f.name != "datetime"]
    feed = spark.range(0, 20_000, 1, 1).select(F.concat(F.lit("s"), n % 20).alias("station_geohash"), moment, *measured)
    places = stations(spark, **{f"s{k}": "Kent" for k in range(20)})
    codec = spark.conf.get(PARQUET_CODEC, None)
    try:
        run_layers(spark, lake, Run("r", DAYS[0], "feed"), stations=places, readings=feed,
                   calendar=("2024-01-01", "2024-01-31"), copies={"fact": [copy]})
    finally:
        spark.conf.unset(PARQUET_CODEC) if codec is None else spark.conf.set(PARQUET_CODEC, codec)
    fact = read_batches(spark, copy.path, schemas.FACT)
    assert fact.count() == fact.select("RowHash").distinct().count() == 160_000
    # a SHA-256 has 32 bytes
    assert bytes_of(lake.silver_observations, "_row_hash") < 34
    assert bytes_of(lake.gold_fact, "RowHash") < 34
    assert bytes_of(copy.path, "RowHash") < 34
