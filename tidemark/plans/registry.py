"""One runnable query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import (
    clock_text,
    date_key,
    name_from_path,
    row_hash,
    safe_name,
    split_typed,
)
from tidemark.operators import marts
from tidemark.operators.bronze import columns_first, flatten, with_audit
from tidemark.operators.calendar import calendar_covering, generate_dim_date
from tidemark.operators.conform import Field, conform
from tidemark.operators.incremental import only_new
from tidemark.operators.metrics import to_fact, unpivot_metrics
from tidemark.operators.scd2 import (
    STATION_COLUMNS,
    current_versions,
    point_in_time,
    read_dimension,
    scd2_apply,
    scd2_changes,
    scd2_stage,
    store_dimension,
)
from tidemark.plans import domain
from tidemark.plans.domain import DAY_1, DAY_2, ISO, SOURCE, table
from tidemark.plans.full_run import (
    Lake,
    Run,
    bronze_observations,
    build_dim_station,
    build_season_parts,
    parked_readings,
    run_layers,
    stream_observations,
)
from tidemark.schemas import WEATHER_METRICS, Metric
from tidemark.session import pack_tables, pin_utc, scratch_dir
from tidemark.sources.files import drop_folder
from tidemark.sources.landed import (
    batch_id,
    latest_batch,
    read_landed,
    station_drive_list,
    to_envelopes,
    write_landed,
)
from tidemark.sources.seed import enrich_override, monitored, read_seed, with_coordinates
from tidemark.sources.tables import (
    MONTH,
    Target,
    append_load,
    publish,
    read_months,
    read_published,
    read_table,
    read_table_stream,
)
from tidemark.streaming import read_batches, run_foreach_batch, run_incremental
from tidemark.streaming.runs import write_batch

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def _plain_times(df: DataFrame) -> DataFrame:
    """Instants as UTC wall time, which reads the same in every client zone."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _query(function: Query) -> Query:
    """Register ``function`` under its name without the leading underscore."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain_times(function(pack_tables(pin_utc(spark)), sf_dir))

    _QUERIES[function.__name__.removeprefix("_")] = run
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# ------------------------------------------------------------- star schema


@_query
def season_leaderboard(spark, sf_dir):
    calendar = calendar_covering(table(spark, sf_dir, "lineitem"), "l_shipdate")
    winds = domain.fact(spark, sf_dir, "Wind Speed", "Wind Gust")
    return marts.season_leaderboard(winds, domain.dimension(spark, sf_dir), calendar)


@_query
def season_leaderboard_sliced(spark, sf_dir):
    """The same with groups cut into slices, as for more stations than fit one task."""
    calendar = calendar_covering(table(spark, sf_dir, "lineitem"), "l_shipdate")
    winds = domain.fact(spark, sf_dir, "Wind Speed", "Wind Gust")
    return marts.season_leaderboard(winds, domain.dimension(spark, sf_dir), calendar, task_rows=3)


@_query
def dim_date_range(spark, sf_dir):
    """The calendar between two given days, here the bounds of the orders."""
    days = table(spark, sf_dir, "orders").agg(
        *(f(F.to_date("o_orderdate")).cast("string") for f in (F.min, F.max))
    )
    return generate_dim_date(spark, *days.first())


@_query
def dim_date(spark, sf_dir):
    return calendar_covering(table(spark, sf_dir, "lineitem"), "l_shipdate")


@_query
def fact_unpivot(spark, sf_dir):
    ids = [
        F.col("station_geohash").alias("StationKey"),
        date_key("observation_datetime").alias("DateKey"),
    ]
    long = unpivot_metrics(domain.silver_readings(spark, sf_dir), ids, WEATHER_METRICS)
    return long.withColumn("RowHash", row_hash(["StationKey", "DateKey", "MetricName"]))


@_query
def fact_typed_values(spark, sf_dir):
    metrics = [
        Metric("Value", "value", "n"),
        Metric("Type", "event_type", "text"),
        Metric("Props", "props", "json"),
    ]
    ids = [
        F.col("event_id"),
        date_key("ts").alias("DateKey"),
        clock_text("ts").alias("ObservationTime"),
    ]
    long = unpivot_metrics(table(spark, sf_dir, "events"), ids, metrics)
    number, text = split_typed("RawValue")
    return long.select(
        "event_id",
        "DateKey",
        "ObservationTime",
        "MetricName",
        number.alias("ValueNumeric"),
        text.alias("ValueString"),
    )


@_query
def fact_rows(spark, sf_dir):
    return domain.fact(spark, sf_dir)


@_query
def metric_breakdown(spark, sf_dir):
    return marts.metric_breakdown(domain.fact(spark, sf_dir))


@_query
def eav_pivot(spark, sf_dir):
    metrics = {m.name: m.name.lower().replace(" ", "_") for m in WEATHER_METRICS}
    return marts.eav_pivot(domain.fact(spark, sf_dir), metrics, {"Wind Direction"})


@_query
def fact_orphans(spark, sf_dir):
    # only automatic stations and the days on which orders were placed are known
    stations = domain.dimension(spark, sf_dir).filter(F.col("StationType") == "Automatic")
    calendar = calendar_covering(table(spark, sf_dir, "orders"), "o_orderdate")
    return marts.fact_orphans(domain.fact(spark, sf_dir), stations, calendar)


@_query
def duplicate_current(spark, sf_dir):
    # loading every version of the history as current is the mistake this finds
    history = domain.silver_station_history(spark, sf_dir)
    rows = scd2_stage(history, STATION_COLUMNS, SOURCE, DAY_2, recorded=None)
    return marts.duplicate_current(rows)


# ------------------------------------------------------------------ silver


@_query
def silver_conform_stations(spark, sf_dir):
    return domain.silver_stations(spark, sf_dir)


@_query
def silver_conform_observations(spark, sf_dir):
    return domain.silver_readings(spark, sf_dir)


# ------------------------------------------------------------------ bronze


@_query
def bronze_audit_hash(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        F.col("_metadata.file_path").alias("_path"),
    )
    file_name = F.regexp_extract("_path", r"([^/]+)$", 1)
    return with_audit(orders, "run-1", DAY_1, source_file=file_name)


@_query
def name_from_file(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    supplier = table(spark, sf_dir, "supplier")
    rows = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.concat_ws(": ", "s_name", F.concat("n_name", F.lit(", (land)"))).alias("title")
    )
    path = F.concat(F.lit("/landed/20240101_000000+0000/"), safe_name("title"), F.lit(".json"))
    return columns_first(rows.withColumn("station_name", name_from_path(path)), "station_name")


@_query
def bronze_incremental(spark, sf_dir):
    # orders of urgent priority lost their customer: null is a key value too
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey"))
    )
    path = f"{scratch_dir(spark, 'bronze')}/orders"
    keys = ["o_custkey", "o_orderdate"]
    earlier = orders.filter(F.col("o_orderdate") < "1998-01-01")
    append_load(earlier, path, "run-1")
    # the second batch brings everything again, in two copies
    stored = read_table(spark, path, orders.schema)
    batch = orders.unionAll(orders)
    new = only_new(batch, stored, keys, ["o_orderkey"], prune_on="o_orderdate")
    append_load(new, path, "run-2")
    # the third has nothing new and writes nothing
    stored = read_table(spark, path, orders.schema)
    append_load(only_new(orders, stored, keys, ["o_orderkey"]), path, "run-3")
    return read_table(spark, path, orders.schema)


@_query
def bronze_schema_evolution(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    path = f"{scratch_dir(spark, 'evolving')}/part"
    append_load(part.drop("p_retailprice", "p_size"), path, "run-1")
    append_load(part, path, "run-2")
    return read_table(spark, path, merge_schema=True)


# ------------------------------------------------------- sources and landed


@_query
def seed_stations(spark, sf_dir):
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    latitude = F.concat(nation.cast("string"), F.lit("."), F.lpad((key % 1000).cast("string"), 3, "0"))
    longitude = F.concat(F.lit("-"), (key % 180).cast("string"), F.lit(".5"))
    location = (
        F.when(nation == 3, "unknown")
        .when(nation == 4, latitude)
        .when(nation == 5, F.concat(latitude, F.lit(", east")))
        .when(nation == 6, F.concat(latitude, F.lit("d, 1.5")))
        .otherwise(F.concat(latitude, F.lit(", "), longitude))
    )
    seed = table(spark, sf_dir, "supplier").select(
        # the byte order mark that spreadsheets put in front of the header
        F.concat("s_name", F.lit(', "main"')).alias("\ufeffstation_name"),
        F.concat(F.lit("Region "), nation.cast("string")).alias("region"),
        F.lit("GB").alias("country_code"),
        location.alias("location"),
        F.lit("Automatic").alias("station_type"),
        F.when(F.col("s_acctbal") >= 0, 1).otherwise(0).alias("is_monitored"),
    )
    path = f"{scratch_dir(spark, 'seed')}/stations.csv"
    seed.write.csv(path, header=True, escape='"')
    return with_coordinates(monitored(read_seed(spark, path)))


@_query
def metadata_override_merge(spark, sf_dir):
    nation_key = F.col("s_nationkey").cast("double")
    # suppliers in debt lie off the grid and get no answer
    off = F.when(F.col("s_acctbal") < 0, 0.5).otherwise(0.001)
    seed = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("station_name"),
        (nation_key + off).alias("latitude"),
        (-nation_key - 0.002).alias("longitude"),
        F.lit("seed region").alias("region"),
        F.lit("GB").alias("country_code"),
    )
    place = F.col("n_nationkey").cast("double")
    metadata = table(spark, sf_dir, "nation").select(
        (place - 0.002).alias("latitude"),
        (-place + 0.001).alias("longitude"),
        F.concat(F.lit("N"), "n_nationkey").alias("geohash"),
        F.col("n_name").alias("area"),
        F.when(F.col("n_regionkey") > 0, F.concat(F.lit("R"), "n_regionkey")).alias("region"),
    )
    return enrich_override(seed, metadata).drop("latitude", "longitude")


@_query
def _station_drive_list(spark, sf_dir):
    return station_drive_list(domain.silver_readings(spark, sf_dir))


@_query
def landed_roundtrip_explode(spark, sf_dir):
    batch = "20240101_000000+0000"
    readings = domain.readings(table(spark, sf_dir, "lineitem"))
    envelopes = to_envelopes(readings, "station_geohash", batch)
    path = write_landed(envelopes, scratch_dir(spark, "landed"), batch)
    landed = read_landed(spark, path, schemas.LANDED_OBSERVATION)
    return flatten(landed, "data", ["station_geohash", "extracted_at"])


@_query
def landed_multiline_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), "o_custkey").alias("station_geohash"),
        F.date_format("o_orderdate", ISO).alias("datetime"),
        F.col("o_totalprice").alias("temperature"),
        F.col("o_orderkey").alias("visibility"),
        F.col("o_orderpriority").alias("wind_direction"),
    )
    reading = T.StructType([f for f in orders.schema.fields if f.name != "station_geohash"])
    batch = "20240101_000000+0000"
    envelopes = to_envelopes(orders, "station_geohash", batch)
    path = write_landed(
        envelopes, scratch_dir(spark, "pretty"), batch, multi_line=True, records_per_file=1000
    )
    landed = read_landed(spark, f"{path}/*.json", schemas.envelope(reading), multi_line=True)
    return flatten(landed, "data", ["station_geohash", "extracted_at"])


@_query
def latest_batch_scan(spark, sf_dir):
    base = scratch_dir(spark, "batches")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.date_format("o_orderdate", ISO).alias("o_orderdate")
    )
    # the second name sorts last but is the earlier moment, in another zone
    for batch, rows in {
        "20240331_013000+0000": orders.filter(F.col("o_orderstatus") == "O"),
        "20240331_020000+0100": orders.filter(F.col("o_orderstatus") == "F"),
        "20231231_235959+0000": orders.filter(F.col("o_orderstatus") == "P"),
    }.items():
        write_landed(rows, base, batch)
    newest = latest_batch(spark, base, "/bronze")
    landed = read_landed(spark, newest.glob, orders.schema)
    return landed.drop("_source_file").withColumn("version", F.lit(newest.version))


# ------------------------------------------------------- history dimension


@_query
def dim_station_initial(spark, sf_dir):
    return domain.dimension(spark, sf_dir)


@_query
def _scd2_changes(spark, sf_dir):
    return scd2_changes(domain.dimension(spark, sf_dir), domain.dimension_updates(spark, sf_dir))


@_query
def _scd2_apply(spark, sf_dir):
    return scd2_apply(
        domain.dimension(spark, sf_dir), domain.dimension_updates(spark, sf_dir), DAY_2
    )


@_query
def scd2_idempotent(spark, sf_dir):
    path = f"{scratch_dir(spark, 'dimension')}/stations"
    store_dimension(spark, path, domain.dimension(spark, sf_dir), DAY_1)
    updates = domain.dimension_updates(spark, sf_dir)
    store_dimension(spark, path, updates, DAY_2)
    # the same updates a day later change nothing
    if store_dimension(spark, path, updates, DAY_2 + timedelta(days=1)):
        raise AssertionError("a repeated update must not change the dimension")
    return read_dimension(spark, path)


@_query
def dim_station_incremental(spark, sf_dir):
    """The dimension from silver files that came since its last run, each read once."""
    lake = Lake(scratch_dir(spark, "incremental"))
    feeds = (domain.silver_stations, domain.silver_stations_again)
    for n, (feed, day) in enumerate(zip(feeds, (DAY_1, DAY_2), strict=True)):
        append_load(feed(spark, sf_dir), lake.silver_stations, f"feed-{n}")
        build_dim_station(spark, lake, Run(f"run-{n}", day, SOURCE))
    # a run without new silver rows changes nothing
    if build_dim_station(spark, lake, Run("run-2", DAY_2 + timedelta(days=1), SOURCE)):
        raise AssertionError("nothing new must not change the dimension")
    return read_dimension(spark, lake.gold_dim_station)


@_query
def scd2_current(spark, sf_dir):
    return current_versions(
        scd2_apply(domain.dimension(spark, sf_dir), domain.dimension_updates(spark, sf_dir), DAY_2)
    ).select("StationKey", "StationName", "County", "EffStartDate")


def _shipments(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.lit("S"), "l_suppkey").alias("StationKey"),
        "l_quantity",
        "l_shipdate",
    )


@_query
def scd2_point_in_time(spark, sf_dir):
    turn = datetime(1998, 1, 1, tzinfo=timezone.utc)
    stations = scd2_apply(
        domain.dimension(spark, sf_dir).withColumn("EffStartDate", F.lit(DAY_1 - timedelta(9999))),
        domain.dimension_updates(spark, sf_dir),
        turn,
    ).select("StationKey", "StationName", "County", "EffStartDate", "EffEndDate")
    return point_in_time(_shipments(spark, sf_dir), stations, "l_shipdate")


@_query
def scd2_point_in_time_dense(spark, sf_dir):
    # a station gets a new version in every month in which it ships something
    rows = _shipments(spark, sf_dir)
    month = F.date_trunc("month", F.col("l_shipdate").cast("timestamp"))
    starts = rows.select("StationKey", month.alias("EffStartDate")).distinct()
    by_station = F.lead("EffStartDate").over(
        Window.partitionBy("StationKey").orderBy("EffStartDate")
    )
    versions = starts.withColumn("EffEndDate", by_station).withColumn(
        "VersionKey", F.concat_ws("@", "StationKey", F.date_format("EffStartDate", "yyyy-MM"))
    )
    return point_in_time(rows, versions, "l_shipdate").select(
        "l_orderkey", "l_linenumber", "StationKey", "l_shipdate", "VersionKey"
    )


# --------------------------------------------------------------- streaming

_EVENT_FIELDS = (
    Field("event_id", "event_id"),
    Field("event_type", "event_code", trim=True, upper=True),
    Field("value", "value"),
    Field("ts", "event_time"),
)


def _event_loads(spark, sf_dir, path):
    """The events in two loads: appended one after the other between runs."""
    events = table(spark, sf_dir, "events")
    late = F.col("ts") >= "2024-01-20"
    for load, rows in (("run-1", events.filter(~late)), ("run-2", events.filter(late))):
        append_load(rows, path, load)
        yield events.schema


@_query
def silver_stream_append(spark, sf_dir):
    root = scratch_dir(spark, "silver")
    bronze, silver = f"{root}/bronze", f"{root}/silver"
    for schema in _event_loads(spark, sf_dir, bronze):
        run_incremental(
            read_table_stream(spark, bronze, schema),
            lambda df: conform(df, _EVENT_FIELDS, ["event_id", "event_type"], SOURCE, DAY_1),
            silver,
        )
    return read_table(spark, silver)


@_query
def fact_stream_foreachbatch(spark, sf_dir):
    root = scratch_dir(spark, "fact")
    silver, gold, copy = f"{root}/silver", f"{root}/gold", f"{root}/copy"
    metrics = [Metric("Value", "value", "n"), Metric("Type", "event_type", "text")]

    def transform(df):
        return to_fact(df, metrics, SOURCE, station="user_id", observed="ts", as_of=DAY_1)

    for schema in _event_loads(spark, sf_dir, silver):
        run_foreach_batch(
            read_table_stream(spark, silver, schema), transform, gold, copies=[Target(copy)]
        )
    # a driver that failed after the first sink hands the same batch in again
    events = read_table(spark, silver, schema)
    for _ in range(2):
        write_batch(transform(events), "again-0", f"{root}/replayed", [Target(f"{root}/replayed-copy")])
    tables = {"gold": gold, "copy": copy, "replayed": f"{root}/replayed-copy"}
    out = None
    for name, path in tables.items():
        rows = read_batches(spark, path, schemas.FACT).withColumn("Sink", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out


@_query
def publish_refresh(spark, sf_dir):
    target = Target(f"{scratch_dir(spark, 'warehouse')}/dim_date")
    for day, name in (("o_orderdate", "orders"), ("l_shipdate", "lineitem")):
        publish(calendar_covering(table(spark, sf_dir, name), day), target)
    return spark.read.parquet(target.path)


@_query
def publish_versions(spark, sf_dir):
    """A table refreshed as versions, read while a third refresh is under way."""
    target = Target(f"{scratch_dir(spark, 'versions')}/dim_date", versioned=True)
    for day, name in (("o_orderdate", "orders"), ("l_shipdate", "lineitem")):
        publish(calendar_covering(table(spark, sf_dir, name), day), target)
    # a writer that was lost before its version was whole
    unfinished = table(spark, sf_dir, "nation")
    unfinished.write.parquet(f"{target.path}/version=3")
    drop_folder(spark, f"{target.path}/version=3/_SUCCESS")
    return read_published(spark, target)


@_query
def connector_append_once(spark, sf_dir):
    """A sink without folders gets two batches: the first twice, the second after a torn attempt."""
    root = scratch_dir(spark, "connector")
    sink = Target(options={"path": f"{root}/sink"})
    events = table(spark, sf_dir, "events")
    metrics = [Metric("Value", "value", "n"), Metric("Type", "event_type", "text")]
    late = F.col("ts") >= "2024-01-20"
    early, rest = (
        to_fact(rows, metrics, SOURCE, station="user_id", observed="ts", as_of=DAY_1)
        for rows in (events.filter(~late), events.filter(late))
    )
    for _ in range(2):
        write_batch(early, "q-0", f"{root}/fact", [sink])
    publish(rest.filter("ValueNumeric IS NULL").withColumn("batch_id", F.lit("q-1")), sink, mode="append")
    write_batch(rest, "q-1", f"{root}/fact", [sink])
    return spark.read.parquet(sink.options["path"])


@_query
def season_leaderboard_folded(spark, sf_dir):
    """The leaderboard from partial sums of three fact batches, each read once."""
    lake = Lake(scratch_dir(spark, "parts"))
    publish(calendar_covering(table(spark, sf_dir, "lineitem"), "l_shipdate"), Target(lake.gold_dim_date))
    winds = domain.fact(spark, sf_dir, "Wind Speed", "Wind Gust", "Wind Direction")
    for third in range(3):
        part = winds.filter(F.floor(F.col("DateKey") / 100) % 3 == third)
        write_batch(part, f"batch-{third}", lake.gold_fact, partition_by=["MetricName"])
        build_season_parts(spark, lake, Run(f"run-{third}", DAY_1, SOURCE))
    parts = read_table(spark, lake.gold_season_parts).drop("batch_id")
    return marts.season_leaderboard_of(parts, domain.dimension(spark, sf_dir))


# ---------------------------------------------------------------- full run


@_query
def landed_batches_all(spark, sf_dir):
    """Three batches landed before one bronze run: readings by the month they were shipped."""
    lake = Lake(scratch_dir(spark, "batches"))
    lines = table(spark, sf_dir, "lineitem")
    for third in range(3):
        day = DAY_1 + timedelta(days=third)
        part = domain.readings(lines.filter(F.month("l_shipdate") % 3 == third))
        nested = to_envelopes(part, "station_geohash", batch_id(day))
        write_landed(nested, lake.landed_observations, batch_id(day))
    bronze_observations(spark, lake, Run("all", DAY_2, SOURCE))
    stored = read_table(spark, lake.bronze_observations, schemas.BRONZE_OBSERVATION)
    return stored.select("station_geohash", "datetime")


@_query
def landed_again(spark, sf_dir):
    """One folder landed twice and then grown by a file, with a bronze run after each."""
    lake, batch = Lake(scratch_dir(spark, "again")), batch_id(DAY_1)
    lines = table(spark, sf_dir, "lineitem")
    for n, flags in enumerate((["A"], ["A", "N"])):
        part = domain.readings(lines.filter(F.col("l_returnflag").isin(flags)))
        write_landed(to_envelopes(part, "station_geohash", batch), lake.landed_observations, batch)
        bronze_observations(spark, lake, Run(f"run-{n}", DAY_2, SOURCE))
    rest = domain.readings(lines.filter(~F.col("l_returnflag").isin("A", "N")))
    folder = f"{lake.landed_observations}/{batch}"
    to_envelopes(rest, "station_geohash", batch).write.mode("append").json(folder, compression="gzip")
    bronze_observations(spark, lake, Run("run-2", DAY_2, SOURCE))
    stored = read_table(spark, lake.bronze_observations, schemas.BRONZE_OBSERVATION)
    return stored.select("station_geohash", "datetime", "wind_direction")


@_query
def bronze_stream(spark, sf_dir):
    """Bronze fed by a stream that is started again after each landed batch."""
    lake = Lake(scratch_dir(spark, "streamed"))
    lines = table(spark, sf_dir, "lineitem")
    for third in range(3):
        day = DAY_1 + timedelta(days=third)
        # every batch repeats the readings of the third before
        months = F.month("l_shipdate") % 3
        part = domain.readings(lines.filter(months.isin([third, max(third - 1, 0)])))
        nested = to_envelopes(part, "station_geohash", batch_id(day))
        write_landed(nested, lake.landed_observations, batch_id(day))
        stream_observations(spark, lake, Run(f"run-{third}", day, SOURCE))
    stored = read_table(spark, lake.bronze_observations, schemas.BRONZE_OBSERVATION)
    return stored.select(
        "station_geohash", "datetime", "extracted_at", "visibility", "wind_speed", "_extraction_id", "_row_hash"
    )


@_query
def bronze_late_month(spark, sf_dir):
    """Bronze by month: a second batch of one month, and one reading of the first month."""
    lake = Lake(scratch_dir(spark, "months"))
    lines = table(spark, sf_dir, "lineitem")
    last = F.date_trunc("month", F.lit(lines.agg(F.max("l_shipdate")).first()[0]))
    first = lines.agg(F.min(F.struct("l_shipdate", "l_orderkey", "l_linenumber")).alias("m")).first().m
    late = (F.col("l_orderkey") == first.l_orderkey) & (F.col("l_linenumber") == first.l_linenumber)
    for n, rows in enumerate((lines.filter((F.col("l_shipdate") < last) & ~late), lines.filter((F.col("l_shipdate") >= last) | late))):
        day = DAY_1 + timedelta(days=n)
        nested = to_envelopes(domain.readings(rows), "station_geohash", batch_id(day))
        write_landed(nested, lake.landed_observations, batch_id(day))
        bronze_observations(spark, lake, Run(f"run-{n}", day, SOURCE))
    stored = read_months(spark, lake.bronze_observations, schemas.BRONZE_OBSERVATION)
    return stored.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("readings"), F.countDistinct("station_geohash").alias("stations")
    )


@_query
def late_station(spark, sf_dir):
    """Suppliers of region 2 become known a day after their readings, those of region 3 never."""
    lake = Lake(scratch_dir(spark, "late"))
    stations = domain.station_records(spark, sf_dir).filter(F.col("country_code") != "R3")
    readings = domain.readings(table(spark, sf_dir, "lineitem"))
    first = stations.filter(F.col("country_code") != "R2")
    for day, run_id, feed, rows in (
        (DAY_1, "day-1", first, readings),
        (DAY_2, "day-2", stations, readings.limit(0)),
    ):
        run = Run(run_id, day, SOURCE)
        run_layers(spark, lake, run, "metadata_only", ["landed", "bronze", "silver"], stations=feed)
        run_layers(spark, lake, run, "observations", ["landed", "bronze"], readings=rows)
    stored = read_table(spark, lake.bronze_observations, schemas.BRONZE_OBSERVATION)
    parked = parked_readings(spark, lake, readings.schema)
    return stored.select("station_geohash", "datetime", F.col("_extraction_id").alias("run")).unionByName(
        parked.select("station_geohash", "datetime", F.lit("parked").alias("run"))
    )


@_query
def station_ingest(spark, sf_dir):
    """From a seed list and a metadata table to silver stations."""
    lake = Lake(scratch_dir(spark, "ingest"))
    nation = F.col("s_nationkey").cast("string")
    seed = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("station_name"),
        F.lit("seed region").alias("region"),
        F.lit("GB").alias("country_code"),
        F.concat(nation, F.lit(".001, -"), nation, F.lit(".002")).alias("location"),
        F.lit("Automatic").alias("station_type"),
        F.when(F.col("s_acctbal") >= 0, 1).otherwise(0).alias("is_monitored"),
    )
    path = f"{lake.root}/seed.csv"
    seed.write.csv(path, header=True, escape='"')
    place = F.col("n_nationkey").cast("double")
    metadata = table(spark, sf_dir, "nation").select(
        place.alias("latitude"),
        (-place).alias("longitude"),
        F.concat(F.lit("N"), "n_nationkey").alias("geohash"),
        F.col("n_name").alias("area"),
        F.concat(F.lit("r"), "n_regionkey").alias("region"),
        F.lit("GB").alias("country"),
        F.lit("Etc/UTC").alias("olson_time_zone"),
    )
    run_layers(spark, lake, Run("seed", DAY_1, SOURCE), mode="metadata_only", seed=(path, metadata))
    silver = read_table(spark, lake.silver_stations, schemas.SILVER_STATION)
    return silver.select("station_name", "station_geohash", "county_name", "region_code", "latitude")


@_query
def layered_full_run(spark, sf_dir):
    lake = Lake(f"{scratch_dir(spark, 'lake')}")
    copy = Target(f"{lake.root}/warehouse/fact")
    span = ("1995-01-01", "2001-12-31")
    # the second day delivers the same records and readings again
    for day, run_id in ((DAY_1, "day-1"), (DAY_2, "day-2")):
        run_layers(
            spark,
            lake,
            Run(run_id, day, SOURCE),
            stations=domain.station_records(spark, sf_dir),
            readings=domain.readings(table(spark, sf_dir, "lineitem")),
            calendar=span,
            copies={"fact": [copy]},
        )
    rows = read_batches(spark, copy.path, schemas.FACT)
    stations = current_versions(read_dimension(spark, lake.gold_dim_station))
    return (
        rows.join(stations.select("StationKey", "County"), "StationKey")
        .groupBy("County", "MetricName")
        .agg(
            F.count(F.lit(1)).alias("RowCount"),
            F.count("ValueNumeric").alias("NumericCount"),
            F.count("ValueString").alias("StringCount"),
            F.sum(F.col("ValueNumeric").cast("decimal(18,2)")).cast("decimal(28,2)").alias("Total"),
        )
    )
