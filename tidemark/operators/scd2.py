"""History dimension (type 2): stage, detect, apply, store, look up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.bronze import moment
from tidemark.operators.incremental import key_struct, latest_per_key
from tidemark.schemas import DIM_STATION
from tidemark.sources.files import path_exists, subfolders
from tidemark.sources.tables import staged

SNAPSHOT = "snapshot"

# Columns of the station dimension and where they come from.
STATION_COLUMNS = {
    "StationKey": "station_geohash",
    "StationName": "station_name",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "County": "county_name",
    "Country": "country_name",
    "CountryCode": "country_code",
    "StationType": "station_type",
    "RegionCode": "region_code",
    "TimeZone": "olson_time_zone",
}


def scd2_stage(
    silver: DataFrame,
    mapping: Mapping[str, str],
    source_system: str,
    as_of: datetime | Column | None = None,
    recorded: str | None = "_processed_at",
    row_hash: str = "_row_hash",
) -> DataFrame:
    """Open, current versions from silver.

    Silver holds every version ever seen, so only the newest per key by
    ``recorded`` is staged; older ones would look changed on every run.
    ``recorded=None`` takes the rows as they are.
    """
    key = next(iter(mapping.values()))
    rows = silver if recorded is None else latest_per_key(silver, [key], recorded)
    return rows.select(
        *[F.col(source).alias(target) for target, source in mapping.items()],
        moment(as_of).alias("EffStartDate"),
        F.lit(None).cast("timestamp").alias("EffEndDate"),
        F.lit(True).alias("IsCurrent"),
        F.col(row_hash).alias("RowHash"),
        F.lit(source_system).alias("SourceSystem"),
    )


def current_versions(dimension: DataFrame) -> DataFrame:
    return dimension.filter(F.col("IsCurrent"))


def scd2_changes(dimension: DataFrame, updates: DataFrame, key: str = "StationKey") -> DataFrame:
    """Updates that are new or differ from their current version."""
    known = current_versions(dimension).select(
        key_struct([key]), F.col("RowHash").alias("_hash"), F.lit(True).alias("_known")
    )
    same = F.col("_known").isNotNull() & F.col("RowHash").eqNullSafe(F.col("_hash"))
    return (
        updates.withColumn("_key", key_struct([key]))
        .join(known, "_key", "left")
        .filter(~same)
        .select(*updates.columns)
    )


def scd2_advance(
    dimension: DataFrame,
    updates: DataFrame,
    as_of: datetime | Column,
    key: str = "StationKey",
    close_missing: bool = False,
) -> DataFrame:
    """Current versions after ``updates``, and the versions those close.

    One join decides about every key: it is kept, closed at ``as_of`` and
    replaced, or added. Versions closed earlier never change and are left out,
    so the work follows the number of keys and not the length of the history.
    A key missing from ``updates`` stays current unless ``close_missing``.
    """
    columns = dimension.columns
    changed = updates.columns
    if set(columns) != set(changed):
        raise ValueError(f"updates have other columns: {sorted(set(columns) ^ set(changed))}")
    old = current_versions(dimension).select(key_struct([key]), F.struct(*columns).alias("_old"))
    new = updates.select(key_struct([key]), F.struct(*columns).alias("_new"))
    at = moment(as_of).cast(dimension.schema["EffStartDate"].dataType)

    kept = F.col("_old")
    closed = kept.withField("EffEndDate", at).withField("IsCurrent", F.lit(False))
    added = F.col("_new").withField("EffStartDate", at)
    rows = (
        F.when(F.col("_old").isNull(), F.array(added))
        .when(F.col("_new").isNull(), F.array(closed if close_missing else kept))
        .when(F.col("_old.RowHash").eqNullSafe(F.col("_new.RowHash")), F.array(kept))
        .otherwise(F.array(closed, added))
    )
    return old.join(new, "_key", "full").select(F.inline(rows)).select(*columns)


def scd2_apply(
    dimension: DataFrame,
    updates: DataFrame,
    as_of: datetime | Column,
    key: str = "StationKey",
    close_missing: bool = False,
) -> DataFrame:
    """The whole next dimension: earlier history and the advanced current versions."""
    history = dimension.filter(~F.col("IsCurrent"))
    return history.unionByName(scd2_advance(dimension, updates, as_of, key, close_missing))


# ---------------------------------------------------------------- stored form


def last_snapshot(spark: SparkSession, path: str) -> int | None:
    """Number of the newest finished snapshot; unfinished ones are passed over."""
    names = [n for n in subfolders(spark, path) if n.startswith(f"{SNAPSHOT}=")]
    numbers = sorted((int(n.removeprefix(f"{SNAPSHOT}=")) for n in names), reverse=True)
    return next((n for n in numbers if path_exists(spark, f"{path}/{SNAPSHOT}={n}/_SUCCESS")), None)


def read_dimension(
    spark: SparkSession,
    path: str,
    schema: T.StructType = DIM_STATION,
    snapshot: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """The dimension as of its newest (or the given) snapshot.

    Snapshot n holds all versions current after run n and those closed by run n.
    So the dimension is the current part of one snapshot and the closed part of
    all up to it, both picked by folder.
    """
    last = last_snapshot(spark, path) if snapshot is None else snapshot
    if last is None:
        raise FileNotFoundError(f"no finished snapshot below {path}")
    stored = T.StructType([*schema.fields, T.StructField(SNAPSHOT, T.IntegerType())])
    number, current = F.col(SNAPSHOT), F.col("IsCurrent")
    return (
        spark.read.format(fmt)
        .schema(stored)
        .load(path)
        .filter(((number == last) & current) | ((number <= last) & ~current))
        .select(*schema.fieldNames())
    )


def store_dimension(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    as_of: datetime,
    key: str = "StationKey",
    schema: T.StructType = DIM_STATION,
    close_missing: bool = False,
    fmt: str = "parquet",
) -> bool:
    """Bring the stored dimension up to date and say whether anything changed.

    The first run stores ``updates`` as they are. Nothing stored is ever
    overwritten: a run writes the next snapshot, which counts once it is
    finished, and a failed run's leftovers are replaced by its repetition.
    """
    last = last_snapshot(spark, path)
    if last is None:
        rows, number = updates, 1
    else:
        stored = read_dimension(spark, path, schema, last, fmt)
        updates = staged(updates, "dimension-updates")
        gone = (
            current_versions(stored).join(updates, key, "left_anti") if close_missing else None
        )
        if scd2_changes(stored, updates, key).isEmpty() and (gone is None or gone.isEmpty()):
            return False
        rows, number = scd2_advance(stored, updates, as_of, key, close_missing), last + 1
    out = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    # static: a session may overwrite only the folders it writes, leaving a failed run's others
    writer = out.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("IsCurrent").save(f"{path}/{SNAPSHOT}={number}")
    return True


# --------------------------------------------------------------- point in time

# Up to this many versions per key a row simply tries all versions of its key.
FEW_VERSIONS = 32
# Events of one key that one task carries versions along.
TASK_EVENTS = 1_000_000


def point_in_time(
    events: DataFrame,
    dimension: DataFrame,
    moment_column: str,
    event_key: str = "StationKey",
    key: str = "StationKey",
    keep_unmatched: bool = False,
    first_open: bool = True,
    few_versions: int = FEW_VERSIONS,
    task_events: int = TASK_EVENTS,
) -> DataFrame:
    """Join each event with the version valid at its moment; versions of a key don't overlap.

    Valid means start <= moment < end, without limit where the end is null and,
    with ``first_open``, before the start of a key's first version.

    While every key has few versions they are joined on the key, the range being a further
    condition, so a small dimension is broadcast by Spark's own size check. Otherwise events
    and versions lie in one sorted pass per key, in which each event takes the last version
    begun: events are shuffled once, however many versions there are. Keys with more
    than ``task_events`` events are dealt out to several such passes, each with all of the
    key's versions; a key with no more versions than ``task_events`` so has no more copies of
    them than it has events. Passes follow row positions: pass a table scan with narrow steps,
    or stage events that a shuffle made, so that a lost task is recomputed in the same order.
    """
    dimension = staged(dimension, "versions")
    per_key = dimension.groupBy(F.col(key).alias("_pk")).agg(
        F.min("EffStartDate").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    start = F.col("EffStartDate")
    versions = (
        dimension.withColumn("_pk", F.col(key))
        .join(per_key, "_pk")
        .select(
            F.col("_pk").alias("_vk"),
            (F.when(start > F.col("_first"), start) if first_open else start).alias("_low"),
            F.col("EffEndDate").alias("_high"),
            F.struct(*dimension.columns).alias("_version"),
        )
    )
    rows = events.withColumns({"_pk": F.col(event_key), "_at": F.col(moment_column).cast("timestamp")})
    most = per_key.agg(F.max("_n")).first()[0] or 0
    if most <= few_versions:
        begun = F.col("_low").isNull() | (F.col("_at") >= F.col("_low"))
        open_ = F.col("_high").isNull() | (F.col("_at") < F.col("_high"))
        how = "left" if keep_unmatched else "inner"
        rows = rows.join(versions, (F.col("_pk") == F.col("_vk")) & begun & open_, how)
    else:
        rows = _carried(rows, versions, events.columns, task_events)
        if not keep_unmatched:
            rows = rows.filter(F.col("_version").isNotNull())
    attributes = [c for c in dimension.columns if c not in events.columns]
    return rows.select(*events.columns, *[F.col(f"_version.{c}").alias(c) for c in attributes])


def _carried(
    rows: DataFrame, versions: DataFrame, columns: Sequence[str], task_events: int
) -> DataFrame:
    """Each event with the last version begun at its moment, if that has not ended.

    Events and versions are put together and sorted per key: a version stands before the
    events of its first moment, one that ends at once before one that lasts.
    """
    busy = staged(
        rows.groupBy("_pk")
        .agg(F.count(F.lit(1)).alias("_events"))
        .filter((F.col("_events") > task_events) & F.col("_pk").isNotNull())
        .select("_pk", F.ceil(F.col("_events") / task_events).cast("int").alias("_passes")),
        "busy-keys",
    )
    passes = F.coalesce("_passes", F.lit(1))
    # which pass an event is in changes nothing but the balance; copies of an event part too
    turn = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30))
    event = F.struct(*[F.col(c) for c in columns])
    events = rows.select("_pk", "_at", event.alias("_event"), turn.alias("_turn"))
    if busy.isEmpty():
        events = events.withColumn("_pass", F.lit(0))
        copies = versions.withColumnRenamed("_vk", "_pk").withColumn("_pass", F.lit(0))
    else:
        events = events.join(busy, "_pk", "left").withColumn("_pass", (F.col("_turn") % passes).cast("int"))
        copies = (
            versions.withColumnRenamed("_vk", "_pk")
            .join(busy, "_pk", "left")
            .withColumn("_pass", F.explode(F.sequence(F.lit(0), passes - 1)))
        )
    both = events.select("_pk", "_pass", "_at", "_event").unionByName(
        copies.select("_pk", "_pass", F.col("_low").alias("_at"), "_version", "_high"), allowMissingColumns=True
    )
    order = (
        F.col("_at").asc_nulls_first(),
        F.col("_version").isNull().asc(),
        F.col("_high").asc_nulls_last(),
    )
    so_far = (
        Window.partitionBy("_pk", "_pass").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    begun = F.last(F.when(F.col("_version").isNotNull(), F.struct("_version", "_high")), ignorenulls=True)
    valid = F.col("_begun._high").isNull() | (F.col("_at") < F.col("_begun._high"))
    return (
        both.withColumn("_begun", begun.over(so_far))
        .filter(F.col("_event").isNotNull())
        .select("_event.*", F.when(F.col("_pk").isNotNull() & valid, F.col("_begun._version")).alias("_version"))
    )
