"""Layer tables: scans, replay-safe appends, and publishing."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import hashes_packed, scratch_dir
from tidemark.sources.files import drop_folder, move_folder, path_exists, subfolders

LOAD = "load_id"
#: Folders by month inside a load, of tables that have them.
MONTH = "load_month"
_FILE_FORMATS = {"parquet", "orc", "json", "avro"}


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    merge_schema: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Batch scan. A declared schema fills columns that older files lack with nulls
    at no cost; ``merge_schema`` finds them out by reading every file's footer."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None and fmt in _FILE_FORMATS:
        reader = reader.schema(schema)
    elif merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path).drop(LOAD, MONTH)


def read_months(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """A table in folders by month, with the month as text in MONTH; scans skip other months'
    folders where a filter names the months."""
    with_month = T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])
    return spark.read.format(fmt).schema(with_month).load(path).drop(LOAD)


def has_months(spark: SparkSession, path: str) -> bool:
    """Whether the loads of a stored table lie in folders by month; False without any load.

    All loads of a table are laid out alike, so one of them tells."""
    loads = [name for name in subfolders(spark, path) if name.startswith(f"{LOAD}=")]
    return any(n.startswith(f"{MONTH}=") for n in subfolders(spark, f"{path}/{loads[0]}")) if loads else False


def read_table_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Incremental scan: each row is seen once per checkpoint."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None and fmt in _FILE_FORMATS:
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).drop(LOAD, MONTH)


def _load_folder(path: str, load: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9._+-]+", load):
        raise ValueError(f"not usable as a folder name: {load!r}")
    return f"{path}/{LOAD}={load}"


def free_load(spark: SparkSession, path: str, load: str) -> str:
    """``load``, or ``load.2`` and so on where that load is finished already."""
    name, n = load, 1
    while path_exists(spark, _load_folder(path, name)):
        n += 1
        name = f"{load}.{n}"
    return name


def append_load(
    df: DataFrame,
    path: str,
    load: str,
    fmt: str = "parquet",
    replay: bool = False,
    partition_by: Sequence[str] = (),
    dealt: bool = False,
) -> bool:
    """Append ``df`` as one load and say whether there were rows to add.

    A load is written to a hidden folder and moved into place when it is whole,
    so readers and streams never see part of it and a failed run leaves nothing
    behind that counts. A finished load is not written again: its files may have
    been read downstream. Its name raises FileExistsError, unless ``replay`` says that
    these are the same rows once more.

    Rows are written in one pass. Looking into the written folder replaces
    counting before the write, which would compute the whole plan twice; an
    empty load is dropped. With ``partition_by`` rows are first dealt out by those columns
    in even shares, so that a folder gets few files and a large one is written by many tasks;
    ``dealt`` says that they already are.
    """
    folder = _load_folder(path, load)
    if fmt not in _FILE_FORMATS:
        if df.isEmpty():
            return False
        df.write.format(fmt).mode("append").option("mergeSchema", "true").save(path)
        return True
    spark, hidden = df.sparkSession, f"{path}/_loading-{load}"
    if path_exists(spark, folder):
        if replay:
            return False
        raise FileExistsError(f"load {load} of {path} is finished; free_load gives an unused name")
    with hashes_packed(spark):
        if partition_by:
            shares = df if dealt else df.hint("rebalance", *partition_by)
            shares.write.format(fmt).mode("overwrite").partitionBy(*partition_by).save(hidden)
        else:
            df.write.format(fmt).mode("overwrite").save(hidden)
    if spark.read.format(fmt).schema(df.schema).load(hidden).isEmpty():
        drop_folder(spark, hidden)
        return False
    move_folder(spark, hidden, folder)
    return True


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a written table: computed once, the same on every later read."""
    return _stage(df, scratch_dir(df.sparkSession, label))


@contextmanager
def staged_while(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``staged``, for what is read within a block only: the folder is dropped after it."""
    path = scratch_dir(df.sparkSession, label)
    try:
        yield _stage(df, path)
    finally:
        drop_folder(df.sparkSession, path)


def _stage(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Target(NamedTuple):
    """Where a table is published: a path, or a connector's options. With ``versioned`` a path
    holds one folder per refresh, and :func:`read_published` reads the newest whole one."""

    path: str | None = None
    fmt: str = "parquet"
    options: Mapping[str, str] = {}
    versioned: bool = False


def _write(df: DataFrame, target: Target, path: str | None, mode: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.format(target.fmt).mode(mode).options(**target.options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def publish(
    df: DataFrame, target: Target, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    """Write ``df`` to a warehouse copy: ``overwrite`` refreshes it, ``append`` adds.

    A folder of files is refreshed by writing a hidden one beside it that takes its place
    when it is whole, so a failed write leaves the earlier rows; or, if it is versioned, by
    writing the next version beside those that readers may have open.
    """
    if target.versioned:
        if mode != "overwrite" or not target.path or target.fmt not in _FILE_FORMATS:
            raise ValueError("versions are refreshed folders of files")
        publish_version(df, target, partition_by)
    elif mode == "overwrite" and target.path and target.fmt in _FILE_FORMATS:
        replace_folder(
            df.sparkSession, target.path, lambda path: _write(df, target, path, "overwrite", partition_by)
        )
    else:
        _write(df, target, target.path, mode, partition_by)


VERSION = "version"


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions below ``path``, finished or not, the newest first."""
    names = [n.removeprefix(f"{VERSION}=") for n in subfolders(spark, path) if n.startswith(f"{VERSION}=")]
    return sorted(map(int, names), reverse=True)


def _finished(spark: SparkSession, path: str) -> list[int]:
    return [n for n in _versions(spark, path) if path_exists(spark, f"{path}/{VERSION}={n}/_SUCCESS")]


def publish_version(
    df: DataFrame, target: Target, partition_by: Sequence[str] = (), keep: int = 2
) -> int:
    """Write ``df`` as the next version of a published table; its number.

    A version counts from the moment its ``_SUCCESS`` lies in it. Nothing a reader may have
    chosen before is moved: the last ``keep`` finished versions stay, older ones and what
    failed writers left before them go.
    """
    spark, path = df.sparkSession, target.path
    number = max(_versions(spark, path), default=0) + 1
    _write(df, target, f"{path}/{VERSION}={number}", "errorifexists", partition_by)
    kept = _finished(spark, path)[:keep]
    for old in _versions(spark, path):
        if old < min(kept):
            drop_folder(spark, f"{path}/{VERSION}={old}")
    return number


def read_published(
    spark: SparkSession, target: Target, schema: T.StructType | None = None, version: int | None = None
) -> DataFrame:
    """The newest whole version of a published table, or the one with a given number."""
    found = _finished(spark, target.path)
    if not found or version is not None and version not in found:
        raise FileNotFoundError(f"no such published version of {target.path}: {version or 'any'}")
    folder = f"{target.path}/{VERSION}={found[0] if version is None else version}"
    return read_table(spark, folder, schema, target.fmt, options=target.options)


#: What a source says that does not exist yet.
_ABSENT = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def _content(rows: DataFrame) -> tuple:
    """Number of ``rows`` and what their hashes add up to, in any order; moves no row."""
    h = F.xxhash64(*rows.columns)
    low = F.pmod(h, F.lit(1 << 20))  # whose sum stays a long
    return tuple(rows.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(low)).first())


def append_once(df: DataFrame, target: Target, batch: str, column: str) -> None:
    """Append the rows of one batch to a sink without folders, each of them once.

    The sink keeps the batch's name in ``column``. What an earlier attempt has put there, all
    of the batch or a part, is left out: equal rows are counted against each other, unless their
    number and 64-bit hashes say that all of them are there. Rows must be the same at every
    attempt and hold no maps.
    """
    spark, rows = df.sparkSession, df.withColumn(column, F.lit(batch))
    reader = spark.read.format(target.fmt).options(**target.options)
    if target.fmt in _FILE_FORMATS:
        reader = reader.schema(rows.schema)
    try:
        stored = reader.load(target.path).where(F.col(column) == batch)
    except AnalysisException as error:
        if error.getCondition() not in _ABSENT:
            raise
        stored = None
    if stored is not None and not stored.isEmpty():
        same = [F.col(f.name).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
        there = stored.select(*same)
        if _content(rows) == _content(there):
            return
        rows = rows.exceptAll(there)
    publish(rows, target, mode="append")


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a hidden folder, then put it in the place of ``path``."""
    parent, _, name = path.rstrip("/").rpartition("/")
    fresh, old = f"{parent}/_fresh-{name}", f"{parent}/_old-{name}"
    if not path_exists(spark, path) and path_exists(spark, old):
        move_folder(spark, old, path)  # an earlier run ended between the two moves
    write(fresh)
    drop_folder(spark, old)
    if path_exists(spark, path):
        move_folder(spark, path, old)
    move_folder(spark, fresh, path)
    drop_folder(spark, old)
