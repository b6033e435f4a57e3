"""Session factory and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import ExitStack, contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
PARQUET_CODEC = "spark.sql.parquet.compression.codec"

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # noting the caller's line for every column expression doubles the time to build a plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def start_session(
    app_name: str,
    master: str | None = None,
    settings: Mapping[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with UTC pinned; ``settings`` win over the defaults.

    Table-format extensions and catalogs are passed through ``settings``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Make day keys and clock times independent of the host's time zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def pack_tables(spark: SparkSession) -> SparkSession:
    """Write Parquet in zstd unless the session names a codec: row hashes, the larger part of
    most tables here, are text that Spark's default leaves at two bytes for each byte hashed."""
    if spark.conf.get(PARQUET_CODEC, None) is None:
        spark.conf.set(PARQUET_CODEC, "zstd")
    return spark


@contextmanager
def set_while(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting for what is done within a block, unless the session names it."""
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key)


#: How row hashes come closest to the 32 bytes that a SHA-256 holds: text is stored without a
#: length before each value, and compressed at a level that does not take chance repeats among
#: hex digits for matches, which cost more than they save.
HASH_PACKING = {"parquet.writer.version": "PARQUET_2_0", "parquet.compression.codec.zstd.level": "2"}


@contextmanager
def hashes_packed(spark: SparkSession) -> Iterator[None]:
    """``HASH_PACKING`` for the Parquet tables written within a block, save what the session or
    the cluster names."""
    named = spark._jsparkSession.sessionState().newHadoopConf()
    with ExitStack() as block:
        for key, value in HASH_PACKING.items():
            if named.get(key) is None:
                block.enter_context(set_while(spark, key, value))
        yield


@lru_cache(maxsize=1)
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared folder the cluster names.

    Only a local session without that setting falls back to a temporary folder
    of this machine, since executors elsewhere could not read it.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder all executors can reach")
        base = _local_base()
    return f"{base.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"
