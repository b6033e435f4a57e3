"""Small helpers that the operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

import tidemark

#: Characters of text that a Python task works on at a time.
SLICE_CHARS = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One of the given tables, narrowed to ``columns``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def ship(spark: SparkSession) -> None:
    """Hand this package's source to the executors, once for each Spark context.

    The archive is what the driver uploads; Spark's own file server distributes it.
    """
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    package = Path(tidemark.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="tidemark-source-"), "tidemark-source.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tidemark_shipped = True


_in_use: list[Callable] = []


def turn_to(cached: Callable | None) -> None:
    """A Python worker that turns to another operator frees what it keeps for the last one;
    ``cached`` is the ``lru_cache`` that the new one keeps from task to task, if any."""
    for other in [c for c in _in_use if c is not cached]:
        other.cache_clear()
        _in_use.remove(other)
    if cached is not None and cached not in _in_use:
        _in_use.append(cached)


def map_arrow(df: DataFrame, run: Callable, schema, cached: Callable | None = None) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the tasks; see ``turn_to`` for ``cached``."""
    ship(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to(cached)
        yield from run(batches)

    return df.mapInArrow(task, schema)


def labelled_sample(docs: DataFrame, labelled: DataFrame, key: str, most: int) -> DataFrame:
    """Rows of ``docs`` for at most ``most`` keys of ``labelled``.

    The keys with the smallest hashes are taken, so the sample does not depend on row
    order; only its keys, a number bounded by ``most``, are broadcast.
    """
    ids = (
        labelled.select(labelled[key])
        .where(F.col(key).isNotNull())
        .distinct()
        .orderBy(F.xxhash64(key), key)
        .limit(most)
    )
    return docs.join(F.broadcast(ids), key, "left_semi")


def slices(texts: Sequence[str], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of ``texts`` of about ``most`` characters; never empty ones."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def map_texts(
    df: DataFrame,
    key: str,
    text: str,
    schema: str,
    make: Callable[[], Callable[[list, list[str]], dict[str, list]]],
    keep: Sequence[str] = (),
    cached: Callable | None = None,
) -> DataFrame:
    """``key``, then the columns of ``schema``, from (keys, texts) in slices of bounded size,
    then ``keep``, columns handed on as they are.

    ``make`` is called once in each task and returns the function of (keys, texts) that
    gives the columns, ``key`` among them. Null texts arrive as empty ones. See ``turn_to`` for
    ``cached``.
    """
    kinds = [f"`{name}` {df.schema[name].dataType.simpleString()}" for name in (key, *keep)]
    source = df.select(df[key], df[text].cast("string").alias("_text"), *(df[name] for name in keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for begin, end in slices(texts):
                columns = work(keys[begin:end], texts[begin:end])
                for n, name in enumerate(keep, 2):
                    columns[name] = batch.column(n).slice(begin, end - begin)
                yield pa.RecordBatch.from_pydict(columns, schema=arrow)

    spark_schema = _parse_datatype_string(", ".join([kinds[0], schema, *kinds[1:]]))
    arrow = to_arrow_schema(spark_schema)
    return map_arrow(source, run, spark_schema, cached)
