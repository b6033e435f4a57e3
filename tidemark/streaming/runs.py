"""Run-to-completion streams over layer tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.session import hashes_packed, set_while
from tidemark.sources.tables import Target, append_once, publish, replace_folder

BATCH = "batch_id"

#: Folders that a task writes side by side. Spark's default is to sort a task's rows by folder
#: first, which puts them on disk once more where they do not fit into memory.
SIDE_BY_SIDE, WRITERS = 16, "spark.sql.maxConcurrentOutputFileWriters"
#: Bytes of a row group in such folders: a task keeps one in memory for each of them.
ROW_GROUP = 32 << 20

Transform = Callable[[DataFrame], DataFrame]


def run_incremental(
    source: DataFrame,
    transform: Transform,
    path: str,
    checkpoint: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Append ``transform`` of all new rows of a streaming ``source`` to ``path``.

    The checkpoint lies in a hidden folder of the table unless given.
    """
    writer = (
        transform(source)
        .writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint or f"{path}/_checkpoints")
        .trigger(availableNow=True)
    )
    # a file sink takes its settings from the session that starts it, not from options
    with hashes_packed(source.sparkSession):
        query = writer.start(path)
    query.awaitTermination()


def write_batch(
    batch: DataFrame,
    batch_id: str,
    path: str,
    copies: Sequence[Target] = (),
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Write one micro-batch to its own folder and from there to every copy.

    Writing the same batch again replaces it everywhere; a copy without folders gets its
    name in a column and only the rows it lacks. The copies read the
    written folder, so the batch is computed once and all sinks hold the same
    rows without caching a batch that may be large. A batch is seen when it is whole:
    it is written to a hidden folder that then takes its place.
    """
    spark, folder = batch.sparkSession, f"{path}/{BATCH}={batch_id}"

    def write(hidden: str) -> None:
        # static: the whole folder is replaced whatever the session's default is
        writer = batch.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
        if not partition_by:
            writer.save(hidden)
            return
        if fmt == "parquet":
            writer = writer.option("parquet.block.size", ROW_GROUP)
        with set_while(spark, WRITERS, str(SIDE_BY_SIDE)):
            writer.partitionBy(*partition_by).save(hidden)

    with hashes_packed(spark):
        replace_folder(spark, folder, write)
        for copy in copies:
            stored = spark.read.format(fmt).schema(batch.schema).load(folder)
            if copy.path is None:
                append_once(stored, copy, batch_id, BATCH)  # a connector without folders
            else:
                part = copy._replace(path=f"{copy.path}/{BATCH}={batch_id}")
                publish(stored, part, mode="overwrite")


def run_each(
    source: DataFrame, handle: Callable[[DataFrame, str], object], checkpoint: str
) -> int:
    """Hand all new rows of a streaming ``source`` to ``handle``, batch by batch, with the
    batch's name; the number of rows read.

    A batch that was handed over but not noted as done comes again with the same name and
    rows. Names carry the query's id, which lives in the checkpoint: a new checkpoint counts
    from zero again and must not repeat older names.
    """

    def each(batch: DataFrame, epoch: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query_id:
            raise RuntimeError("the stream does not say its query id, which names its batches")
        handle(batch, f"{query_id}-{epoch}")

    query = (
        source.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(progress["numInputRows"] for progress in query.recentProgress)


def run_foreach_batch(
    source: DataFrame,
    transform: Transform,
    path: str,
    checkpoint: str | None = None,
    copies: Sequence[Target] = (),
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Write ``transform`` of all new rows of ``source`` batch by batch to several sinks."""
    run_each(
        transform(source),
        lambda batch, name: write_batch(batch, name, path, copies, partition_by, fmt),
        checkpoint or f"{path}/_checkpoints",
    )


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """All rows of a table written batch by batch."""
    return spark.read.format(fmt).schema(schema).load(path).select(*schema.fieldNames())
