import glob
import os

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidemark.sources import tables
from tidemark.sources.tables import (
    Target,
    append_load,
    append_once,
    publish,
    read_published,
    read_table,
    read_table_stream,
)
from tidemark.streaming import read_batches, run_foreach_batch, run_incremental
from tidemark.streaming.runs import SIDE_BY_SIDE, WRITERS, write_batch

SCHEMA = "k string, v int"


def rows(spark, *vs):
    return spark.createDataFrame([(f"k{v % 2}", v) for v in vs], SCHEMA)


def values(df):
    return sorted(r.v for r in df.collect())


def plus(df):
    return df.select("k", (F.col("v") + 100).alias("v"))


def test_incremental_runs_take_each_row_once(spark, folder):
    source, target = f"{folder}/in", f"{folder}/out"

    def run():
        stream = read_table_stream(spark, source, rows(spark).schema)
        run_incremental(stream, plus, target)
        return values(read_table(spark, target))

    append_load(rows(spark, 1, 2), source, "1")
    assert run() == [101, 102]
    assert run() == [101, 102]
    append_load(rows(spark, 3), source, "2")
    assert run() == [101, 102, 103]
    assert read_table(spark, target).columns == ["k", "v"]


def test_batches_reach_every_sink_once(spark, folder):
    source, gold, copy = f"{folder}/in", f"{folder}/gold", Target(f"{folder}/copy")
    schema = rows(spark).schema

    def run(checkpoint=None):
        stream = read_table_stream(spark, source, schema, max_files_per_trigger=1)
        run_foreach_batch(stream, plus, gold, checkpoint, copies=[copy], partition_by=["k"])
        both = values(read_batches(spark, gold, schema)), values(read_batches(spark, copy.path, schema))
        assert both[0] == both[1]
        return both[0]

    append_load(rows(spark, 1, 2).coalesce(1), source, "1")
    append_load(rows(spark, 3, 4).coalesce(1), source, "2")
    assert run() == [101, 102, 103, 104]
    assert len(glob.glob(f"{gold}/batch_id=*")) == 2
    assert run() == [101, 102, 103, 104]
    append_load(rows(spark, 5), source, "3")
    assert run() == [101, 102, 103, 104, 105]
    # a new checkpoint starts over at batch 0 without replacing what others wrote
    assert run(f"{folder}/other") == sorted([101, 102, 103, 104, 105] * 2)


def test_a_repeated_batch_replaces_itself_in_every_sink(spark, folder):
    gold, copy = f"{folder}/gold", Target(f"{folder}/copy")
    schema = rows(spark).schema
    write_batch(rows(spark, 1, 2), "q-0", gold)  # failed before the second sink
    write_batch(rows(spark, 1, 2), "q-0", gold, [copy])
    write_batch(rows(spark, 1, 2), "q-0", gold, [copy])
    write_batch(rows(spark, 3), "q-1", gold, [copy])
    for path in (gold, copy.path):
        assert values(read_batches(spark, path, schema)) == [1, 2, 3]


def test_fact_folders_let_queries_skip_other_metrics(spark, folder):
    write_batch(rows(spark, 1, 2, 3), "q-0", folder, partition_by=["k"])
    df = read_batches(spark, folder, rows(spark).schema).filter("k = 'k1'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan
    assert values(df) == [1, 3]


def test_a_sink_without_folders_gets_each_row_once(spark, folder):
    sink = Target(options={"path": f"{folder}/sink"})
    first = rows(spark, 1, 2, 2)  # equal rows are rows of their own

    def stored():
        return values(spark.read.parquet(f"{folder}/sink"))

    for _ in range(2):
        write_batch(first, "q-0", f"{folder}/gold", [sink])
        assert stored() == [1, 2, 2]
    # an attempt that put half of the batch there
    publish(rows(spark, 2, 7).withColumn("batch_id", F.lit("q-1")), sink, mode="append")
    write_batch(rows(spark, 2, 2, 7, 8), "q-1", f"{folder}/gold", [sink])
    assert stored() == sorted([1, 2, 2, 2, 2, 7, 8])
    write_batch(rows(spark, 2), "q-2", f"{folder}/gold", [sink])
    assert stored() == sorted([1, 2, 2, 2, 2, 7, 8, 2])


def test_a_sink_that_cannot_be_read_is_no_empty_one(spark, folder):
    sink = Target(fmt="no_such_format", options={"path": f"{folder}/sink"})
    with pytest.raises(Exception, match="no_such_format"):
        append_once(rows(spark, 1), sink, "q-0", "batch_id")


def test_readers_of_versions_always_see_a_whole_table(spark, folder, monkeypatch):
    target, seen = Target(f"{folder}/dim", versioned=True), []
    publish(rows(spark, 1, 2), target)

    def looking(function):
        def run(*args, **options):
            seen.append(values(read_published(spark, target)))
            out = function(*args, **options)
            seen.append(values(read_published(spark, target)))
            return out

        return run

    for name in ("_write", "drop_folder"):
        monkeypatch.setattr(tables, name, looking(getattr(tables, name)))
    for n in range(3, 7):
        publish(rows(spark, n), target)
    assert seen and {tuple(s) for s in seen} == {(1, 2), (3,), (4,), (5,), (6,)}
    assert sorted(os.listdir(target.path)) == ["version=4", "version=5"]
    assert values(read_published(spark, target, version=4)) == [5]
    with pytest.raises(FileNotFoundError):
        read_published(spark, target, version=1)


def test_a_reader_keeps_the_version_it_opened(spark, folder):
    target = Target(f"{folder}/dim", versioned=True)
    publish(rows(spark, 1), target)
    opened = read_published(spark, target)
    publish(rows(spark, 2), target)
    assert values(opened) == [1] and values(read_published(spark, target)) == [2]
    # a failed refresh leaves the newest whole version, and its remains go later
    broken = rows(spark, 3).withColumn("k", F.raise_error("no").cast("string"))
    with pytest.raises(Exception):
        publish(broken, target)
    assert values(read_published(spark, target)) == [2]
    for v in (4, 5, 6):
        publish(rows(spark, v), target)
    assert len(os.listdir(target.path)) == 2 and values(read_published(spark, target)) == [6]
    with pytest.raises(ValueError):
        publish(rows(spark, 1), target, mode="append")
    with pytest.raises(FileNotFoundError):
        read_published(spark, Target(f"{folder}/none", versioned=True))


@pytest.mark.parametrize("named", [None, "2"])
def test_folders_are_written_without_sorting_their_rows(spark, folder, monkeypatch, named):
    seen, save = [], DataFrameWriter.save

    def spy(writer, *args, **kwargs):
        seen.append(spark.conf.get(WRITERS))
        return save(writer, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "save", spy)
    rows = spark.range(4000).selectExpr("id", "concat('m', id % 20) MetricName").coalesce(1)
    if named:
        spark.conf.set(WRITERS, named)
    try:
        write_batch(rows, "b", f"{folder}/fact", partition_by=["MetricName"])
        assert spark.conf.get(WRITERS, None) == named
    finally:
        spark.conf.unset(WRITERS)
    assert seen == [named or str(SIDE_BY_SIDE)]
    # more folders than are open at once
    stored = spark.read.parquet(f"{folder}/fact").groupBy("MetricName").agg(F.count("id"), F.sum("id"))
    expected = rows.groupBy("MetricName").agg(F.count("id"), F.sum("id"))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, expected.collect()))
