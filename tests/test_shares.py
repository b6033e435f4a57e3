"""Volume: packed landing, one move of new rows, bounded slices, repeated appends."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import month_text
from tidemark.operators import incremental, ranking
from tidemark.operators.incremental import new_in_shares, only_new
from tidemark.session import PARQUET_CODEC, pack_tables
from tidemark.sources.landed import open_batches, read_landed, to_envelopes, write_landed
from tidemark.sources.tables import Target, append_once, staged_while

BATCH = "20240101_000000+0000"


def test_landed_files_are_packed_and_grow_by_plain_ones(spark, folder):
    rows = spark.range(3000).select(F.concat(F.lit("s"), F.col("id") % 7).alias("station_geohash"), F.col("id").alias("visibility"))
    path = write_landed(to_envelopes(rows, "station_geohash", BATCH, max_elements=10), folder, BATCH)
    names = [n for n in os.listdir(path) if n.startswith("part-")]
    assert names and all(n.endswith(".json.gz") for n in names)

    def found():
        (batch,) = open_batches(spark, folder, f"{folder}-out")
        landed = read_landed(spark, batch.source, schemas.LANDED_OBSERVATION)
        return landed.select(F.explode("data.visibility").alias("v"))

    assert found().count() == found().distinct().count() == 3000
    more = rows.select("station_geohash", F.col("visibility") + 3000)
    more.select("station_geohash", F.lit(BATCH).alias("extracted_at"), F.array(F.struct(F.col("(visibility + 3000)").alias("visibility"))).alias("data")).write.mode("append").json(path)
    assert found().count() == found().distinct().count() == 6000


@pytest.mark.parametrize("share", [30, 1000])
def test_new_in_shares_equals_only_new(spark, folder, monkeypatch, share):
    monkeypatch.setattr(incremental, "DEALT_ROWS", share)
    day = F.concat(F.lit("2024-0"), F.col("id") % 5 + 1, F.lit("-01T00:00:00Z"))
    rows = spark.range(900).select(
        F.when(F.col("id") % 11 > 0, F.col("id") % 37).cast("string").alias("k"),
        F.when(F.col("id") % 13 > 0, day).alias("t"),
        F.col("id").alias("v"),
    )
    with staged_while(rows, "rows") as batch:
        stored = batch.filter("v % 3 = 0").withColumn("m", month_text("t"))
        for existing in (None, stored):
            found = new_in_shares(batch, existing, ["k", "t"], ["v"], month_text("t"), "m")
            plain = only_new(batch, stored.limit(0) if existing is None else stored, ["k", "t"], ["v"])
            assert sorted(found.drop("m").collect(), key=str) == sorted(plain.collect(), key=str)
            assert found.filter(~F.col("m").eqNullSafe(month_text("t"))).isEmpty()
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1
        # one key with most rows is left to the way that thins out before it moves anything
        hot = batch.unionByName(batch.limit(1).crossJoin(spark.range(2000)).drop("id"))
        assert new_in_shares(hot, None, ["k", "t"], ["v"], month_text("t"), "m") is None


def test_a_task_sorts_few_shares_of_a_large_batch(spark, monkeypatch):
    monkeypatch.setattr(incremental, "DEALT_ROWS", 100)
    rows = spark.range(4000).select(F.col("id").cast("string").alias("k"), F.lit("2024-01-01T00:00:00Z").alias("t"))
    with staged_while(rows, "large") as batch:
        found = new_in_shares(batch, None, ["k", "t"], [], month_text("t"), "m")
        of_task = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    # 40 shares; put together by size they would be one task's
    assert sum(of_task) == 4000 and max(of_task) < 800


def test_staged_rows_leave_with_their_block(spark):
    with staged_while(spark.range(5), "gone") as rows:
        (path, *_) = rows.inputFiles()
        assert rows.count() == 5
    assert not os.path.exists(os.path.dirname(path.removeprefix("file://")))


def test_a_named_codec_stays(spark):
    try:
        spark.conf.set(PARQUET_CODEC, "gzip")
        assert pack_tables(spark).conf.get(PARQUET_CODEC) == "gzip"
        spark.conf.unset(PARQUET_CODEC)
        assert pack_tables(spark).conf.get(PARQUET_CODEC) == "zstd"
    finally:
        spark.conf.unset(PARQUET_CODEC)


def test_slices_do_not_grow_with_the_group(spark, monkeypatch):
    rows = spark.range(3000).select(F.lit("g").alias("g"), F.expr("id * 7919 % 1000").cast("double").alias("v"))
    made = []
    kept = ranking.staged
    monkeypatch.setattr(ranking, "staged", lambda df, label: made.append(kept(df, label)) or made[-1])
    sliced = ranking.rank_desc(rows, "g", "v", 3000, task_rows=3)
    assert len(made[1].first()._limits) < ranking.MOST_SLICES
    plain = ranking.rank_desc(rows, "g", "v", 3000)
    assert sorted(sliced.collect()) == sorted(plain.collect())


def test_a_whole_batch_handed_in_again_is_not_matched_row_by_row(spark, folder, monkeypatch):
    sink = Target(options={"path": f"{folder}/sink"})
    rows = spark.range(50).select((F.col("id") % 20).alias("k"), F.lit(None).cast("string").alias("t"))
    append_once(rows, sink, "a", "batch")
    read = lambda: sorted(spark.read.parquet(f"{folder}/sink").collect(), key=str)
    before = read()
    matched = []
    kept = type(rows).exceptAll
    monkeypatch.setattr(type(rows), "exceptAll", lambda a, b: matched.append(1) or kept(a, b))
    append_once(rows.repartition(3), sink, "a", "batch")
    assert read() == before and not matched
    # as many rows as the batch, but one of them twice and another not there
    torn = rows.filter("k > 0").unionByName(rows.filter("k = 1")).withColumn("batch", F.lit("b"))
    torn.write.mode("append").parquet(f"{folder}/sink")
    append_once(rows, sink, "b", "batch")
    assert matched and len([r for r in read() if r.batch == "b" and r.k == 0]) == 3
