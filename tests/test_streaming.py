import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from mound.operators import games as G
from mound.session import scratch_path
from mound.sources.fixtures import pitches
from mound.plans import queries_io as IO
from mound.streaming import incremental as ST


def test_stream_merges_partial_games_across_batches(spark):
    base = scratch_path(spark, "stream-test")
    p = pitches(spark, SF_SMALL)
    p.repartition(4, "pitch_number").write.partitionBy("pitch_number").parquet(f"{base}/src")
    schema = spark.read.parquet(f"{base}/src").schema
    q = ST.start_game_ingest(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt", schema, max_files_per_trigger=1)
    q.awaitTermination()
    batches = [d for d in os.listdir(f"{base}/out") if d.startswith("batch_id=")]
    assert len(batches) > 1
    streamed = ST.game_stats_from_partials(spark, f"{base}/out").select(*G.GAME_KEY, "total_pitches", "home_runs")
    batch = G.game_stats(p).select(*G.GAME_KEY, "total_pitches", "home_runs")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_landed_files_follow_the_size_of_the_log(spark, monkeypatch):
    """The log lands through the rebalancing sink; a batch takes two numbers' files, however many these are."""
    asked, landed = [], []
    start, write = ST.start_game_ingest, IO.SK.write_parquet
    monkeypatch.setattr(ST, "start_game_ingest", lambda *a, max_files_per_trigger: asked.append(max_files_per_trigger) or start(*a, max_files_per_trigger=max_files_per_trigger))
    # two files for each number
    monkeypatch.setattr(IO.SK, "write_parquet", lambda df, path, **k: landed.append(k["partition_by"]) or [write(df.where(F.col("game_pk") % 2 == r), path, partition_by=k["partition_by"], mode="append") for r in (0, 1)])
    got = IO.q_streaming_game_stats(spark, SF_SMALL)
    assert landed == [["pitch_number"]] and asked == [4]
    assert got.count() == pitches(spark, SF_SMALL).select(*G.GAME_KEY).distinct().count()
