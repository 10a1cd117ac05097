"""Incremental game table from newly arriving pitch-log files.

New files (a day, a season, a re-scrape) land in a folder.  A file-source
stream picks them up; each micro-batch is reduced to *mergeable* game
partials -- sums, counts and maxima, never averages -- and written to its
own ``batch_id=<n>`` folder with mode ``overwrite``.  A replayed batch
(after a driver or executor failure, the checkpoint decides which batch
to rerun) rewrites the same folder, so the output is exactly-once without
a transactional table format.  There is no streaming state store: a game
whose pitches arrive over several batches simply has several partial rows,
and ``game_stats_from_partials`` merges them with one more aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mound.operators.games import GAME_KEY


def _count_if(cond):
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def mergeable_game_partials(pitches: DataFrame, keys: Sequence[str] = GAME_KEY) -> DataFrame:
    bot = F.col("inning_topbot") == "Bot"
    top = F.col("inning_topbot") == "Top"
    so = F.col("events") == "strikeout"
    return pitches.groupBy(*keys).agg(
        F.max("home_score").alias("home_score"),
        F.max("away_score").alias("away_score"),
        F.count(F.lit(1)).alias("total_pitches"),
        _count_if(so & bot).alias("home_strikeouts"),
        _count_if(so & top).alias("away_strikeouts"),
        F.sum("launch_speed").alias("sum_launch_speed"),
        F.count("launch_speed").alias("n_launch_speed"),
        F.sum("launch_angle").alias("sum_launch_angle"),
        F.count("launch_angle").alias("n_launch_angle"),
        _count_if(F.col("events") == "home_run").alias("home_runs"),
    )


def start_game_ingest(spark: SparkSession, source: str, target: str, checkpoint: str, schema: T.StructType,
                      max_files_per_trigger: int = 8, available_now: bool = True) -> StreamingQuery:
    """Start the stream.  ``available_now`` processes what is there (in
    several batches) and stops; otherwise it keeps polling."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        mergeable_game_partials(batch).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def game_stats_from_partials(spark: SparkSession, target: str, keys: Sequence[str] = GAME_KEY) -> DataFrame:
    """The current game table (A3 columns): merge the partial rows of every
    batch.  Partial aggregation before the shuffle keeps this cheap even
    when a game's pitches arrived in many batches."""
    p = spark.read.parquet(target)
    return p.groupBy(*keys).agg(
        F.max("home_score").alias("home_score"),
        F.max("away_score").alias("away_score"),
        F.sum("total_pitches").cast("bigint").alias("total_pitches"),
        F.sum("home_strikeouts").cast("bigint").alias("home_strikeouts"),
        F.sum("away_strikeouts").cast("bigint").alias("away_strikeouts"),
        (F.sum("sum_launch_speed") / F.sum("n_launch_speed")).alias("avg_exit_velocity"),
        (F.sum("sum_launch_angle") / F.sum("n_launch_angle")).alias("avg_launch_angle"),
        F.sum("home_runs").cast("bigint").alias("home_runs"),
    )
