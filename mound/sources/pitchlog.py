"""Pitch-log and CSV sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mound.functions.encode import load_dictionary
from mound.schemas import PITCH_SCHEMA, PLAYER_MAP_SCHEMA, require_columns


def read_pitch_log(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = PITCH_SCHEMA,
                   merge_schema: bool = False) -> DataFrame:
    """One season file, several files, or a glob / partitioned
    folder.  With a declared schema no footer is inferred and a column
    absent from an older season's files reads as null; without one,
    ``merge_schema`` unions the files' own schemas."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    elif merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.parquet(*paths)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, header: bool = True,
             **options: str) -> DataFrame:
    """S3: CSV with a declared schema (never inferred)."""
    reader = spark.read.schema(schema).option("header", str(header).lower())
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path if isinstance(path, str) else list(path))


def read_player_map(spark: SparkSession, path: str) -> DataFrame:
    """A ``code,name`` dictionary from CSV, one row per code; of repeated
    codes the last line wins.

    The header must name both columns (P16); they may stand in any order,
    beside others.  A line's place is its file, the file's block and the row
    number within the block's task, so a retried task orders lines alike.
    """
    rows = spark.read.option("header", "true").csv(path)
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    names = PLAYER_MAP_SCHEMA.fieldNames()
    rows = require_columns(rows, names, "player map").select(*names, place.alias("place"))
    return load_dictionary(rows, order="place")


def register_view(df: DataFrame, name: str = "pitch_log") -> DataFrame:
    """Make a DataFrame available to SQL text under ``name``."""
    df.createOrReplaceTempView(name)
    return df
