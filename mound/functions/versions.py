"""Dictionaries that stay the same when a season is added.

A stored dictionary is a Parquet table (column, value, code) with a folder
for each version.  A version only adds: values that no earlier version has
get the codes behind the largest so far, in their order.  So a code once
given never changes, and features encoded in different seasons agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mound.functions.encode import dense_indexes
from mound.operators.joins import join_small
from mound.session import path_exists, write_through

SCHEMA = "column string, value string, code int, version int"


def new_codes(df: DataFrame, columns: Sequence[str], known: DataFrame) -> DataFrame:
    """(column, value, code) of the listed columns' non-null values, as text,
    that ``known`` (column, value, code) lacks: dense numbers from behind its
    largest code of the column (from 0 where it has none)."""
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    pairs = text.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in columns])))
    pairs = pairs.where("value is not null").distinct()
    added = write_through(pairs.join(known.select("column", "value"), ["column", "value"], "left_anti"), "new-codes")
    # the values of each column in one table of columns, so that one pass numbers them all
    wide = added.select(*[F.when(F.col("column") == c, F.col("value")).alias(c) for c in columns])
    numbered = dense_indexes(wide, list(columns))
    after = known.groupBy("column").agg((F.max("code") + 1).alias("after"))  # a row per column
    return numbered.join(F.broadcast(after), "column", "left").select(
        "column", "value", (F.col("index") + F.coalesce("after", F.lit(0))).cast("int").alias("code"))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """The stored dictionary: (column, value, code, version)."""
    return spark.read.schema(SCHEMA).parquet(path)


def append_version(df: DataFrame, columns: Sequence[str], path: str, version: int) -> DataFrame:
    """Add the values of ``df`` that the dictionary at ``path`` lacks as version ``version``; return the dictionary up to it.

    Earlier versions' files are not touched.  Repeating a version writes its
    folder anew, with the same codes for the same rows; a version below the
    latest is refused, as later codes build on it.
    """
    spark = df.sparkSession
    known = spark.createDataFrame([], SCHEMA)
    if path_exists(spark, path):
        known = read_dictionary(spark, path)
        latest = known.agg(F.max("version")).first()[0]
        if latest is not None and latest > version:
            raise ValueError(f"the dictionary is at version {latest} already")
        known = known.where(F.col("version") < version)
    added = write_through(new_codes(df, columns, known).withColumn("version", F.lit(version)), "dictionary-version")
    added.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(path)
    return read_dictionary(spark, path)


def encode_with_dictionary(df: DataFrame, columns: Sequence[str], dictionary: DataFrame, suffix: str = "_index") -> DataFrame:
    """P19 with a stored dictionary: each listed column's code; null for null and for unknown values."""
    out = df
    for c in columns:
        codes = dictionary.where(F.col("column") == c).select(F.col("value").alias("__text"), F.col("code").alias(f"{c}{suffix}"))
        out = join_small(out.withColumn("__text", F.col(f"`{c}`").cast("string")), codes, "__text").drop("__text")
    return out.select(*df.columns, *[f"{c}{suffix}" for c in columns])
