"""Sinks (S6-S8).  Writers are plain DataFrameWriter calls; each task
writes its own files, so a lost executor only re-runs its tasks and the
job commit protocol keeps half-written files out of the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mound.session import path_exists, write_through


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = True) -> None:
    """CSV with a header line and no index column."""
    df.write.mode(mode).option("header", str(header).lower()).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Parquet, optionally one folder per season (partition pruning on read).

    Rows are rebalanced by season first: adaptive execution splits a large
    season and joins small ones by bytes, so a folder gets as many files as
    its size asks for, not one from every task."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_if_absent(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """Keep an existing dataset; write only when ``path`` is absent."""
    w = df.write.mode("ignore").format(fmt)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)


def replace_seasons(new: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], partition: str = "season",
                    keep: bool = False) -> None:
    """Replace the seasons that ``new`` holds in the table at ``path``,
    and no other's files.

    Of rows with the same ``keys`` (a game and pitch), the one largest in
    ``order`` (a load number or time) stays; rows equal in that too are
    decided by their other columns, so a repeated or retried load writes the
    same rows again.  With ``keep``, rows of these seasons that ``new`` does
    not replace stay; a stored row gives way to an equal key of ``new`` unless
    it is larger in ``order``.

    The rows are written in full beside the table first, so a job that fails
    has touched nothing, and then overwrite only their own season's folders
    (dynamic partition overwrite).
    """
    spark = new.sparkSession
    if path_exists(spark, path):
        stored = spark.read.parquet(path)
        if set(stored.columns) != set(new.columns):
            raise ValueError(f"columns differ from the stored table's: {sorted(set(stored.columns) ^ set(new.columns))}")
        if keep:
            touched = new.select(partition).distinct()
            new = new.unionByName(stored.join(F.broadcast(touched), partition, "left_semi").select(*new.columns))  # a row per season
    rest = [c for c in new.columns if c not in {partition, *keys, *order}]
    row = F.struct(*order, *rest)
    latest = new.groupBy(partition, *keys).agg(F.max(row).alias("r")).select(partition, *keys, "r.*").select(*new.columns)
    staged = write_through(latest, "season-replacement")
    staged.hint("rebalance", F.col(partition)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, by: Sequence[str], sort_by: Sequence[str] = (), buckets: int = 200) -> DataFrame:
    """Store ``df`` as ``table``, in buckets by ``by`` and sorted within; returns the stored table.

    Rows are dealt to the buckets before the write, so each has one file.
    Aggregates, windows and joins whose keys include ``by`` then need no
    shuffle: the scan of a bucket is their partition.  The number of buckets
    is the parallelism of such a query, so take it by the data (files of some
    hundred MB) and ``by`` without a value that holds many rows."""
    w = df.repartition(buckets, *[F.col(c) for c in by]).write.mode("overwrite").option("path", path).bucketBy(buckets, *by)
    if sort_by:
        w = w.sortBy(*sort_by)
    w.saveAsTable(table)
    return df.sparkSession.table(table)
