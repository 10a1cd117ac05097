"""Profiling aggregates: pitcher statistics (A8), pairwise correlation
(A9) and distinct-value counts (A10).  One pass each."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mound.session import write_through


def _count_if(cond):
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def pitcher_stats(pitches: DataFrame, keys: Sequence[str] = ("pitcher", "pitch_type"),
                  acceleration: Sequence[str] = ("ax", "ay", "az")) -> DataFrame:
    """Per pitcher (and pitch type / hand when given).

    Where the log has the components of ``acceleration``, their average
    length over the pitches that have all of them is ``avg_acceleration``."""
    ev, ty, desc = F.col("events"), F.col("type"), F.col("description")
    pa = _count_if(ev.isNotNull())
    balls = _count_if(ty == "B")
    return pitches.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("pitches"),
        _count_if(ev == "strikeout").alias("strikeouts"),
        _count_if(ty == "S").alias("strikes"),
        balls.alias("balls"),
        _count_if(ty == "X").alias("in_play"),
        _count_if(ev == "hit_by_pitch").alias("hit_by_pitch"),
        _count_if(desc.isin("wild_pitch", "passed_ball") | (ev == "field_error")).alias("wild_pitches_errors"),
        _count_if(ev == "walk").alias("walks"),
        pa.alias("plate_appearances"),
        F.avg("release_spin_rate").alias("avg_spin_rate"),
        F.avg("release_speed").alias("avg_velocity"),
        (balls / F.when(pa > 0, pa)).alias("balls_per_pa"),
        *([F.avg(F.sqrt(sum((F.col(c) * F.col(c) for c in acceleration), F.lit(0.0)))).alias("avg_acceleration")]
          if set(acceleration) <= set(pitches.columns) else []),
    )


_MOMENTS = ("n", "mean_a", "mean_b", "var_a", "var_b", "cov", "odd")


def _co_moments(batches: Iterator[pa.RecordBatch], p: int) -> Iterator[pa.RecordBatch]:
    """Counts, means and co-moments of every pair of a partition's columns.

    Each of them is one product of matrices: values (0 where absent) and the
    0/1 matrix of what is present.  Values are taken from the first batch's
    means, so that sums of squares lose no digits to a large mean."""
    sums = shift = None
    for batch in batches:
        if not batch.num_rows:
            continue
        # a row per column: columns are copied as they lie
        there = np.stack([~np.asarray(c.is_null()) for c in batch.columns])
        x = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
        finite = there & np.isfinite(x)
        if shift is None:
            shift = np.where(finite, x, 0).sum(axis=1) / np.maximum(finite.sum(axis=1), 1)
            sums = [np.zeros((p, p)) for _ in range(5)]
        m = finite.astype(float)
        x = np.where(finite, x - shift[:, None], 0.0)
        for total, more in zip(sums, (m @ m.T, x @ m.T, (x * x) @ m.T, x @ x.T), strict=False):
            total += more
        if (there != finite).any():
            odd, every = (there & ~finite).astype(float), there.astype(float)
            sums[4] += odd @ every.T + every @ odd.T
    if sums is None:
        return
    n, s, q, product, odd = sums
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = np.where(n > 0, s / n, 0.0)
    out = {"n": n, "mean_a": mean + shift[:, None], "mean_b": mean.T + shift, "var_a": q - s * mean, "var_b": (q - s * mean).T,
           "cov": product - s * mean.T, "odd": odd}
    rows = {"a": pa.array(range(p - 1), pa.int32())}
    rows |= {k: pa.array([out[k][i, i + 1:] for i in range(p - 1)], pa.list_(pa.float64())) for k in _MOMENTS}
    yield pa.RecordBatch.from_pydict(rows)


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, melted to
    (col_a, col_b, r).  Each pair drops rows where either side is null.

    One scan, whatever the number of columns: every partition returns a row
    of co-moments for each column, and the merge works on these alone (the
    pairs' counts and means first, then the deviations from them).  ``r`` is
    null for fewer than two common rows, and not a number where a side does
    not vary or a common row holds a value that is not finite.
    """
    columns, p = list(columns), len(columns)
    spark = df.sparkSession
    if p < 2:
        return spark.createDataFrame([], "col_a string, col_b string, r double")
    # positional names, so that no column's own name matters
    doubles = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    schema = "a int, " + ", ".join(f"{k} array<double>" for k in _MOMENTS)
    parts = write_through(doubles.mapInArrow(lambda b: _co_moments(b, p), schema), "co-moments")
    pairs = parts.select("a", F.posexplode(F.arrays_zip(*_MOMENTS)).alias("at", "m")).select(
        "a", (F.col("a") + 1 + F.col("at")).alias("b"), *[F.col(f"m.{k}").alias(k) for k in _MOMENTS])
    total = pairs.groupBy("a", "b").agg(
        F.sum("n").alias("rows"), (F.sum(F.col("n") * F.col("mean_a")) / F.nullif(F.sum("n"), F.lit(0.0))).alias("mid_a"),
        (F.sum(F.col("n") * F.col("mean_b")) / F.nullif(F.sum("n"), F.lit(0.0))).alias("mid_b"), F.sum("odd").alias("odd_rows"))
    da, db = F.col("mean_a") - F.col("mid_a"), F.col("mean_b") - F.col("mid_b")
    merged = pairs.join(total, ["a", "b"]).groupBy("a", "b", "rows", "odd_rows").agg(
        F.sum(F.col("cov") + F.col("n") * da * db).alias("cov"), F.sum(F.col("var_a") + F.col("n") * da * da).alias("va"),
        F.sum(F.col("var_b") + F.col("n") * db * db).alias("vb"))
    spread = F.sqrt(F.greatest("va", F.lit(0.0))) * F.sqrt(F.greatest("vb", F.lit(0.0)))
    nan = F.lit(float("nan"))
    r = F.when(F.col("odd_rows") > 0, nan).when(F.col("rows") > 1, F.when(spread > 0, F.col("cov") / spread).otherwise(nan))
    every = spark.range(p - 1).select(F.col("id").cast("int").alias("a")).select(
        "a", F.explode(F.sequence(F.col("a") + 1, F.lit(p - 1))).alias("b"))
    names = F.array(*[F.lit(c) for c in columns])
    return every.join(merged, ["a", "b"], "left").select(
        F.get(names, F.col("a")).alias("col_a"), F.get(names, F.col("b")).alias("col_b"), r.alias("r"))


def distinct_counts(df: DataFrame, columns: Sequence[str], approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """A10: number of distinct non-null values per column, melted to
    (column_name, n_distinct).  ``approx`` uses HyperLogLog++ sketches,
    which merge map-side and need no shuffle of the values."""
    fn = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.countDistinct
    wide = df.agg(*[fn(c).alias(f"__d{i}") for i, c in enumerate(columns)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"__d{i}").cast("bigint").alias("n_distinct"))
        for i, c in enumerate(columns)
    ]))
    return wide.select(stacked.alias("s")).select("s.column_name", "s.n_distinct")


def _hashable(c: str, kind: str) -> Column:
    return F.col(c) if kind in ("int", "bigint", "string", "binary") else F.col(c).cast("string")


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: str, lg_k: int = 14) -> DataFrame:
    """A10, stored: (``by``, column_name, sketch), a HyperLogLog sketch of each
    column's non-null values per season (or any other period).

    Sketches are merged map-side and have a fixed size (2^``lg_k`` buckets at
    most), so the table has a row for each period and column.  A new season
    is appended without another look at the old ones."""
    kinds = dict(df.dtypes)
    wide = df.groupBy(by).agg(*[F.hll_sketch_agg(_hashable(c, kinds[c]), F.lit(lg_k)).alias(f"__s{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__s{i}").alias("sketch")) for i, c in enumerate(columns)])
    return wide.select(by, F.inline(rows))


def estimate_distinct(sketches: DataFrame, by: str, first: object, last: object) -> DataFrame:
    """(column_name, n_estimate) over the periods from ``first`` to ``last``, from their stored sketches alone."""
    return sketches.where(F.col(by).between(F.lit(first), F.lit(last))).groupBy("column_name").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_estimate"))
