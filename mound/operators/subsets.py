"""Preview (L1) and row-limited subsets for size-up studies (L2).

Both take an explicit total order, so the rows returned do not depend on
partitioning.  ``orderBy(...).limit(n)`` plans as a per-partition top-n
followed by a merge of n rows per partition (TakeOrderedAndProject):
no full sort of the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mound.session import write_through


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def size_subset(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """L2: the first ``n`` rows in ascending ``order`` (nulls first).

    The first order column is counted by value; as a value holds at least one
    row, its ``n`` smallest values tell where the ``n``-th row lies.  Only
    rows up to that value are read for the top-n, as a filter on the scan, so
    the partitions together send ``n`` rows plus those of the last value to
    the merge, not ``n`` rows each.  Both read ``df`` as it was written once:
    what it takes to make its rows (joins of the log) is not done twice.
    """
    if n <= 0:
        return df.limit(0)
    df = write_through(df, "subset-rows")
    key = F.col(order[0])
    heads = df.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("rows")).orderBy("k").limit(n)
    before = F.sum("rows").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1))
    last = heads.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < n).agg(F.max("k").alias("k")).first()["k"]
    reached = key.isNull() if last is None else key.isNull() | (key <= F.lit(last))
    return df.where(reached).orderBy(*order).limit(n)




#: Hexadecimal digits of a histogram: at most 65,536 counts come to the driver.
_DIGITS = 4
#: Rows that may be sorted to settle the last few.
_SETTLE = 10_000


def random_subset(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """L2, at random: exactly ``n`` rows (all, if fewer), those of the smallest hashes.

    A row's hash is the MD5 of the seed and all its columns' texts, so the
    subset does not depend on files, partitions or the order of rows.
    Histograms over the hash's leading digits find the value below which all
    rows belong to it; only rows that agree in the digits looked at so far
    are counted again.  Few rows are left to sort, or equal rows, of which
    the missing number is made from one.  Null columns count as such.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N")) for c in df.columns])
    keyed = df.withColumn("__hash", F.md5(text))
    prefix, left = "", n
    while True:
        inside = keyed.where(F.col("__hash").startswith(prefix))
        digits = F.substr("__hash", F.lit(len(prefix) + 1), F.lit(_DIGITS))
        counts = sorted((r["d"], r["c"]) for r in inside.groupBy(digits.alias("d")).agg(F.count(F.lit(1)).alias("c")).collect())
        for digit, count in counts:
            if left <= count:
                break
            left -= count
        else:  # no more rows than asked for
            return df
        prefix += digit
        if count <= _SETTLE or len(prefix) == 32:
            break
    below = keyed.where(F.col("__hash") < prefix)
    last = keyed.where(F.col("__hash").startswith(prefix))
    if count > _SETTLE:  # rows with one hash are equal: as many as are missing of the first
        step = 1_000_000
        starts = F.sequence(F.lit(0), F.lit(max(left - 1, 0)), F.lit(step))
        parts = last.limit(1).withColumn("__at", F.explode(starts)).repartition(F.col("__at")).where(F.lit(left > 0))
        last = parts.withColumn("__i", F.explode(F.sequence(F.col("__at"), F.least(F.col("__at") + step, F.lit(left)) - 1)))
        return below.drop("__hash").unionByName(last.drop("__hash", "__at", "__i"))
    return below.unionByName(last.orderBy("__hash").limit(left)).drop("__hash")
