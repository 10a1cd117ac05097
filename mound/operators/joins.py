"""Joins against tables that are usually small but not small by definition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from mound.session import write_through


def join_small(big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join ``big`` with ``small``, which Spark broadcasts if its bytes allow it.

    ``small`` (an aggregate, a dictionary, a roster) is written once and read
    back, so its size is the size of the files: at most
    ``spark.sql.autoBroadcastJoinThreshold`` bytes are broadcast, and ``big``
    is then joined where it lies, however its keys are skewed.  A larger
    ``small`` takes a shuffle join, which AQE may split for skew.  The rows
    are the same either way, and ``small`` is computed once.
    """
    return big.join(write_through(small, "small-side"), on, how)
