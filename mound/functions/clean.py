"""Row cleaning and scalar expressions.

All of these are projections: they add no shuffle and stay inside one
whole-stage-codegen span with the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mound.dictionaries import IN_PLAY_OUTCOMES, TYPE_INDEX
from mound.schemas import require_columns


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop listed columns; names that are absent are ignored."""
    return df.drop(*[n for n in names])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename; absent names are ignored like ``withColumnsRenamed``."""
    return df.withColumnsRenamed(dict(mapping))


def select_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """P3 with the P16 guard: fail at plan time on a missing column."""
    names = list(names)
    require_columns(df, names, "selection")
    return df.select(*names)


def date_to_string(c: str | Column) -> Column:
    """P5."""
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def string_to_date(c: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Unparseable strings give null instead of failing the job."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_date(col, fmt)


def day_of_week(d: str | Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(F.col(d) if isinstance(d, str) else d)


def date_key(d: str | Column) -> Column:
    """Date -> integer yyyymmdd."""
    col = F.col(d) if isinstance(d, str) else d
    return F.date_format(col, "yyyyMMdd").cast("int")


def home_win(home_score: str = "home_score", away_score: str = "away_score", nulls: str = "null") -> Column:
    """Binary label.

    ``nulls='null'`` keeps a null when either score is null (comparison
    cast); ``nulls='zero'`` maps it to 0 (``when/otherwise``).
    """
    gt = F.col(home_score) > F.col(away_score)
    if nulls == "null":
        return gt.cast("int")
    if nulls == "zero":
        return F.when(gt, 1).otherwise(0)
    raise ValueError(f"unknown null rule {nulls!r}")


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Per-column null fill; columns that are absent are skipped.

    ``na.fill`` only fills columns whose type matches the value, so a
    string column with a numeric default must be encoded first (P11).
    """
    present = {k: v for k, v in defaults.items() if k in df.columns}
    return df.na.fill(present) if present else df


def pitch_result(events: str = "events", description: str = "description") -> Column:
    """Merge the plate-appearance outcome and the pitch description.

    Either side null -> the other side.  A ball put in play whose outcome
    is one of ``IN_PLAY_OUTCOMES`` -> the outcome.  Otherwise the
    description.
    """
    e, d = F.col(events), F.col(description)
    return (
        F.when(e.isNull() | d.isNull(), F.coalesce(e, d))
        .when((d == "hit_into_play") & e.isin(*IN_PLAY_OUTCOMES), e)
        .otherwise(d)
    )


def fill_outcome(events: str = "events", type_col: str = "type") -> Column:
    """Fill a blank outcome from the ball / strike / in-play code."""
    names = {"B": "ball", "S": "strike", "X": "in_play"}
    assert set(names) == set(TYPE_INDEX)
    t = F.col(type_col)
    by_type = F.when(t == "B", names["B"]).when(t == "S", names["S"]).when(t == "X", names["X"])
    return F.coalesce(F.col(events), by_type)


def round_doubles(df: DataFrame, digits: int = 6, columns: Iterable[str] | None = None) -> DataFrame:
    """Round double columns (all, or ``columns``) for engine-independent
    comparison.  Only values whose last bits depend on summation order
    (averages of averages, correlations) need it: a ratio of exact sums is
    the same double in any engine, and rounding it could only introduce a
    difference (engines break decimal ties differently)."""
    wanted = None if columns is None else set(columns)
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name)
            if f.dataType.typeName() in ("double", "float") and (wanted is None or f.name in wanted)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
