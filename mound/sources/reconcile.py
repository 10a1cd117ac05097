"""Season files whose schemas differ.

Over the years columns come and go, and a whole number becomes a double.
``read_seasons`` reads the schemas from the files' footers, finds one type
for each column, and reads the files of one schema together, casting to
that type; a column that a season lacks is null there.  No season is read
twice, and none with a schema that its files do not have.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Wider types to the right; a mixture takes the widest.
_WHOLE = ("tinyint", "smallint", "int", "bigint")
_REAL = ("float", "double")


class SchemaConflictError(ValueError):
    pass


def wider(a: T.DataType, b: T.DataType, column: str = "") -> T.DataType:
    """The least type that holds both: int -> long -> double, date -> timestamp, decimals by their digits.

    A whole number meets a float as a double, a decimal meets either as a
    double.  Types that have nothing in common are refused."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()
    names = {a.simpleString(), b.simpleString()}
    numeric = lambda t: t.simpleString() in _WHOLE + _REAL or isinstance(t, T.DecimalType)
    if names <= set(_WHOLE):
        return max((a, b), key=lambda t: _WHOLE.index(t.simpleString()))
    if numeric(a) and numeric(b):
        return T.DoubleType()
    if names == {"date", "timestamp"}:
        return T.TimestampType()
    raise SchemaConflictError(f"column {column!r}: no type holds both {a.simpleString()} and {b.simpleString()}")


def common_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """Every column of the schemas, in order of first appearance, in its widest type."""
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            types[f.name] = wider(types[f.name], f.dataType, f.name) if f.name in types else f.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def season_schemas(spark: SparkSession, paths: Sequence[str]) -> dict[str, T.StructType]:
    """The schema of each path (a file, or a season's folder of files that agree), from footers alone."""
    return {p: spark.read.option("mergeSchema", "true").parquet(p).schema for p in paths}


def read_seasons(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """The rows of all paths under ``schema`` (default: ``common_schema`` of theirs).

    Paths of one schema are one scan.  With a given schema, other columns
    are left out.  The result keeps column pruning and filters of each scan.
    """
    found = season_schemas(spark, paths)
    groups: dict[str, list[str]] = {}
    for path, s in found.items():
        groups.setdefault(s.json(), []).append(path)
    target = common_schema(list(found.values())) if schema is None else schema

    def read(members: list[str]) -> DataFrame:
        own = found[members[0]]
        df = spark.read.schema(own).parquet(*members)
        have = set(own.fieldNames())
        return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields])

    return reduce(DataFrame.unionAll, [read(g) for g in groups.values()])
