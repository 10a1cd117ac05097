"""Dictionary encoding (P9-P11, P14, P15, P19) and dimension joins.

A dictionary given as a Python mapping has a size known on the driver.
It becomes one literal inside the projection, whatever its size: an array
of small maps, of which a code's CRC picks one, so a lookup costs the
same for ten entries and for a hundred thousand.  The literal travels as
one JSON text that Catalyst folds, so planning does not slow down with
the entries.  How a code meets a key follows from their types alone (see
``lookup``), the value type from the mapping's values, neither from the
size.  A dictionary DataFrame (read from a file, or derived) is written
once and joined; Spark broadcasts it if the files are small enough.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Mapping, Sequence
from decimal import Decimal, InvalidOperation
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mound.session import broadcast_bytes, path_bytes, scratch_path, write_through

#: Entries of one small map, on average (a lookup scans one such map).
_MAP_ENTRIES = 16
_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")
#: Numbers are compared as decimals of this type: 20 digits before the point, 18 behind it.
_NUMBER = "decimal(38,18)"


def _number_text(number: Decimal) -> str:
    text = f"{abs(number) if number == 0 else number:f}"
    return text.rstrip("0").rstrip(".") if "." in text else text


def _as_number(key: object) -> str | None:
    """The number that a key is, or reads as, in one spelling."""
    if isinstance(key, bool) or not isinstance(key, (int, float, Decimal, str)):
        return None
    try:
        number = Decimal(repr(key) if isinstance(key, float) else str(key).strip())
    except InvalidOperation:
        return None
    return _number_text(number) if number.is_finite() else None


def _number_of(source: Column) -> Column:
    """The spelling of ``_as_number`` for a column of any type; null where it is no number."""
    number = source.cast("string").try_cast(_NUMBER)
    return F.regexp_replace(number.cast("string"), r"\.?0+$", "")


def _text_key(key: object) -> str:
    return str(key).lower() if isinstance(key, bool) else str(key)


def _value_type(values: Sequence[object]) -> str:
    kinds = {type(v) for v in values if v is not None}
    if kinds <= {bool}:
        return "boolean"
    if kinds <= {int}:
        return "int" if all(v is None or -2**31 <= v < 2**31 for v in values) else "bigint"
    if kinds <= {int, float}:
        return "double"
    if kinds <= {str}:
        return "string"
    raise TypeError(f"a dictionary's values must be of one type: {sorted(k.__name__ for k in kinds)}")


def _literal_lookup(entries: Mapping[str, object], code: Column, value_type: str) -> Column:
    """``entries[code]`` for text codes, null where there is none."""
    if not entries:
        return F.lit(None).cast(value_type)
    parts: list[dict[str, object]] = [{} for _ in range(1 + len(entries) // _MAP_ENTRIES)]
    for k, v in entries.items():
        parts[zlib.crc32(k.encode()) % len(parts)][k] = v
    maps = F.from_json(F.lit(json.dumps(parts)), f"array<map<string,{value_type}>>")
    part = (F.crc32(code.cast("binary")) % F.lit(len(parts))).cast("int")
    return F.try_element_at(F.get(maps, part), code)


def _find(mapping: Mapping[object, object], source: Column) -> Column:
    """``mapping[source]`` by the rule of ``lookup``, null for codes that the mapping lacks."""
    value_type = _value_type(list(mapping.values())) if mapping else "int"
    texts = {_text_key(k): v for k, v in mapping.items() if isinstance(k, bool) or not isinstance(k, (int, float, Decimal))}
    numbers = {n: v for k, v in mapping.items() if not isinstance(k, str) and (n := _as_number(k)) is not None}
    read = {n: v for k, v in mapping.items() if isinstance(k, str) and (n := _as_number(k)) is not None}
    numeric = F.typeof(source).isin(*_NUMERIC) | F.typeof(source).startswith("decimal")
    text = source.cast("string")
    if not numbers and not read:
        return F.when(~numeric, _literal_lookup(texts, text, value_type))
    by_number = _literal_lookup(read | numbers, _number_of(source), value_type)
    by_text = _literal_lookup(texts, text, value_type)
    if numbers:
        by_text = F.coalesce(by_text, _literal_lookup(numbers, _number_of(source), value_type))
    return F.when(numeric, by_number).otherwise(by_text)


def _missing(value: Column, source: Column, on_missing: str, default: object = 0) -> Column:
    if on_missing == "null":
        return value
    if on_missing == "zero":
        return F.coalesce(value, F.lit(default))
    if on_missing == "error":
        return F.when(
            value.isNull() & source.isNotNull(),
            F.raise_error(F.concat(F.lit("unknown code: "), source.cast("string"))),
        ).otherwise(value)
    raise ValueError(f"unknown on_missing rule {on_missing!r}")


def lookup(source: str | Column, mapping: Mapping[object, object], on_missing: str = "null", default: object = 0) -> Column:
    """Column expression: ``mapping[source]`` with the chosen rule for
    codes absent from the mapping (a null input stays null unless
    ``on_missing='zero'``).

    A numeric column meets keys by value, whatever its type: 1, 1.0 and
    1.00 meet the keys 1, 1.0, ``'1'`` and ``'1.'``.  Any other column meets
    text keys as its text, letter by letter, and numeric keys where its text
    reads as that number.  Numbers beyond 20 digits before the point, and
    those that are not finite, meet nothing; digits beyond 18 behind the
    point are rounded.  Two keys of one value: the last wins, numeric keys
    before texts.
    """
    src = F.col(source) if isinstance(source, str) else source
    return _missing(_find(mapping, src), src, on_missing, default)


def encode(df: DataFrame, columns: Sequence[str] | str, mapping: Mapping[object, object],
           on_missing: str = "null", suffix: str | None = None, default: object = 0) -> DataFrame:
    """Encode one or more columns with ``mapping``.

    ``suffix=None`` replaces the column in place, otherwise writes
    ``<col><suffix>``.
    """
    cols = [columns] if isinstance(columns, str) else list(columns)
    return df.withColumns({c if suffix is None else f"{c}{suffix}": lookup(c, mapping, on_missing, default) for c in cols})


def encode_with_frame(df: DataFrame, column: str, dictionary: DataFrame, on_missing: str = "null",
                      suffix: str | None = None, default: object = 0, code: str = "code",
                      value: str = "value") -> DataFrame:
    """Dictionary join.  ``dictionary`` must be unique on ``code``
    (see ``load_dictionary``)."""
    out = column if suffix is None else f"{column}{suffix}"
    dim = write_through(dictionary.select(F.col(code).alias("__code"), F.col(value).alias("__value")), "dictionary")
    joined = df.join(dim, df[column] == dim["__code"], "left")
    return joined.withColumn(out, _missing(F.col("__value"), F.col(column), on_missing, default)).drop("__code", "__value")


def matchup(home: str = "home_team", away: str = "away_team", mapping: Mapping[str, int] | None = None) -> Column:
    """``"<away index>:<home index>"``, unknown team -> 0."""
    from mound.dictionaries import TEAM_INDEX

    m = TEAM_INDEX if mapping is None else mapping
    return F.concat_ws(
        ":",
        lookup(away, m, "zero").cast("string"),
        lookup(home, m, "zero").cast("string"),
    )


def load_dictionary(df: DataFrame, code: str = "code", name: str = "name", order: str | None = None) -> DataFrame:
    """One row per code; with duplicates, the row last in ``order``
    wins (``max_by`` is an algebraic aggregate, so a code repeated many
    times is combined map-side)."""
    if order is None:
        return df.groupBy(code).agg(F.max(name).alias(name))
    return df.groupBy(code).agg(F.max_by(name, order).alias(name))


def translate_list(df: DataFrame, column: str, dictionary: DataFrame | Mapping[str, str], out: str,
                   sep: str = ",", joiner: str = ", ", code: str = "code", name: str = "name") -> DataFrame:
    """Split a comma list, replace known codes by names, join again.

    With a mapping the whole thing is one projection (``transform`` over
    the split array).  So it is with a dictionary DataFrame whose written
    files have no more bytes than Spark would broadcast
    (``spark.sql.autoBroadcastJoinThreshold``): its rows, at most so many
    bytes, become a mapping.  With a larger one the translation is a
    function of the list string alone, so it is computed once per distinct
    list: distinct lists are exploded to (list, position, token),
    left-joined to the dictionary and put back together in list order,
    keyed by the list string itself; the rows then join that small table
    on the string.  Everything is keyed by content, so a retried task can
    never re-number rows.  A list value shared by a huge share of the rows
    is one row of the distinct table (partial aggregation), and AQE splits
    the matching side of the final join if it is skewed.
    """
    if not isinstance(dictionary, DataFrame):
        parts = F.split(F.col(column), F.lit(sep), -1)
        tr = F.transform(parts, lambda x: F.coalesce(_find(dictionary, x), x))
        return df.withColumn(out, F.when(F.col(column).isNotNull(), F.array_join(tr, joiner)))

    spark = df.sparkSession
    stored = scratch_path(spark, "translations")
    dictionary.select(F.col(code).cast("string").alias("code"), F.col(name).cast("string").alias("name")).write.parquet(stored)
    dictionary, code, name = spark.read.parquet(stored), "code", "name"
    if path_bytes(spark, stored) <= broadcast_bytes(spark):
        mapping = {r["code"]: r["name"] for r in dictionary.where("code is not null").collect()}
        return translate_list(df, column, mapping, out, sep, joiner)

    lists = df.select(F.col(column).alias("__list")).where(F.col("__list").isNotNull()).distinct()
    tokens = lists.select("__list", F.posexplode(F.split(F.col("__list"), F.lit(sep), -1)).alias("__pos", "__tok"))
    dim = dictionary.select(F.col(code).alias("__tok"), F.col(name).alias("__name"))
    translated = (
        tokens.join(dim, "__tok", "left")
        .groupBy("__list")
        .agg(F.array_sort(F.collect_list(F.struct("__pos", F.coalesce("__name", "__tok").alias("t")))).alias("__p"))
        .select("__list", F.array_join(F.transform("__p", lambda s: s["t"]), joiner).alias(out))
    )
    # One row per distinct list: written once, and joined by the size of its files.
    translated = write_through(translated, "translated-lists")
    return df.join(translated, df[column] == translated["__list"], "left").drop("__list")


def dense_indexes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, index): the distinct non-null values of each listed
    column -- all of one type -- with their 0-based rank in ascending order
    (``dense_rank() - 1``), from one pass over ``df`` and without sending a
    column's values to one task.  The distinct (column, value) pairs are
    range-partitioned by a sort and numbered inside each partition; that
    table is written once, and an offset is the number of a column's values
    in the partitions before (one row per column and partition).
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    vals = df.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct()
    numbered = vals.orderBy("column", "value").withColumn("__pid", F.spark_partition_id()).withColumn(
        "__i", F.row_number().over(Window.partitionBy("__pid", "column").orderBy("value")) - 1)
    numbered = write_through(numbered, "dense-index")
    before = Window.partitionBy("column").orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered.groupBy("column", "__pid").agg(F.count(F.lit(1)).alias("__n")).select(
        "column", "__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return numbered.join(F.broadcast(offsets), ["column", "__pid"]).select(
        "column", "value", (F.col("__off") + F.col("__i")).cast("int").alias("index"))


def dense_index(df: DataFrame, column: str) -> DataFrame:
    """(value, index) of one column, see ``dense_indexes``."""
    return dense_indexes(df, [column]).select("value", "index")


def encode_all(df: DataFrame, columns: Sequence[str], suffix: str = "_index",
               materialize_input: bool = False) -> DataFrame:
    """Index every listed column by the rank of its value (nulls stay
    null).  Columns of one type are numbered in one pass over ``df``; their
    dictionaries are one written table, of which each column joins its part
    (broadcast if the files are small enough).

    When ``df`` is expensive to recompute (joins, aggregates),
    ``materialize_input`` writes it once first.
    """
    base = write_through(df, "encode-all-input") if materialize_input else df
    types = dict(base.dtypes)
    out = base
    for _, same in groupby(sorted(columns, key=lambda c: types[c]), key=lambda c: types[c]):
        same = list(same)
        dictionary = write_through(dense_indexes(base, same), "dense-dictionary")
        for c in same:
            d = dictionary.where(F.col("column") == c).select(F.col("value").alias("__v"), F.col("index").alias(f"{c}{suffix}"))
            out = out.join(d, out[c] == d["__v"], "left").drop("__v")
    return out.select(*base.columns, *[f"{c}{suffix}" for c in columns])
