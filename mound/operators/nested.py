"""Whole games as nested rows (A11), in ordered chunks of a bounded size."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mound.operators.games import GAME_KEY
from mound.session import write_through

#: Pitches of a chunk, at most.
CHUNK = 500


def _changes(keys: list[pa.Array]) -> list[int]:
    """Places where a row's key differs from the row's before."""
    n = len(keys[0])
    if n < 2:
        return []
    changed = None
    for k in keys:
        a, b = k.slice(1), k.slice(0, n - 1)
        # equal values, or both null
        same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        changed = pc.invert(same) if changed is None else pc.or_(changed, pc.invert(same))
    return [i + 1 for i in pc.indices_nonzero(changed).to_pylist()]


def _chunks(batches: Iterator[pa.RecordBatch], n_keys: int, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of sorted rows of one key, cut every ``size`` rows; a run goes on in the next batch."""
    task, key, held = TaskContext.get().partitionId(), None, None
    nth = at = 0  # chunks and pitches so far of the key last seen

    def emit(rows: pa.RecordBatch, heads: list[int]) -> pa.RecordBatch:
        """Runs of rows, which begin at ``heads``, in chunks."""
        nonlocal nth, at, key
        begins, nths, ats = [], [], []
        for run, (a, b) in enumerate(zip(heads, [*heads[1:], rows.num_rows], strict=True)):
            now = [c[a].as_py() for c in rows.columns[:n_keys]] if run in (0, len(heads) - 1) else None
            if run or now != key:
                nth = at = 0
            for begin in range(a, b, size):
                nth += 1
                begins.append(begin)
                nths.append(nth)
                ats.append(at + 1)
                at += min(size, b - begin)
            key = now
        items = pa.StructArray.from_arrays(rows.columns[n_keys:], names=rows.schema.names[n_keys:])
        offsets = pa.array([*begins, rows.num_rows], pa.int32())
        chosen = pa.array(begins, pa.int64())
        counts = pc.cast(pc.subtract(offsets.slice(1), offsets.slice(0, len(begins))), pa.int64())
        return pa.RecordBatch.from_arrays(
            [*(c.take(chosen) for c in rows.columns[:n_keys]), pa.array([task] * len(begins), pa.int32()), pa.array(nths, pa.int64()),
             pa.array(ats, pa.int64()), counts, pa.ListArray.from_arrays(offsets, items)],
            names=[*rows.schema.names[:n_keys], "__task", "__nth", "__at", "n_pitches", "pitches"])

    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        heads = [0, *_changes(batch.columns[:n_keys])]
        due = heads[-1] + (batch.num_rows - heads[-1]) // size * size  # of the last key, whole chunks go now
        if due:
            yield emit(batch.slice(0, due), [h for h in heads if h < due])
        held = batch.slice(due) if due < batch.num_rows else None
    if held is not None:
        yield emit(held, [0])


def game_pitches(pitches: DataFrame, keys: Sequence[str] = GAME_KEY, order: Sequence[str] = ("game_pk", "pitch_number", "pitcher"),
                 values: Sequence[str] = ("events", "description"), chunk: int = CHUNK) -> DataFrame:
    """All pitches of a game, nested: the key, ``chunk_no`` (from 1),
    ``first_pitch`` (the number of the chunk's first pitch in its game, from
    1), ``n_pitches`` and ``pitches``, an array of ``order`` and ``values`` in
    that order.

    Rows are range-partitioned and sorted by key and order (one shuffle), so
    a game that holds a large share of all rows is spread over many tasks;
    each cuts its runs into chunks, holding a batch of rows.  A table with one
    row per game and task then shifts the numbers of the chunks of games that
    lie in several tasks.  A task's last chunk of a game may be shorter than
    ``chunk``; no chunk is longer.  Null keys are keys like others; pitches
    equal in order and values are interchangeable.
    """
    keys, items = list(keys), [*order, *values]
    columns = pitches.select(*keys, *[F.col(c).alias(f"__{c}") for c in items])
    rows = columns.repartitionByRange(*keys, *[f"__{c}" for c in items]).sortWithinPartitions(*keys, *[f"__{c}" for c in items])
    kinds = {f.name: f.dataType for f in columns.schema.fields}
    nested = T.StructType([T.StructField(f"__{c}", kinds[f"__{c}"]) for c in items])
    schema = T.StructType([T.StructField(k, kinds[k]) for k in keys] + [
        T.StructField("__task", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("__nth", "__at", "n_pitches")],
        T.StructField("pitches", T.ArrayType(nested))])
    cut = write_through(rows.mapInArrow(lambda b: _chunks(b, len(keys), chunk), schema), "game-chunks")
    per_task = cut.groupBy(*keys, "__task").agg(F.sum("n_pitches").alias("__n"), F.count(F.lit(1)).alias("__c"))
    earlier = Window.partitionBy(*keys).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_task.select(*[F.col(k).alias(f"__key_{k}") for k in keys], F.col("__task").alias("__of"),
                             F.sum("__n").over(earlier).alias("__before"), F.sum("__c").over(earlier).alias("__chunks"))
    shifts = write_through(shifts.where("__before is not null"), "game-chunk-shifts")  # what lies in a game's first task stays
    on = F.col("__task") == F.col("__of")
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    plain = F.transform("pitches", lambda p: F.struct(*[p[f"__{c}"].alias(c) for c in items]))
    return cut.join(shifts, on, "left").select(
        *keys, (F.col("__nth") + F.coalesce("__chunks", F.lit(0))).alias("chunk_no"),
        (F.col("__at") + F.coalesce("__before", F.lit(0))).alias("first_pitch"), "n_pitches", plain.alias("pitches"))
