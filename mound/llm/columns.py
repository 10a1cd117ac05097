"""Column helpers shared by the native operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once however often ``body`` names it.

    Inside higher-order functions Spark evaluates a repeated expression anew
    for every element; binding it to a lambda variable avoids that.
    """
    return F.transform(F.array(value), body)[0]


def prefix_sums(lengths: Column, block: int = 256) -> Column:
    """Exclusive prefix sums of an array of longs (bind ``lengths`` with ``let``).

    Two levels, so that n elements cost n * block + (n / block)^2 additions.
    """
    n = F.size(lengths)
    zero = F.lit(0).cast("long")
    total = lambda a: F.aggregate(a, zero, lambda x, y: x + y)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int")),
                         lambda b: total(F.slice(lengths, b * block + 1, F.lit(block))))

    def sums(of_block: Column) -> Column:
        before = F.transform(of_block, lambda _, b: total(F.slice(of_block, F.lit(1), b)))
        return let(before, lambda base: F.transform(
            lengths, lambda _, i: F.element_at(base, F.floor(i / block).cast("int") + 1)
            + total(F.slice(lengths, F.floor(i / block).cast("int") * block + 1, F.pmod(i, F.lit(block))))))

    return F.when(n == 0, F.array().cast("array<long>")).otherwise(let(blocks, sums))
