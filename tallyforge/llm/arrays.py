"""Array expressions whose work grows in proportion to the array."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements that are added up together.
CHUNK = 128


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it within a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sums_before(values: Column) -> Column:
    """Of each element of an int array, the sum of those before it.

    Sums are taken by chunks and within a chunk, as Spark has no running fold; an array of n elements takes n * CHUNK / 2 additions and (n / CHUNK) ** 2 / 2."""
    add = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    chunks = lambda v: F.transform(upto(F.ceil(F.size(v) / CHUNK).cast("int")), lambda c: F.slice(v, c * CHUNK + 1, CHUNK))
    bases = lambda sums: F.transform(sums, lambda _, c: add(F.slice(sums, F.lit(1), c)))
    within = lambda p: F.transform(p["items"], lambda _, i: p["base"] + add(F.slice(p["items"], F.lit(1), i)))

    def spread(cs: Column) -> Column:
        return F.flatten(F.transform(F.zip_with(cs, bound(F.transform(cs, add), bases), lambda items, base: F.struct(items.alias("items"), base.alias("base"))), within))

    return bound(values, lambda v: bound(chunks(v), spread))
