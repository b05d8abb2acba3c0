"""Relational steps inside a row: filters, joins to the outer level, ranks, distinct and sums over arrays of structs.

A person's debts, payment slips and instalments stay in their row, so nothing is exploded and no arrays are multiplied with each other.
A null array counts as empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Each = Callable[[Column], Column]


def where(rows: Column, condition: Each) -> Column:
    """The rows that meet a condition; null is no."""
    return F.filter(rows, lambda x: F.coalesce(condition(x), F.lit(False)))


def any_of(rows: Column, condition: Each) -> Column:
    return F.coalesce(F.exists(rows, lambda x: F.coalesce(condition(x), F.lit(False))), F.lit(False))


def inner(rows: Column, name: str, made: Callable[[Column, Column], Column]) -> Column:
    """One flat array of ``made(outer, inner)`` for the inner rows ``outer[name]`` of all outer rows, in order."""
    return F.flatten(F.transform(rows, lambda o: F.transform(F.coalesce(o[name], F.array()), lambda i: made(o, i))))


def ranked(rows: Column, *keys: Each) -> Column:
    """The rows by ascending keys, nulls first; rows with equal keys by their own values."""
    marked = F.transform(rows, lambda x: F.struct(*[k(x).alias(f"k{i}") for i, k in enumerate(keys)], x.alias("row")))
    return F.transform(F.array_sort(marked), lambda x: x["row"])


def first(rows: Column, *keys: Each) -> Column:
    """The first row by ascending keys, nulls first, and its own values; null where there is none."""
    marked = F.transform(rows, lambda x: F.struct(*[k(x).alias(f"k{i}") for i, k in enumerate(keys)], x.alias("row")))
    return F.array_min(marked)["row"]


def latest(day: Column) -> Column:
    """A key that puts later days first and null last."""
    return F.coalesce(-F.unix_date(day), F.lit(2**31 - 1))


def distinct(rows: Column, *fields: str) -> Column:
    """The different values of some fields, as structs."""
    return F.array_distinct(F.transform(rows, lambda x: F.struct(*[x[f].alias(f) for f in fields])))


def total(rows: Column, value: Each, kind: str = "double") -> Column:
    """The sum of a value over the rows, null values left out; null without any."""
    values = F.filter(F.transform(rows, lambda x: value(x).cast(kind)), lambda v: v.isNotNull())
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0).cast(kind), lambda a, v: (a + v).cast(kind)))
