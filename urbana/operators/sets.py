"""Unions of tables that differ."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbana.operators.select import first_by


def union_history(new: DataFrame, old: DataFrame, rename: dict[str, str]) -> DataFrame:
    """New and legacy rows under the new names and types."""
    old = old.withColumnsRenamed(rename)
    return new.unionByName(old.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in new.schema]))


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def concat_any(*dfs: DataFrame) -> DataFrame:
    """All rows; columns that a table lacks are null."""
    return functools.reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), dfs)


def merge_sources(dfs: list[DataFrame], keys: list[str], order: list[str]) -> DataFrame:
    """All sources, one row of each key: that of the first source that has it."""
    ranked = [d.withColumn("__source", F.lit(i)) for i, d in enumerate(dfs)]
    return first_by(concat_any(*ranked), keys, ["__source", *order]).drop("__source")
