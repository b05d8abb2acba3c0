"""Parameterised SQL texts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession


def shifted_offset(today: dt.date, days: int, skip_weekends: bool) -> int:
    """A day offset that, over a weekend, lands on the Monday after."""
    if not skip_weekends:
        return days
    w = (today.weekday() + days) % 7
    return days + (2 if w == 5 else 1 if w == 6 else 0)


PROCESSORS = {"skip_weekends": lambda params, today: params | {"dias": shifted_offset(today, params["dias"], True)}}


def render(spark: SparkSession, sql: str, params: dict, processor: str | None = None, today: dt.date | None = None, **tables: DataFrame) -> DataFrame:
    """A query with named markers (``:name``) and tables in braces; values are never pasted into the text."""
    if processor:
        params = PROCESSORS[processor](params, today or dt.datetime.now(dt.timezone.utc).date())
    return spark.sql(sql, args=params, **tables)
