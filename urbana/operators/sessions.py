"""Sessions and running state within a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbana.operators import scan


def anchored_sessions(df: DataFrame, key: str, ts: str, hours: int) -> DataFrame:
    """``df`` with ``sessao`` (from 1) and ``inicio``: a session ends a fixed time after its **first** row.

    A segmented scan: a key may hold any share of the rows. Rows without a key are one key; rows without a time have no session and are left out.
    """
    rows = df.where(F.col(ts).isNotNull()).select(*[c for c in df.columns if c not in ("sessao", "inicio")])
    return scan.anchored(rows, [key], ts, hours * 3_600_000_000, "sessao", "inicio").withColumn("sessao", F.col("sessao").cast("int"))


def since_previous(df: DataFrame, key: str, ts: str, ties: list[str] = ()) -> DataFrame:
    """Whole seconds since the row before of the key; null for its first."""
    before = F.lag(ts).over(Window.partitionBy(key).orderBy(ts, *ties))
    return df.withColumn("segundos", F.timestamp_diff("SECOND", before, F.col(ts)))


def gap_sessions(df: DataFrame, key: str, ts: str, seconds: int, ties: list[str] = ()) -> DataFrame:
    """``df`` with ``sessao`` (from 1) and ``sessao_id``: a new session after more than a gap without rows.

    The id is the first 16 hex digits of md5(start + '_' + key). A segmented scan: a key may hold any share of the rows.
    """
    found = scan.gaps(df.drop("sessao"), [key], ts, seconds, list(ties), "sessao", "__began")
    named = F.substring(F.md5(F.concat(F.date_format("__began", "yyyy-MM-dd HH:mm:ss"), F.lit("_"), F.col(key).cast("string"))), 1, 16)
    return found.withColumn("sessao_id", named).drop("__began")


def lookup_within_key(df: DataFrame, key: str, call: str, name: str) -> DataFrame:
    """A call's name, said once, on every row of the thread with that call."""
    said = df.where(F.col(name).isNotNull()).groupBy(key, call).agg(F.max(name).alias("__name"))
    return df.join(said, [key, call], "left").withColumn(name, F.coalesce(name, "__name")).drop("__name")


def step_id(df: DataFrame, key: str, order: str, returned: Column) -> DataFrame:
    """A step number that goes up after each return."""
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("passo", F.coalesce(F.sum(F.when(returned, 1).otherwise(0)).over(before), F.lit(0)) + 1)
