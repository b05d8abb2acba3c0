"""Incremental loading: upserts, deletes, high-water marks."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbana.session import cut


def _same(keys: list[str], a: str, b: str) -> Column:
    return functools.reduce(Column.__and__, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows without a source row of their key, and all source rows. Null keys are equal. The source has each key once."""
    stay = target.alias("t").join(source.alias("s"), _same(keys, "t", "s"), "left_anti")
    return stay.unionByName(source.select(*target.columns))


def stage(df: DataFrame, path: str) -> DataFrame:
    """Truncate a staging table and load it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store(df: DataFrame, path: str, keys: list[str], parts: int = 64) -> None:
    """Write a table dealt to parts by its keys, so that an upsert rewrites the parts it touches. For 100 TB take thousands."""
    _dealt(df, keys, parts).repartition("__part").write.partitionBy("__part").mode("overwrite").parquet(path)


def upsert_stored(spark: SparkSession, path: str, source: DataFrame, keys: list[str], parts: int = 64) -> None:
    """Upsert a staged table into a stored one of so many parts; parts without a source row are neither read nor written.

    The new parts are first written to the shared folder, then put in place. Running it again gives the same table. Null keys
    are equal, the source has each key once; an empty source changes nothing.
    """
    new = _dealt(source, keys, parts)
    touched = [r[0] for r in new.select("__part").distinct().collect()]  # at most ``parts`` numbers
    if touched:
        old = spark.read.schema(new.schema).parquet(path).where(F.col("__part").isin(touched))
        merged = cut(upsert(old, new, ["__part", *keys]))
        merged.repartition("__part").write.partitionBy("__part").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def _dealt(df: DataFrame, keys: list[str], parts: int) -> DataFrame:
    return df.withColumn("__part", F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))


def publish(df: DataFrame, existing: DataFrame, key: str, mode: str) -> DataFrame:
    """Full: the new rows. Incremental: the existing rows and those new by id."""
    return df if mode == "full" else existing.unionByName(df.join(existing.select(key), key, "left_anti").select(*existing.columns))


def rolling_upsert(target: DataFrame, updates: DataFrame, keys: list[str], ts: str, now: dt.datetime, hours: int) -> DataFrame:
    """An upsert that lets rows older than some hours go first."""
    return upsert(target.where(F.col(ts) >= F.lit(now - dt.timedelta(hours=hours))), updates, keys)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows but those that match; an unknown condition does not match."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def high_water(target: DataFrame, col: str, group: list[str] = ()) -> DataFrame:
    """The largest time of each group; the epoch for an empty table without groups."""
    top = F.max(col)
    return target.groupBy(*group).agg(top.alias("marca")) if group else target.agg(F.coalesce(top, F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz")).alias("marca"))


def after_mark(source: DataFrame, mark: DataFrame, col: str) -> DataFrame:
    """Rows after a mark of one row."""
    return source.crossJoin(F.broadcast(mark)).where(F.col(col) > F.col("marca")).drop("marca")  # the mark is one row


def append_assignment(history: DataFrame, assigned: DataFrame, key: str) -> DataFrame:
    """A history with the assignments of people it does not have yet."""
    return publish(assigned, history, key, "incremental")
