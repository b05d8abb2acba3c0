"""The look-back jobs as Structured Streaming. Event times are ``timestamp``: watermarks reject ``timestamp_ntz``."""

from __future__ import annotations

import functools
import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from urbana.session import scratch_path


def stream_files(spark: SparkSession, path: str, schema: T.StructType, ts: str | None = None, files: int | None = None) -> DataFrame:
    """New Parquet files of a folder; the time column becomes a ``timestamp``."""
    reader = spark.readStream.schema(schema)
    s = (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)
    return s.withColumn(ts, F.col(ts).cast("timestamp")) if ts else s


def with_lateness(s: DataFrame, ts: str, delay: str) -> DataFrame:
    return s.withWatermark(ts, delay)


def stream_digest(s: DataFrame, id_col: str, ts: str, condition: Column, delay: str) -> DataFrame:
    """Events that match, each id once within the delay."""
    return s.where(condition).withWatermark(ts, delay).dropDuplicatesWithinWatermark([id_col])


def stream_dedup(s: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    return s.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def tumbling(s: DataFrame, ts: str, length: str, delay: str, keys: list[str], value: str) -> DataFrame:
    """Rows and sums of each window and key."""
    return _windows(s, F.window(ts, length), ts, delay, keys, value)


def sliding(s: DataFrame, ts: str, length: str, slide: str, delay: str, keys: list[str], value: str) -> DataFrame:
    """Accumulations of a length, each slide."""
    return _windows(s, F.window(ts, length, slide), ts, delay, keys, value)


def _windows(s: DataFrame, window: Column, ts: str, delay: str, keys: list[str], value: str) -> DataFrame:
    agg = s.withWatermark(ts, delay).groupBy(window.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(value), 4).alias("total"))
    return agg.select(F.col("w.start").alias("inicio"), *keys, "n", "total")


def stream_sessions(s: DataFrame, key: str, ts: str, gap: str, delay: str) -> DataFrame:
    """Sessions of a key by gap: start, end of the gap, rows."""
    agg = s.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return agg.select(key, F.col("w.start").alias("inicio"), F.col("w.end").alias("fim"), "n")


def stream_suppress(s: DataFrame, static: DataFrame, keys: list[str]) -> DataFrame:
    """Stream rows without a match in a static table."""
    return s.join(static.select(*keys).distinct(), keys, "left_anti")


EMITTED = "key string, motivo string, n long, mais_antigo timestamp"


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class CountOrAge(StatefulProcessor):
    """Groups of a key's rows in order of time: emitted at ``n`` rows, or when ``millis`` have passed since the oldest.

    The open group is a list of fewer than ``n`` times, its oldest a value; an event-time timer ends it when no more rows come. State is cleared with
    the group. (Spark's state TTL counts processing time only, so the timer does its work here.)
    """

    def __init__(self, n: int, millis: int):
        self.n, self.millis = n, millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "t long")
        self.oldest = handle.getValueState("oldest", "t long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        new = [pd.to_datetime(b.iloc[:, -1]).to_numpy("datetime64[ms]").astype(np.int64) for b in rows]
        kept = np.array([t[0] for t in self.open.get()] if self.open.exists() else [], np.int64)
        at, i, out = np.sort(np.concatenate([kept, *new])), 0, []
        while i < len(at):
            aged = int(np.searchsorted(at, at[i] + self.millis))
            end = min(i + self.n, aged)
            if end == i + self.n or aged < len(at):
                out.append((str(key[0]), "count" if end == i + self.n else "age", end - i, int(at[i])))
                i = end
            else:
                break
        self.keep(at[i:].tolist(), timerValues.getCurrentWatermarkInMs())
        yield self.frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        due = self.oldest.exists() and self.oldest.get()[0] + self.millis <= expiredTimerInfo.getExpiryTimeInMs()
        out = [(str(key[0]), "age", sum(1 for _ in self.open.get()), self.oldest.get()[0])] if due else []
        if due:
            self.keep([], 0)
        yield self.frame(out)

    def keep(self, times: list[int], watermark: int) -> None:
        if self.oldest.exists():
            self.open.clear()
            self.oldest.clear()
        if times:
            self.open.put([(t,) for t in times])
            self.oldest.update((times[0],))
            self.handle.registerTimer(max(times[0] + self.millis, watermark + 1))

    def frame(self, rows: list[tuple]) -> pd.DataFrame:
        found = pd.DataFrame(rows, columns=["key", "motivo", "n", "mais_antigo"])
        return found.assign(mais_antigo=pd.to_datetime(found["mais_antigo"].astype("int64"), unit="ms"))

    def close(self) -> None:
        pass


def stateful_emit(s: DataFrame, key: str, ts: str, n: int, minutes: int, delay: str) -> DataFrame:
    """A group is emitted when its ``n``-th row comes, or ``minutes`` after its oldest by event time; then it starts anew.

    The state of a key is fewer than ``n`` times, however many rows it has; a task holds the times of one key's new rows as one array. Needs RocksDB as the
    session's state store, which is set here.
    """
    s.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = s.withWatermark(ts, delay).select(F.col(key).cast("string").alias("key"), F.col(ts).alias("at"))
    return rows.groupBy("key").transformWithStateInPandas(CountOrAge(n, minutes * 60_000), EMITTED, "append", "EventTime")


def idempotent_sink(folder: str, keys: list[str], run: str | None = None, buckets: int = 16):
    """A ``foreachBatch`` function that appends to ``folder/rows`` the rows whose key no earlier batch of any run has written.

    The ledger ``folder/batches`` gives each batch of each query run its place in time, once and for all; a batch that comes again keeps its place, and
    replaces its own rows and keys by the same ones. A new checkpoint is a new run and adds to what is there. Written keys lie in hash
    buckets, and a batch reads those of its own keys' buckets only. One writer at a time. ``run``: a name for the run; by default the query's id.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = run or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "run"
        own = f"{folder}/batches/run={name}/batch={batch_id}"
        if (place := _read(spark, [own], "place long")) is None:
            spark.range(1).select(F.lit(time.time_ns()).alias("place")).coalesce(1).write.mode("overwrite").parquet(own)
            place = _read(spark, [own], "place long")
        place = place.first()[0]
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        batch = batch.dropDuplicates(keys).withColumn("__bucket", bucket).persist()
        touched = [r[0] for r in batch.select("__bucket").distinct().collect()]  # numbers below ``buckets``
        known = T.StructType([*[batch.schema[k] for k in keys], T.StructField("__place", T.LongType())])
        paths = [f"{folder}/keys/bucket={b}" for b in touched]
        seen = _read(spark, paths, known, f"{folder}/keys")
        if seen is None:  # some buckets are still empty
            parts = [p for p in (_read(spark, [x], known, f"{folder}/keys") for x in paths) if p is not None]
            seen = functools.reduce(DataFrame.unionByName, parts) if parts else None
        fresh = batch if seen is None else batch.join(seen.where(F.col("__place") < place).select(*keys), keys, "left_anti")
        rows = f"{folder}/rows/run={name}/batch={batch_id}"
        fresh.select(*batch.columns).write.mode("overwrite").parquet(rows)
        batch.unpersist()
        written = spark.read.parquet(rows).select(*keys, F.lit(place).alias("__place"), F.col("__bucket").alias("bucket"), F.lit(name).alias("run"), F.lit(batch_id).alias("batch"))
        written.repartition("bucket").write.partitionBy("bucket", "run", "batch").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{folder}/keys")

    return write


def read_sink(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that a sink has written."""
    return spark.read.parquet(f"{folder}/rows").drop("__bucket", "run", "batch")


def _read(spark: SparkSession, paths: list[str], schema, base: str | None = None) -> DataFrame | None:
    """The Parquet files of paths, None where there are none."""
    try:
        reader = spark.read.schema(schema)
        return (reader.option("basePath", base) if base else reader).parquet(*paths) if paths else None
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def run_once(s: DataFrame, mode: str = "append", sink=None, at: str | None = None) -> DataFrame | None:
    """Run a stream over what is there into the shared folder; the rows written, or None with a sink of one's own.

    With the folder ``at`` of an earlier run, the stream goes on where that one ended: its offsets, state and watermark are kept.
    """
    spark = s.sparkSession
    at = at or scratch_path(spark, "stream")
    w = s.writeStream.option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True)
    if sink is not None:
        w.foreachBatch(sink).start().awaitTermination()
        return None
    w.format("parquet").outputMode(mode).option("path", f"{at}/rows").start().awaitTermination()
    return spark.read.schema(s.schema).parquet(f"{at}/rows")
