"""Queries of the streaming operators (R): each drains the events as a file stream; the SQL is the batch twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbana.queries.base import query
from urbana.session import scratch_path
from urbana.streaming import ops


def _events(t):
    """``events`` as a stream of files, each a range of time; what is there comes in one batch, so nothing is late."""
    at = scratch_path(t.spark, "events")
    t.events.repartitionByRange("ts").write.parquet(at)
    return ops.stream_files(t.spark, at, t.events.schema, "ts")


def _ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@query("r01_stream_files", "SELECT event_id, user_id, event_type FROM events")
def _(t):
    return ops.run_once(_events(t).select("event_id", "user_id", "event_type"))


@query("r02_stream_digest", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')")
def _(t):
    s = ops.stream_digest(_events(t), "event_id", "ts", F.col("event_type").isin("click", "purchase"), "40 days")
    return ops.run_once(s.select("event_id", "event_type"))


@query("r03_tumbling", "SELECT date_trunc('hour', ts) AS inicio, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def _(t):
    return _ntz(ops.run_once(_flushed(t, lambda s: ops.tumbling(s, "ts", "1 hour", "0 seconds", ["event_type"], "value"))), "inicio")


def _flushed(t, plan):
    """A stream of all events and, last, one far in the future that moves the watermark past every window; its own rows are dropped."""
    at = scratch_path(t.spark, "flushed")
    t.events.repartitionByRange("ts").write.parquet(f"{at}/a")
    last = t.events.limit(1).withColumn("ts", F.expr("TIMESTAMP_NTZ'2100-01-01 00:00:00'"))
    last.write.parquet(f"{at}/b")
    return plan(ops.stream_files(t.spark, f"{at}/*", t.events.schema, "ts"))


@query("r04_sliding", """
SELECT w AS inicio, count(*) AS n, round(sum(value), 4) AS total FROM events, unnest([time_bucket(INTERVAL 6 HOUR, ts), time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR, time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 12 HOUR, time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 18 HOUR]) AS u(w) GROUP BY 1""")
def _(t):
    return _ntz(ops.run_once(_flushed(t, lambda s: ops.sliding(s, "ts", "24 hours", "6 hours", "0 seconds", [], "value"))), "inicio")


@query("r05_stream_sessions", """
WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 6 HOUR THEN 1 ELSE 0 END AS novo FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(novo) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS inicio, max(ts) + INTERVAL 6 HOUR AS fim, count(*) AS n FROM s GROUP BY user_id, k""")
def _(t):
    return _ntz(ops.run_once(_flushed(t, lambda s: ops.stream_sessions(s, "user_id", "ts", "6 hours", "0 seconds"))).where("inicio < '2099-01-01'"), "inicio", "fim")


@query("r06_late_data", "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS inicio, count(*) AS n FROM events GROUP BY 1")
def _(t):
    """Three runs of one stream: events without some of the last five days; then those, late but within the delay, and the
    newer ones; then the oldest events once more, which are too late and dropped."""
    feed, at = scratch_path(t.spark, "feed"), scratch_path(t.spark, "stream")
    late = ops.with_lateness(ops.stream_files(t.spark, f"{feed}/*", t.events.schema, "ts"), "ts", "10 days")
    plan = late.groupBy(F.window("ts", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("inicio"), "n")
    held = "(ts >= '2024-01-25' OR ts >= '2024-01-20' AND event_id % 5 = 0)"
    last = t.events.limit(1).withColumn("ts", F.expr("TIMESTAMP_NTZ'2100-01-01 00:00:00'"))
    for i, rows in enumerate((t.events.where(f"NOT {held}"), t.events.where(held), t.events.where("ts < '2024-01-05'"), last)):
        rows.write.parquet(f"{feed}/{i}")
        done = ops.run_once(plan, at=at)
    return _ntz(done, "inicio")


@query("r07_stateful_emit")
def _(t):
    return ops.run_once(_flushed(t, lambda s: ops.stateful_emit(s, "event_type", "ts", 5, 7, "0 seconds")))


@query("r08_idempotent_sink", "SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def _(t):
    """Half of the events, then all of them: the sink has each event once."""
    feed, at, run = scratch_path(t.spark, "feed"), scratch_path(t.spark, "sink"), scratch_path(t.spark, "stream")
    s = ops.stream_files(t.spark, f"{feed}/*", t.events.schema).select("event_id", "user_id")
    for i, rows in enumerate((t.events.where("event_id % 2 = 0"), t.events)):
        rows.write.parquet(f"{feed}/{i}")
        ops.run_once(s, sink=ops.idempotent_sink(at, ["event_id"]), at=run)
    return ops.read_sink(t.spark, at).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("r08_sink_after_a_new_checkpoint", "SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def _(t):
    """Two thirds of the events by one run, all of them by another that knows nothing of it: the sink keeps the former and adds the others."""
    feed, at = scratch_path(t.spark, "feed"), scratch_path(t.spark, "sink")
    for i, rows in enumerate((t.events.where("event_id % 3 = 0"), t.events.where("event_id % 3 = 1"), t.events)):
        rows.write.parquet(f"{feed}/{i}")
        s = ops.stream_files(t.spark, f"{feed}/*", t.events.schema).select("event_id", "user_id")
        ops.run_once(s, sink=ops.idempotent_sink(at, ["event_id"]), at=scratch_path(t.spark, "stream"))
    return ops.read_sink(t.spark, at).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("r09_stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def _(t):
    return ops.run_once(ops.stream_dedup(_events(t), ["user_id", "event_type"], "ts", "40 days").select("user_id", "event_type"))


@query("r10_stream_suppress", "SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def _(t):
    known = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"))
    return ops.run_once(ops.stream_suppress(_events(t), known, ["user_id"]).select("event_id", "user_id"))
