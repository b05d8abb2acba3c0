"""Segmented scans against plain Python, with keys that lie in many parts."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbana.operators import scan, select, sessions

BASE = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    keys = [None, "hot", "hot", "hot", "a", "b", *[f"k{i}" for i in range(3)]]
    return [(i, rnd.choice(keys), BASE + dt.timedelta(minutes=rnd.randrange(rnd.choice([600, 6000, 60000])), microseconds=rnd.choice([0, 0, 999_999, 1])), rnd.randrange(5)) for i in range(1200)]


@pytest.fixture(scope="module")
def many_parts(spark, rows):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark.createDataFrame(rows, "i int, k string, t timestamp, v int").repartition(5)
    for k, v in before.items():
        spark.conf.set(k, v)


def by_key(rows):
    out = {}
    for r in rows:
        out.setdefault(r[1], []).append(r)
    return {k: sorted(x, key=lambda r: (r[2], r[0])) for k, x in out.items()}


def test_anchored_sessions_of_a_hot_key(many_parts, rows):
    want = {}
    for own in by_key(rows).values():
        start, n = None, 0
        for r in own:
            if start is None or r[2] > start + dt.timedelta(hours=24):
                start, n = r[2], n + 1
            want[r[0]] = (n, start)
    assert {r["i"]: (r["sessao"], r["inicio"]) for r in sessions.anchored_sessions(many_parts, "k", "t", 24).collect()} == want


def test_gap_sessions_of_a_hot_key(many_parts, rows):
    want = {}
    for own in by_key(rows).values():
        last, n, start = None, 0, None
        for r in own:
            if last is None or (r[2] - last) // dt.timedelta(seconds=1) > 3600:
                n, start = n + 1, r[2]
            last = r[2]
            want[r[0]] = (n, start)
    assert {r["i"]: (r["n"], r["s"]) for r in scan.gaps(many_parts, ["k"], "t", 3600, ["i"], "n", "s").collect()} == want


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_sums(many_parts, rows, keys):
    want = {}
    for own in by_key(rows).values() if keys else [sorted(rows, key=lambda r: (r[2], r[0]))]:
        total = 0
        for r in own:
            total += r[3]
            want[r[0]] = total
    assert {r["i"]: r["z"] for r in scan.running_sum(many_parts, keys, ["t", "i"], F.col("v"), "z").collect()} == want


def test_ranks_and_batches(many_parts, rows):
    ranked = select.global_rank(many_parts, ["t", "i"]).collect()
    assert [r["i"] for r in sorted(ranked, key=lambda r: r["rank"])] == [r[0] for r in sorted(rows, key=lambda r: (r[2], r[0]))]
    got = {r["i"]: r["lote"] for r in select.batches(many_parts, ["k"], ["i"], 100, "L").collect()}
    assert got == {r[0]: n // 100 + 1 for own in by_key(rows).values() for n, r in enumerate(sorted(own))}


def test_rows_without_a_time(spark):
    rows = [(1, "a", None), (2, "a", BASE), (3, "a", BASE + dt.timedelta(seconds=100)), (4, "b", None)]
    got = {r["i"]: (r["n"], r["s"]) for r in scan.gaps(spark.createDataFrame(rows, "i int, k string, t timestamp"), ["k"], "t", 50, ["i"], "n", "s").collect()}
    assert got == {1: (0, None), 2: (1, BASE), 3: (2, BASE + dt.timedelta(seconds=100)), 4: (0, None)}


def test_empty_tables(many_parts):
    none = many_parts.limit(0)
    assert scan.gaps(none, ["k"], "t", 1, ["i"], "n", "s").count() == sessions.anchored_sessions(none, "k", "t", 1).count() == scan.running_sum(none, ["k"], ["t"], F.col("v"), "z").count() == select.global_rank(none, ["t"]).count() == 0


def test_a_key_with_a_third_of_the_rows_fills_no_task(spark, many_parts):
    frame = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("k"), F.xxhash64("id").alias("t"))
    sizes = [r["count"] for r in scan.dealt(frame, ["k", "t"]).groupBy("__part").count().collect()]
    assert len(sizes) == 9 and max(sizes) <= 2 * np.median(sizes)


def test_steps_of_a_stretch():
    rng = np.random.default_rng(1)
    for _ in range(300):
        at, span = np.unique(rng.integers(0, 300, rng.integers(1, 60))), int(rng.integers(1, 80))
        steps = scan._steps(at, span)
        for anchor in range(int(at[0]) - 2 * span, int(at[0]) + 1):
            now, n = anchor, 0
            for t in at.tolist():
                if t > now + span:
                    now, n = t, n + 1
            step = [s for s in steps if s[0] < anchor or s is steps[0]][-1]
            assert (step[1] if step[2] else anchor, step[2]) == (now, n)
