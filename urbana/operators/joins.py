"""Suppression, enrichment and comparison joins."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbana.operators import scan


def suppress(df: DataFrame, history: DataFrame, keys: list[str], condition: Column | None = None) -> DataFrame:
    """Rows without a match in a history (filtered by a condition on it first)."""
    seen = history.where(condition) if condition is not None else history
    return df.join(seen.select(*keys), keys, "left_anti")


def require_any(df: DataFrame, *others: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a match in any of several tables."""
    return df.join(functools.reduce(DataFrame.union, [o.select(*keys) for o in others]), keys, "left_semi")


def new_by_key(df: DataFrame, existing: DataFrame, exprs: dict[str, Callable[[], Column]] | list[str]) -> DataFrame:
    """Rows whose composite key, nulls equal, is not in a table yet."""
    names = list(exprs)
    make = exprs if isinstance(exprs, dict) else {n: (lambda n=n: F.col(n)) for n in names}
    old = existing.select(*[make[n]().alias(f"__o{i}") for i, n in enumerate(names)]).distinct()
    new = df.withColumns({f"__n{i}": make[n]() for i, n in enumerate(names)})
    on = functools.reduce(Column.__and__, [F.col(f"__n{i}").eqNullSafe(F.col(f"__o{i}")) for i in range(len(names))])
    return new.join(old, on, "left_anti").select(*df.columns)


def lookup_many(df: DataFrame, key: str, candidates: list[str], lookup: DataFrame, on: str, value: str) -> DataFrame:
    """``df`` with ``<candidate>_<value>`` for each candidate column: exploded, joined once, put together again."""
    long = df.select(key, F.explode(F.create_map(*[x for c in candidates for x in (F.lit(c), F.col(c))])).alias("__c", "__k"))
    got = long.join(lookup.select(F.col(on).alias("__k"), F.col(value).alias("__v")), "__k", "left")
    wide = got.groupBy(key).agg(*[F.max(F.when(F.col("__c") == c, F.col("__v"))).alias(f"{c}_{value}") for c in candidates])
    return df.join(wide, key, "left")


def join_fallback(df: DataFrame, exact: DataFrame, exact_keys: list[str], coarse: DataFrame, coarse_keys: list[str], value: str) -> DataFrame:
    """A value by an exact key, else by a coarse one, and which of them gave it."""
    e = exact.select(*exact_keys, F.col(value).alias("__e"))
    c = coarse.select(*coarse_keys, F.col(value).alias("__c"))
    both = df.join(e, exact_keys, "left").join(c, coarse_keys, "left")
    precision = F.when(F.col("__e").isNotNull(), "exact").when(F.col("__c").isNotNull(), "coarse").otherwise("none")
    return both.withColumn(value, F.coalesce("__e", "__c")).withColumn("precision", precision).drop("__e", "__c")


def entity_days(df: DataFrame, start: Column, end: Column, day: str = "day") -> DataFrame:
    """A row for each entity and day of a range; none for an empty range."""
    return df.withColumn(day, F.explode(F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))))


def seconds_of(kind: T.DataType, c: Column) -> Column:
    """A date, time or number as whole seconds (a number as its floor), in the order of its values and free of time zones."""
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long") * 86_400
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("SECOND", F.lit(dt.datetime(1900, 1, 1)).cast("timestamp_ntz"), c)
    return F.unix_seconds(c) if isinstance(kind, T.TimestampType) else F.floor(c).cast("long")


def valid_at(df: DataFrame, periods: DataFrame, keys: list[str], ts: str, start: str, end: str) -> DataFrame:
    """Rows beside the periods of their key that hold their time, both bounds included.

    A period belongs to the level of time bins that are just longer than it, so it lies in at most two of them; a row looks into one
    bin of each level that occurs among the periods of its key (one for each power of two of lengths). Rows of a key meet only periods near their time, so a
    key with many rows and many periods neither forms their product nor meets in one task. Periods without a bound, or that end before they start, hold nothing.
    """
    found = [c for c in periods.columns if c not in keys]
    low, high = (seconds_of(periods.schema[c].dataType, F.col(c)) for c in (start, end))
    spans = periods.where(F.col(start) <= F.col(end)).withColumns({"__low": low, "__high": high}).withColumn("__level", F.length(F.bin(F.col("__high") - F.col("__low"))))
    # the half makes the join shuffle both sides anew, so that Spark can split a key with many rows
    levels = spans.groupBy(*keys).agg(F.collect_set("__level").alias("__levels")).withColumn("__half", F.explode(F.array(F.lit(0), F.lit(1))))  # at most 64 numbers a key
    placed = spans.withColumn("__bin", F.explode(F.expr("array_distinct(array(shiftright(__low, __level), shiftright(__high, __level)))"))).select(*keys, "__level", "__bin", *found)
    rows = df.withColumn("__at", seconds_of(df.schema[ts].dataType, F.col(ts))).where("__at IS NOT NULL").withColumn("__half", F.expr("CAST(pmod(xxhash64(__at), 2) AS INT)"))
    rows = rows.join(levels, [*keys, "__half"]).drop("__half").withColumn("__level", F.explode("__levels")).drop("__levels")
    rows = rows.withColumn("__bin", F.expr("shiftright(__at, __level)")).drop("__at")
    # Spark's estimates leave out what explode adds: without the hint it broadcasts rows that are far more than it takes them for
    return rows.hint("merge").join(placed, [*keys, "__level", "__bin"]).where((F.col(ts) >= F.col(start)) & (F.col(ts) <= F.col(end))).drop("__level", "__bin")


def summed_within(df: DataFrame, periods: DataFrame, keys: list[str], ts: str, start: str, end: str, by: list[str], sums: dict[str, Column], count: str = "n") -> DataFrame:
    """``(keys, by, count, sums)``: how many rows lie in the periods of their key, both bounds included, and sums of whole numbers over them.

    The same as grouping what ``valid_at`` finds, but no row is made for a row in a period: rows of a time are summed first, bounds are sorted among
    them, and a period's sum is the difference of two running sums. Work follows rows and periods, however many rows a period holds. Periods that
    hold none are left out; a sum over nulls alone is null.
    """
    known = functools.reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    totals = {"__n": F.count(F.lit(1))} | {f"__s{i}": F.sum(c.cast("long")) for i, c in enumerate(sums.values())} | {f"__c{i}": F.count(c) for i, c in enumerate(sums.values())}
    rows = df.where(known & F.col(ts).isNotNull()).groupBy(*keys, F.col(ts).alias("__at")).agg(*[c.alias(k) for k, c in totals.items()])
    rows = rows.select("*", F.lit(1).alias("__turn"), *[F.lit(None).cast(periods.schema[b].dataType).alias(b) for b in by])
    bounds = F.array(F.struct(F.col(start).alias("__at"), F.lit(0).alias("__turn")), F.struct(F.col(end).alias("__at"), F.lit(2).alias("__turn")))
    turns = periods.where(known & (F.col(start) <= F.col(end))).select(*keys, *by, F.inline(bounds))  # a start comes before rows of its time, an end after them
    both = rows.unionByName(turns, allowMissingColumns=True).withColumn("__tie", F.xxhash64(*by))
    run = scan.running_sums(both, keys, ["__at", "__turn", "__tie"], {f"__run{k}": F.col(k) for k in totals}).where("__turn <> 1")
    net = {k: F.sum(F.when(F.col("__turn") == 2, F.col(f"__run{k}")).otherwise(-F.col(f"__run{k}"))).alias(k) for k in totals}
    found = run.groupBy(*keys, *by).agg(*net.values()).where("__n > 0")
    return found.select(*keys, *by, F.col("__n").alias(count), *[F.when(F.col(f"__c{i}") > 0, F.col(f"__s{i}")).alias(name) for i, name in enumerate(sums)])


def daily_snapshots(df: DataFrame, added: str, days: list[dt.date], day: str = "snapshot") -> DataFrame:
    """For each day asked for, the rows added on it or before. The result has that many copies of a row at most; ``snapshot_counts`` copies none."""
    asked = F.array(*[F.lit(d) for d in sorted(set(days))]).cast("array<date>")
    return df.withColumn(day, F.explode(F.filter(asked, lambda d: d >= F.to_date(added))))


def snapshot_intervals(df: DataFrame, added: str, removed: str | None = None, by: list[str] = ()) -> DataFrame:
    """``(by, n, desde, ate)``: how many rows are there, from a day to another, both included; ``ate`` is null for the last.

    Rows become changes of a day's number, summed by day before anything is ordered; the running sum goes over days on which something changes. A row
    is there from its day of ``added`` to the one before that of ``removed`` (null: for good); rows without a day never are.
    """
    by = list(by)
    there = df.where(F.col(added).isNotNull())
    changes = there.select(*by, F.to_date(added).alias("desde"), F.lit(1).alias("d"))
    if removed:
        there = there.where(F.to_date(removed) > F.to_date(added)).unionByName(there.where(F.col(removed).isNull()))
        gone = there.where(F.col(removed).isNotNull()).select(*by, F.to_date(removed).alias("desde"), F.lit(-1).alias("d"))
        changes = there.select(*by, F.to_date(added).alias("desde"), F.lit(1).alias("d")).unionByName(gone)
    daily = changes.groupBy(*by, "desde").agg(F.sum("d").alias("d"))
    w = Window.partitionBy(*by).orderBy("desde")
    return daily.select(*by, F.sum("d").over(w).alias("n"), "desde", F.date_sub(F.lead("desde").over(w), 1).alias("ate"))


def snapshot_counts(df: DataFrame, added: str, until: Column, since: Column | None = None, removed: str | None = None, by: list[str] = (), day: str = "snapshot") -> DataFrame:
    """``(by, day, n)`` for each day from the first one (or ``since``) to ``until``: intervals of ``snapshot_intervals`` spread over the days asked for."""
    spans = snapshot_intervals(df, added, removed, by)
    first = F.greatest("desde", since) if since is not None else F.col("desde")
    last = F.least(F.coalesce("ate", until), until)
    return entity_days(spans, first, last, day).select(*by, day, "n")


def compare_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of only one side, and which."""
    left = a.select(key).distinct().withColumn("__a", F.lit(True))
    right = b.select(key).distinct().withColumn("__b", F.lit(True))
    both = left.join(right, key, "full_outer")
    return both.where("__a IS NULL OR __b IS NULL").select(key, F.when(F.col("__a").isNull(), "right").otherwise("left").alias("side"))


def with_exists(df: DataFrame, other: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Whether a row has a match, as a column."""
    there = other.select(*keys).distinct().withColumn("__there", F.lit(True))
    return df.join(there, keys, "left").withColumn(name, F.col("__there").isNotNull()).drop("__there")


def unnest(df: DataFrame, array: str, name: str, how: str = "inner", where: Callable[[Column], Column] | None = None) -> DataFrame:
    """An array as rows; elements are filtered before, not after."""
    values = F.filter(array, where) if where else F.col(array)
    return df.withColumn(name, F.explode_outer(values) if how == "left" else F.explode(values)).drop(array)


def missing_ids(df: DataFrame, col: str) -> DataFrame:
    """Numbers from 1 to the largest id that are not there."""
    top = df.agg(F.max(col)).first()[0] or 0
    return df.sparkSession.range(1, top + 1).toDF(col).join(df.select(col), col, "left_anti")


def with_ancestors(df: DataFrame, id_col: str, parent: str, levels: int) -> DataFrame:
    """``ancestor_1`` … : the parent, its parent, and so on."""
    links = df.select(F.col(id_col).alias("__id"), F.col(parent).alias("__up"))
    out = df.withColumn("ancestor_1", F.col(parent))
    for k in range(2, levels + 1):
        out = out.join(links, F.col(f"ancestor_{k - 1}") == F.col("__id"), "left").withColumn(f"ancestor_{k}", F.col("__up")).drop("__id", "__up")
    return out


def deepest(levels: list[str]) -> Column:
    """The last non-zero level of a flattened tree."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit(0)) for c in reversed(levels)])


def unknown_keys(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Different keys that are not on a list; a null key is unknown."""
    return df.select(key).distinct().join(known.select(key), key, "left_anti")
