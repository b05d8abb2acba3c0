"""Running state within keys of any size: segmented scans over ranges of (key, order).

Rows are dealt by ranges of key and order, so a hot key lies in as many parts as its rows need. Every part is scanned by itself, with what
is known inside it; one row for each part then says how the parts before change the rows of its first key (its head), and these rows
are put right. What is combined, and broadcast, is a row for each partition; no task holds a key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbana.session import cut

ROW_BITS = 33  # of monotonically_increasing_id: the row within its partition
Local = Callable[[pa.RecordBatch, np.ndarray, dict], list[pa.Array]]


def dealt(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` sorted into ranges of ``order``, with ``__part`` and, from 0, ``__row`` in it: numbered as they are dealt, by one shuffle."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    row = F.col("__id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return placed.withColumns({"__part": F.shiftright("__id", ROW_BITS).cast("int"), "__row": row}).drop("__id")


def _begins(batch: pa.RecordBatch, keys: list[str], before: list | None) -> np.ndarray:
    """Whether each row begins a key; null keys are one key. ``before``: the keys of the row before the batch."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = before is None
    for i, k in enumerate(keys):
        col = batch.column(batch.schema.get_field_index(k))
        a, b = col.slice(0, len(col) - 1), col.slice(1)
        same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        new[1:] |= ~np.asarray(same)
        new[0] |= new[0] or before[i] != col[0].as_py()
    return new


def _scanned(rows: DataFrame, keys: list[str], added: list[T.StructField], local: Local) -> DataFrame:
    """``rows`` in their order with ``__head`` (the row's key is the first of its partition) and the columns that ``local`` makes of each batch."""
    schema = T.StructType([*rows.schema.fields, T.StructField("__head", T.BooleanType()), *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, head, state = None, True, {}
        for b in batches:
            if not b.num_rows:
                continue
            new = _begins(b, keys, before)
            later = np.cumsum(new) - (before is None) > 0
            heads = head & ~later
            head = bool(heads[-1])
            got = local(b, new, state)
            before = [b.column(b.schema.get_field_index(k))[b.num_rows - 1].as_py() for k in keys]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(heads), *got], names=[f.name for f in schema.fields])

    return rows.mapInArrow(run, schema)


def _sums(columns: list[str]) -> Local:
    """The running sum of each column since its key began."""

    def local(b: pa.RecordBatch, new: np.ndarray, state: dict) -> list[pa.Array]:
        start = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
        out = []
        for column in columns:
            amounts = np.asarray(b.column(b.schema.get_field_index(column)).cast(pa.int64()))
            total = np.cumsum(amounts)
            own = total - np.where(start >= 0, (total - amounts)[np.maximum(start, 0)], -state.get(column, 0))
            state[column] = int(own[-1])
            out.append(pa.array(own))
        return out

    return local


def _parts(marked: DataFrame, keys: list[str], last: list[str], first: list[str] = ()) -> DataFrame:
    """A row for each part: the values of its last row (and of its first), whether its first key fills it (``whole``) and goes on from the part before (``continued``)."""
    key = F.struct(F.lit(0).alias("all"), *[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"k{i}") for i, k in enumerate(keys)], *[F.col(k).isNull().alias(f"n{i}") for i, k in enumerate(keys)])
    ends = F.max_by(F.struct(key.alias("key"), *last), "__row").alias("end")
    begins = F.min_by(F.struct(key.alias("key"), *first), "__row").alias("begin")
    found = cut(marked.groupBy("__part").agg(ends, begins, F.min("__head").alias("whole")))
    w = Window.orderBy("__part")  # a row for each partition
    return found.withColumn("continued", F.coalesce(F.col("begin.key") == F.lag("end.key").over(w), F.lit(False)))


def running_sum(df: DataFrame, keys: list[str], order: list[str], amount: Column, name: str) -> DataFrame:
    """``running_sums`` of one number."""
    return running_sums(df, keys, order, {name: amount})


def running_sums(df: DataFrame, keys: list[str], order: list[str], amounts: dict[str, Column]) -> DataFrame:
    """``df`` with the sums, from its key's first row to each row, of whole numbers (null is 0). Without keys the table is one key.

    Rows with equal order have an arbitrary order between them. Rows without a key are one key; an empty table gives an empty result.
    """
    n = range(len(amounts))
    own, sums, carry = ([f"__{x}{i}" for i in n] for x in ("amount", "sum", "carried"))
    rows = dealt(df.withColumns({own[i]: F.coalesce(a.cast("long"), F.lit(0)) for i, a in enumerate(amounts.values())}), [*keys, *order])
    marked = cut(_scanned(rows, keys, [T.StructField(x, T.LongType()) for x in sums], _sums(own)))
    w = Window.orderBy("__part")
    before = {f"before{i}": F.when(F.col("continued"), F.lag(f"end.{sums[i]}").over(w)).otherwise(0) for i in n}
    chain = F.sum(F.when(F.col("continued") & F.lag("whole").over(w), 0).otherwise(1)).over(w)
    parts = _parts(marked, keys, sums).withColumns(before | {"chain": chain})
    carried = parts.select("__part", *[F.sum(f"before{i}").over(Window.partitionBy("chain").orderBy("__part")).alias(carry[i]) for i in n])
    totals = {name: F.col(sums[i]) + F.when(F.col("__head"), F.col(carry[i])).otherwise(0) for i, name in enumerate(amounts)}
    return marked.join(F.broadcast(carried), "__part").withColumns(totals).drop("__part", "__row", "__head", *own, *sums, *carry)


def _micros(b: pa.RecordBatch, ts: str) -> np.ndarray:
    return np.asarray(b.column(b.schema.get_field_index(ts)).cast(pa.int64()))


def gaps(df: DataFrame, keys: list[str], ts: str, seconds: int, ties: list[str], number: str, start: str) -> DataFrame:
    """``df`` with each row's session in its key (``number`` from 1) and the time the session began: a new one after more than a gap of whole seconds.

    A row without a time begins no session and ends none: its key's sessions go on past it, and before the first time it is in session 0.
    """
    kind = df.schema[ts].dataType
    rows = dealt(df, [*keys, ts, *ties])
    added = [T.StructField("__n", T.LongType()), T.StructField("__start", kind)]

    def local(b: pa.RecordBatch, new: np.ndarray, state: dict) -> list[pa.Array]:
        col = b.column(b.schema.get_field_index(ts))
        there = np.asarray(pc.is_valid(col))
        full = np.asarray(pc.fill_null(col.cast(pa.int64()), 0))
        before = np.concatenate([[state.get("last", 0)], full[:-1]])  # nulls sort first, so the row before one with a time has a time too
        known = np.concatenate([[state.get("there", False)], there[:-1]]) & ~new
        fresh = there & (~known | ((full - before) // 1_000_000 > seconds))
        count = np.cumsum(fresh)
        first = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
        own = count - np.where(first >= 0, (count - fresh)[np.maximum(first, 0)], -state.get("n", 0))
        begun = np.maximum.accumulate(np.where(fresh, np.arange(len(new)), -1))
        inside = begun >= np.maximum(first, 0)
        starts = np.where(inside, full[np.maximum(begun, 0)], state.get("start", 0))
        none = own == 0
        state.update(last=int(full[-1]), there=bool(there[-1]), n=int(own[-1]), start=int(starts[-1]))
        return [pa.array(own), pa.array(starts, pa.int64(), mask=none).cast(col.type)]

    marked = cut(_scanned(rows, keys, added, local))
    w = Window.orderBy("__part")
    parts = _parts(marked, keys, ["__n", "__start", F.col(ts).alias("at")], [F.col(ts).alias("at")])
    joined = F.col("continued") & F.coalesce(F.timestamp_diff("SECOND", F.lag("end.at").over(w), F.col("begin.at")) <= seconds, F.lit(False))
    parts = parts.withColumn("joined", joined)
    parts = parts.withColumn("n", F.col("end.__n") - F.when(F.col("whole") & F.col("joined"), 1).otherwise(0))
    begun = F.when(~F.col("whole") | (F.col("n") > 0), F.col("end.__start"))
    chain = F.sum(F.when(F.col("continued") & F.lag("whole").over(w), 0).otherwise(1)).over(w)
    parts = parts.withColumns({"before": F.when(F.col("continued"), F.lag("n").over(w)).otherwise(0), "chain": chain, "__from": F.last(begun, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))})
    carried = parts.select("__part", F.col("joined").alias("__joined"), "__from", F.sum("before").over(Window.partitionBy("chain").orderBy("__part")).alias("__carried"))
    own = F.col("__n") - F.when(F.col("__head") & F.col("__joined"), 1).otherwise(0)
    total = own + F.when(F.col("__head"), F.col("__carried")).otherwise(0)
    since = F.when(F.col("__head") & F.col("__joined") & (own == 0), F.col("__from")).otherwise(F.col("__start"))
    return marked.join(F.broadcast(carried), "__part").withColumns({number: total, start: since}).drop("__part", "__row", "__head", "__n", "__start", "__joined", "__from", "__carried")


# --- sessions of a fixed length from their first row -------------------------------------------------


def _chain(at: np.ndarray, new: np.ndarray, span: int, anchor: int | None, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Session number and start of sorted times, from a session ``n`` that began at ``anchor``; ``new`` begins a key."""
    begins, numbers = [], []
    bounds = [*np.nonzero(new)[0].tolist(), len(at)]
    lo = 0
    for hi in bounds:
        if hi > lo:
            i = lo if anchor is None else int(np.searchsorted(at[lo:hi], anchor + span, "right")) + lo
            if i > lo:
                begins.append((lo, anchor))
                numbers.append(n)
            while i < hi:
                anchor, n = int(at[i]), n + 1
                begins.append((i, anchor))
                numbers.append(n)
                i = int(np.searchsorted(at[i:hi], anchor + span, "right")) + i
        lo = hi
        if hi < len(at):
            anchor, n = None, 0
    lengths = np.diff(np.array([b for b, _ in begins] + [len(at)]))
    return np.repeat(np.array(numbers, np.int64), lengths), np.repeat(np.array([a for _, a in begins], np.int64), lengths)


def _steps(at: np.ndarray, span: int) -> list[tuple[int, int, int]]:
    """What a stretch of a key's sorted different times does to a session that comes in: ``(least, out, n)``, for sessions begun after ``least``
    the last session's start (of those that began before the stretch, itself: the least number) and how many began. A few steps: chains soon meet."""
    none = -(1 << 63)
    m = len(at)
    to = np.append(np.searchsorted(at, at + span, "right"), m)
    last, count = np.arange(m + 1), np.append(np.ones(m, np.int64), 0)
    while (to < m).any():  # pointers doubled: each start's last start, and the number of starts
        count = count + np.where(to < m, count[to], 0)
        last = np.where(to < m, last[to], last)
        to = np.where(to < m, to[to], m)
    ends = np.append(at, none)[last]
    entries = int(np.searchsorted(at, at[0] + span, "right")) + 1  # a session that came in began before the stretch
    out: list[tuple[int, int, int]] = []
    for e in range(min(entries, m + 1)):
        step = (none if e == 0 else int(at[e - 1]) - span - 1, int(ends[e]), int(count[e]) if e < m else 0)
        if not out or out[-1][1:] != step[1:]:
            out.append(step)
    return out


def anchored(df: DataFrame, keys: list[str], ts: str, micros: int, number: str, start: str) -> DataFrame:
    """``df`` with each row's session in its key (``number`` from 1) and its start: a session takes the rows up to ``micros`` after its first one.

    Where a key goes on from the part before, its stretch is summed up as a step function of the session that comes in; the functions are applied
    in the order of the parts, and then the rows of these stretches are numbered with what comes in. Rows without a time must be left out before.
    """
    kind = df.schema[ts].dataType
    rows = dealt(df, [*keys, ts])
    added = [T.StructField("__n", T.LongType()), T.StructField("__start", kind)]

    def local(b: pa.RecordBatch, new: np.ndarray, state: dict) -> list[pa.Array]:
        at = _micros(b, ts)
        n, begun = _chain(at, new, micros, None if new[0] else state.get("start"), 0 if new[0] else state.get("n", 0))
        state.update(n=int(n[-1]), start=int(begun[-1]))
        return [pa.array(n), pa.array(begun).cast(b.column(b.schema.get_field_index(ts)).type)]

    marked = cut(_scanned(rows, keys, added, local))
    parts = cut(_parts(marked, keys, ["__n", "__start"]).select("__part", "whole", "continued", F.col("end.__n").alias("n"), F.col("end.__start").alias("start")))
    again = F.broadcast(parts.where("continued").select("__part"))
    heads = marked.join(again, "__part", "left_semi").where("__head")
    count = (parts.agg(F.max("__part")).first()[0] or 0) + 1

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column(0), _micros(b, "at")) for b in batches if b.num_rows]
        if got:
            at = np.unique(np.concatenate([x for _, x in got]))
            steps = np.array(_steps(at, micros), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([got[0][0][0].as_py()] * len(steps), pa.int32()), *[pa.array(steps[:, i]) for i in range(3)]], names=["__part", "least", "out", "n"])

    times = heads.select("__part", F.col(ts).alias("at")).distinct().repartitionById(count, "__part")
    steps = times.mapInArrow(summed, "__part int, least bigint, out bigint, n bigint").groupBy("__part").agg(F.array_sort(F.collect_list(F.struct("least", "out", "n"))).alias("steps"))

    def combine(table: pa.Table) -> pa.Table:
        anchor, n, out = None, 0, []
        ends = table.column("start").cast(pa.int64()).to_pylist()
        every = sorted(zip(table.column("__part").to_pylist(), table.column("whole").to_pylist(), table.column("continued").to_pylist(), table.column("n").to_pylist(), ends, table.column("steps").to_pylist(), strict=True), key=lambda x: x[0])
        for part, whole, continued, end_n, end, own in every:
            if continued:
                out.append((part, anchor, n))
            if whole and continued:
                step = [s for s in own if s["least"] < anchor or s is own[0]][-1]
                anchor, n = (step["out"] if step["n"] else anchor), n + step["n"]
            else:
                anchor, n = end, end_n
        return pa.table({"__part": pa.array([x[0] for x in out], pa.int32()), "__anchor": pa.array([x[1] for x in out], pa.int64()), "__before": pa.array([x[2] for x in out], pa.int64())})

    carried = parts.join(steps, "__part", "left").withColumn("__all", F.lit(0)).groupBy("__all").applyInArrow(combine, "__part int, __anchor bigint, __before bigint")  # a row for each partition, with its few steps

    names = [*df.columns, "__n", "__start"]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor = n = None
        for b in batches:
            if not b.num_rows:
                continue
            if anchor is None:
                anchor, n = b.column(b.num_columns - 2)[0].as_py(), b.column(b.num_columns - 1)[0].as_py()
            numbers, begun = _chain(_micros(b, ts), np.zeros(b.num_rows, bool), micros, anchor, n)
            anchor, n = int(begun[-1]), int(numbers[-1])
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(numbers), pa.array(begun).cast(b.column(b.schema.get_field_index(ts)).type)], names=names)

    open_ = heads.join(F.broadcast(carried), "__part").repartitionById(count, "__part").sortWithinPartitions(ts)
    redone = open_.select(*df.columns, "__anchor", "__before").mapInArrow(finish, T.StructType([*df.schema.fields, *added]))
    right = marked.join(again.withColumn("__again", F.lit(True)), "__part", "left").where("NOT (__head AND coalesce(__again, false))")
    return right.select(*df.columns, "__n", "__start").unionByName(redone).withColumnsRenamed({"__n": number, "__start": start})
