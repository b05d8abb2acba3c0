"""Variable-capacity best-fit packing of documents into training sequences.

Documents are dealt at random to groups of a fixed expected size; each group is packed by one task: pieces in
falling order of length go to the open bin that they leave least room in. Where none has room a bin is opened: for
each permitted size, the pieces still to come are tried in it (falling lengths, each if it fits), and the size that
costs least for each token it would hold is taken. At the end every bin is cut down to the smallest permitted size
that holds its contents.

A bin of ``c`` tokens costs ``c * (1 + c / ATTENTION) + OVERHEAD``: attention makes long sequences dearer by the token, so a
long bin is opened only for pieces that need it or where it is filled so much better; many short bins pay their overheads.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbana.llm.arrow import with_columns
from urbana.session import cut

CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 32  # what opening a bin costs, in tokens
ATTENTION = 16384  # length at which attention costs as much as all that is linear in the length
GROUP_ROWS = 2048  # documents that are packed together
OUT = "doc_id bigint, piece int, start bigint, length bigint, bin_id bigint, bin_capacity int, bin_offset int"


def bin_cost(capacity: int) -> float:
    return capacity * (1 + capacity / ATTENTION) + OVERHEAD


def filled(lengths: list[int], count: list[int], first: int, capacity: int) -> int:
    """Tokens in a bin of a capacity that gets a piece of ``lengths[first]`` and then, of the falling lengths, as many of each as fit."""
    room, k = capacity - lengths[first], first
    spare = count[first] - 1
    while room and k < len(lengths):
        if lengths[k] > room:
            k = bisect.bisect_left(lengths, -room, k, key=lambda x: -x)
            continue
        take = min(spare if k == first else count[k], room // lengths[k])
        room -= take * lengths[k]
        k += 1
    return capacity - room


def pack(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES, cost: Callable[[int], float] = bin_cost) -> tuple[list[tuple[int, int]], list[int]]:
    """(bin, offset in it) of each length, and the final size of each bin. Lengths are 1 to the largest capacity; of equal lengths the
    first goes first, of equally full bins the first opened, of equally good sizes the smallest."""
    sizes = sorted(capacities)
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    kinds = sorted(set(lengths), reverse=True)
    place = {n: k for k, n in enumerate(kinds)}
    count = [0] * len(kinds)
    for n in lengths:
        count[place[n]] += 1
    free: list[tuple[int, int]] = []  # (room, bin), sorted
    room, used, at = [], [], [(0, 0)] * len(lengths)
    for i in order:
        n = lengths[i]
        k = bisect.bisect_left(free, (n, -1))
        if k < len(free):
            _, b = free.pop(k)
        else:
            b = len(room)
            size = min((c for c in sizes if c >= n), key=lambda c: (cost(c) / filled(kinds, count, place[n], c), c))
            room.append(size)
            used.append(0)
        count[place[n]] -= 1
        at[i] = (b, used[b])
        used[b] += n
        if room[b] > used[b]:
            bisect.insort(free, (room[b] - used[b], b))
    return at, [next(c for c in sizes if c >= u) for u in used]


def word_lengths(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_tokens``: the words of each whole text, of any length, and an end mark. A null or empty text is the mark alone; repeated rows stay;
    a column of that name is replaced; an empty table gives an empty result."""

    def compute(rows: list[bytes]) -> list[pa.Array]:
        return [pa.array([len(t.split()) + 1 for t in rows], pa.int64())]

    return with_columns(docs, text, "n_tokens bigint", compute, keep)


def best_fit(lengths: DataFrame, id_col: str = "doc_id", length: str = "n_tokens", capacities: tuple[int, ...] = CAPACITIES, group_rows: int = GROUP_ROWS, group: Column | None = None) -> DataFrame:
    """Where each piece of each document goes: ``(doc_id, piece, start, length, bin_id, bin_capacity, bin_offset)``.

    A document longer than the largest capacity is cut into pieces of that capacity and a last one. Null and
    non-positive lengths take no room and give no row. Repeated rows are packed each; null ids are packed like any other, ties of
    length go by id. Lengths are written once and groups are dealt by a hash of each written row's number, so a hot id or a run of
    copies spreads, and a lost executor deals nothing anew. An empty table gives an empty result; other columns are not read.
    """
    most = max(capacities)
    rows = cut(lengths.select(F.col(id_col).cast("long").alias("doc_id"), F.col(length).cast("long").alias("n")).where("n > 0"))
    groups = max(1, math.ceil(rows.count() / group_rows))
    dealt = rows.withColumn("g", group if group is not None else F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def run(t: pa.Table) -> pa.Table:
        order = np.lexsort((t.column("n").to_numpy(), t.column("doc_id").fill_null(-(2**63)).to_numpy()))
        ids, ns, g = t.column("doc_id").take(pa.array(order)).to_pylist(), t.column("n").to_numpy()[order].tolist(), t.column("g")[0].as_py()
        pieces = [(i, p, p * most, min(most, n - p * most)) for i, n in zip(ids, ns, strict=True) for p in range(-(-n // most))]
        at, sizes = pack([x[3] for x in pieces], capacities)
        columns = list(zip(*[(*x, (g << 32) | b, sizes[b], o) for x, (b, o) in zip(pieces, at, strict=True)], strict=True))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in OUT.split(", ")])

    return dealt.groupBy("g").applyInArrow(run, OUT)
