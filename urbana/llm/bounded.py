"""Links within a distance inside groups of any size, by tasks of bounded size.

Each member of a group that is too large for a task is measured against one representative, and those within reach are
linked to it (a star). By the triangle inequality a pair within reach that is not wholly linked to the representative has
no member nearer to it than the nearest member outside less the reach: all others are done. What stays too large after
``ROUNDS`` such rounds is dealt in blocks, and every two blocks meet in a task; a row meets ``COPIES`` blocks at a time. No pair is left out.

Groups, sizes and representatives stay tables. A table with one row per large group is broadcast where it is small, by its
rows and bytes; else it is joined by group, and the few groups with much of all bytes meet it in parts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbana.session import cut, discard, scratch_path, scratch_scope

ROUNDS = 6
HEAVY = 1024  # groups with over 1/HEAVY of all bytes are joined in parts; there can be no more than HEAVY
COPIES = 4  # distances of blocks that meet at once: twice as many copies of a row
SMALL_BYTES = 8 << 20  # a table of one row per group is broadcast up to this
Metric = Callable[[list[bytes], list[bytes]], np.ndarray]


def parts_of(weights: DataFrame, key: str, weight: str, heavy: int = HEAVY) -> DataFrame:
    """``(key, parts)`` of the keys that weigh over ``1 / heavy`` of all: ``heavy`` rows at most, and twice as many parts."""
    total = weights.agg(F.sum(weight)).first()[0] or 0
    return F.broadcast(weights.where(F.col(weight) > total / heavy).select(key, F.ceil(F.col(weight) * heavy / max(total, 1)).cast("int").alias("parts")))


def meet(rows: DataFrame, keyed: DataFrame, key: str, item: str, parts: DataFrame, how: str = "inner") -> DataFrame:
    """The join of ``rows`` with ``keyed``, which has one row per key; the rows of heavy keys are dealt to their ``parts`` by ``item``."""
    dealt = rows.join(parts, key, "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64(item, F.lit("part")), F.col("parts")).cast("int"), F.lit(0))).drop("parts")
    spread = keyed.join(parts, key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    return dealt.join(spread, [key, "salt"], how).drop("salt")


def _with(rows: DataFrame, keyed: DataFrame, parts: DataFrame, how: str = "inner", size: str = "0") -> DataFrame:
    """As ``meet``, by broadcast where ``keyed`` is small; ``size`` is the SQL of a row's bytes beside its key."""
    if (keyed.agg(F.sum(F.expr(f"64L + {size}"))).first()[0] or 0) <= SMALL_BYTES:
        return rows.join(F.broadcast(keyed), "grp", how)
    return meet(rows, keyed, "grp", "item", parts, how)


def split(rows: DataFrame, metric: Metric, reach: float, cap: int) -> tuple[DataFrame | None, DataFrame]:
    """Star links ``(a, b)`` (none: no group was too large), and ``rows(grp, item, data)`` still to be compared, with ``part``.

    Pairs of one ``(grp, part)`` are to be compared; no such part holds more than about ``cap`` bytes of ``data``.
    """
    stars, whole, blocks = _thinned(rows, metric, reach, cap)
    met = [] if blocks is None else [_met(blocks, "0", "int(blocks div 2)")]
    return stars, reduce(DataFrame.unionByName, [whole, *met])


def links(rows: DataFrame, metric: Metric, reach: float, cap: int, link: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """Links ``(a, b)`` of ``rows(grp, item, data)``: those of the stars, and what ``link`` finds among the rows of a part, as by ``split``.

    Where groups are compared by blocks, a row meets ``COPIES`` blocks at a time and what they link is stored: so the rows are never copied more than so often at once.
    """
    stars, whole, blocks = _thinned(rows, metric, reach, cap)
    kind = "a binary, b binary"
    found = [*([] if stars is None else [stars]), whole.groupBy("grp", "part").applyInArrow(link, kind)]
    most = 0 if blocks is None else blocks.agg(F.max("blocks")).first()[0] or 0
    for n in range(0, most // 2 + 1 if most else 0, COPIES):  # a block meets itself and the half of the others that follow it
        turn = _met(blocks, f"{n}", f"least({n + COPIES - 1}, int(blocks div 2))")
        found.append(cut(turn.groupBy("grp", "part").applyInArrow(link, kind)))
    return reduce(DataFrame.unionByName, found)


def _met(blocks: DataFrame, low: str, high: str) -> DataFrame:
    """The rows of ``blocks(grp, item, data, own, blocks)`` once for each pair of blocks at a distance of ``low`` to ``high`` round the circle of a group's blocks."""
    step = F.explode(F.expr(f"CASE WHEN {low} <= {high} THEN sequence({low}, {high}) END"))
    ends = F.expr("array_distinct(array(pmod(own + step, blocks), pmod(own - step, blocks)))")
    return blocks.withColumn("step", step).withColumn("other", F.explode(ends)).select("grp", "item", "data", F.concat_ws("-", F.least("own", "other"), F.greatest("own", "other")).alias("part"))


def _thinned(rows: DataFrame, metric: Metric, reach: float, cap: int) -> tuple[DataFrame | None, DataFrame, DataFrame | None]:
    """Star links, the rows of groups of at most ``cap`` bytes, whole, and those of the groups still larger with the block they are dealt to and the number of blocks.

    Each round stores what goes on and what is done, and its other tables go.
    """
    weight = F.sum(F.length("data") + 1).alias("bytes")
    whole = F.lit("").alias("part")
    large = cut(rows.groupBy("grp").agg(weight).where(F.col("bytes") > cap))
    if large.isEmpty():
        return None, rows.select("*", whole), None
    spark, parts = rows.sparkSession, parts_of(large, "grp", "bytes")
    marked = _with(rows, large, parts, "left")
    done, stars = [marked.where("bytes IS NULL").select("grp", "item", "data", whole)], []
    held = scratch_path(spark, "left")
    left = cut(marked.where("bytes IS NOT NULL").select("grp", "item", "data"), held)
    kind = left.schema["grp"].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                far = metric(b.column(2).to_pylist(), b.column(4).to_pylist())
                yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(far, pa.float64())], names=["grp", "item", "data", "centre", "far"])

    for n in range(ROUNDS):
        near, ended, onward, sizes = (scratch_path(spark, x) for x in ("near", "ended", "left", "large"))
        with scratch_scope(spark):
            one = left.groupBy("grp").agg(F.min_by(F.struct("item", "data"), F.xxhash64("item", F.lit(n))).alias("one"))
            centres = cut(one.select("grp", F.col("one.item").alias("centre"), F.col("one.data").alias("centre_data")))
            paired = _with(left, centres, parts, size="length(centre) + length(centre_data)").select("grp", "item", "data", "centre", "centre_data")
            measured = cut(paired.mapInArrow(measure, f"grp {kind}, item binary, data binary, centre binary, far double"))
            discard(spark, held)
            stars.append(cut(measured.where((F.col("far") <= reach) & (F.col("centre") != F.col("item"))).select(F.col("centre").alias("a"), F.col("item").alias("b")), near))
            outside = cut(measured.where(F.col("far") > reach).groupBy("grp").agg(F.min("far").alias("least")))
            open_ = cut(_with(measured, outside, parts).where(F.col("far") >= F.col("least") - reach - 1e-9).select("grp", "item", "data"))
            large = cut(open_.groupBy("grp").agg(weight).where(F.col("bytes") > cap), sizes)
            marked = _with(open_, large, parts, "left")
            done.append(cut(marked.where("bytes IS NULL").select("grp", "item", "data", whole), ended))
            left, held = cut(marked.where("bytes IS NOT NULL").select("grp", "item", "data"), onward), onward
        if large.isEmpty():
            return reduce(DataFrame.unionByName, stars), reduce(DataFrame.unionByName, done), None
    blocks = large.select("grp", F.ceil(2 * F.col("bytes") / cap).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("item", F.lit("block")), F.col("blocks")).cast("int")
    return reduce(DataFrame.unionByName, stars), reduce(DataFrame.unionByName, done), _with(left, blocks, parts).withColumn("own", own)
