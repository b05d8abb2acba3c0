"""Choosing, ranking, sampling and batching rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbana.operators import scan
from urbana.session import cut


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in an explicit order (null keys are one key). Give tie keys for a fixed result."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def latest_by(df: DataFrame, keys: list[str], ts: str, ties: list[str] = ()) -> DataFrame:
    """The latest row of each key; ties go to the greatest of the tie columns. One partial aggregate: no sort of a hot key."""
    rank = F.struct(F.col(ts), *[F.col(t) for t in ties])
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*others), rank).alias("__row"))
    return best.select(*keys, "__row.*").select(*df.columns)


def seeded_order(df: DataFrame, id_col: str, seed: str, rank: str = "rank") -> DataFrame:
    """A global shuffle that can be repeated: ``rank`` from 1 by md5(id + seed), then id.

    Rows are dealt by ranges of the hash and numbered in their partition; the counts of the partitions before are
    added. No task sees all rows.
    """
    key = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(seed)))
    return global_rank(df.withColumn("__key", key), ["__key", id_col], rank).drop("__key")


def global_rank(df: DataFrame, order: list[str], rank: str = "rank") -> DataFrame:
    """Row numbers over the whole table: rows are numbered in ranges as these are dealt, and the counts of the ranges before are joined. One shuffle."""
    placed = cut(scan.dealt(df, order))
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offsets = sizes.select("__part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("__before"))
    return placed.join(F.broadcast(offsets), "__part").withColumn(rank, F.col("__row") + F.col("__before") + 1).drop("__part", "__row", "__before")


def escalating_groups(df: DataFrame, rank: str = "rank") -> DataFrame:
    """Experiment groups that grow: the group of a rank, and its target size."""
    g = F.ceil((F.sqrt(22500 + 200 * F.col(rank).cast("double")) - 150) / 100).cast("long")
    return df.withColumn("grupo", g).withColumn("alvo", 100 * (F.col("grupo") + 1))


def hash_batch(c: Column, n: int) -> Column:
    """A stable batch number, in place of paging by offset."""
    return F.pmod(F.xxhash64(c), F.lit(n))


def seeded_sample(df: DataFrame, key: str, percent: float, seed: str) -> DataFrame:
    """About a percentage of the different keys: the same ones each time, whatever the partitioning."""
    draw = F.conv(F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))), 1, 8), 16, 10).cast("long")
    return df.where(draw < int(percent / 100 * 2**32))


def batches(df: DataFrame, keys: list[str], order: list[str], size: int, label: str) -> DataFrame:
    """Batches of ``size`` rows within each key, numbered and labelled. The numbering is a segmented scan: few keys don't make few tasks."""
    ranked = scan.running_sum(df, keys, order, F.lit(1), "lote")
    return ranked.withColumn("lote", F.ceil(F.col("lote") / size).cast("long")).withColumn("rotulo", F.concat(F.lit(label), F.col("lote").cast("string")))


def dedupe_names(df: DataFrame, group: list[str], name: str, order: list[str]) -> DataFrame:
    """Repeated names of a group numbered: ``x``, ``x_2``, ``x_3``."""
    n = F.row_number().over(Window.partitionBy(*group, name).orderBy(*order))
    return df.withColumn(name, F.when(n == 1, F.col(name)).otherwise(F.concat(F.col(name), F.lit("_"), n.cast("string"))))


def fold_continuations(df: DataFrame, part: list[str], order: str, key: str, text: str) -> DataFrame:
    """Rows without a key go to the keyed row before, their texts joined by a blank in order.

    Blocks are numbered by a segmented scan, so that a part may hold any share of the rows; a task joins the texts of one keyed row.
    """
    grouped = scan.running_sum(df, part, [order], F.col(key).isNotNull().cast("int"), "__block").groupBy(*part, "__block")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))), lambda x: x["t"]), " ")
    return grouped.agg(F.min(order).alias(order), F.max(key).alias(key), whole.alias(text)).drop("__block")


def version_matrix(df: DataFrame, entity: str, version: str, col: str) -> DataFrame:
    """For every version and column of an entity, whether it is there, and whether it is in the version before and after."""
    here = df.select(entity, version, col).distinct()
    grid = here.select(entity, version).distinct().join(here.select(entity, col).distinct(), entity)
    full = grid.join(here.withColumn("__on", F.lit(True)), [entity, version, col], "left").withColumn("presente", F.coalesce("__on", F.lit(False))).drop("__on")
    w = Window.partitionBy(entity, col).orderBy(version)
    return full.withColumn("na_anterior", F.coalesce(F.lag("presente").over(w), F.lit(False))).withColumn("na_seguinte", F.coalesce(F.lead("presente").over(w), F.lit(False)))


def version_carry(df: DataFrame, entity: str, version: str, col: str) -> DataFrame:
    """Columns of a layout with the versions they belong to, and those they are known to be absent from: ``(…, outra, presente)``.

    A column that an entity's version has is present in it. One that the version before lacks is absent from that version and
    all older ones, one that the version after lacks is absent from that and all newer ones. Versions are those of all entities.
    They are the releases of a layout: one row of them is broadcast.
    """
    here = df.select(entity, version, col).distinct()
    w = Window.partitionBy(entity).orderBy(version)
    steps = here.select(entity, version).distinct().withColumns({"__before": F.lag(version).over(w), "__after": F.lead(version).over(w)})
    near = here.join(steps, [entity, version])

    def absent(side: str) -> DataFrame:
        lacks = near.where(F.col(side).isNotNull()).join(here.select(entity, F.col(version).alias(side), col), [entity, side, col], "left_anti")
        return lacks.select(entity, version, col, F.col(side).alias("__from"), F.lit(side == "__before").alias("__down"))

    book = here.agg(F.array_sort(F.collect_set(version)).alias("__book"))
    gone = absent("__before").unionByName(absent("__after")).crossJoin(F.broadcast(book))  # one row
    reached = F.filter("__book", lambda x: F.when(F.col("__down"), x <= F.col("__from")).otherwise(x >= F.col("__from")))
    carried = gone.select(entity, version, col, F.explode(reached).alias("outra"), F.lit(False).alias("presente"))
    return here.select(entity, version, col, F.col(version).alias("outra"), F.lit(True).alias("presente")).unionByName(carried)


def dedupe_equivalents(df: DataFrame, ticket: str, person: str, order: list[str]) -> DataFrame:
    """Within a ticket one row of each person, the first in order; rows without a person all stay."""
    n = F.row_number().over(Window.partitionBy(ticket, person).orderBy(*order))
    return df.withColumn("__rn", n).where(F.col(person).isNull() | (F.col("__rn") == 1)).drop("__rn")
