"""Spatial clusters."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbana.functions.geo import haversine_m
from urbana.operators.graph import connected_components
from urbana.session import cut

METRES_PER_DEGREE = 111_194.0
PARTS = 8  # parts of a cell's side, for the cell pairs whose distance has to be looked at closely
FEW_PAIRS = 4096  # points of two parts that are compared without refining them
SPLIT, LEVELS = 4, 5  # pieces of a part's side at each level
LEAST_COSINE = 0.01  # cells grow no wider than this towards the poles


def geo_clusters(df: DataFrame, id_col: str, kind: str, lat: str, lon: str, radius_m: float) -> DataFrame:
    """``df`` with ``cluster``: the smallest id of the points of a kind linked by steps of at most ``radius_m``.

    Points go to cells whose diagonal is the radius, so the points of a cell are one node without a pair being made; a
    cell's width in degrees follows its latitude. Neighbouring cells are linked if one point of a part of either is
    within the radius of one of the other's. Only where no such points are, but the parts could still hold some, are
    the points of those parts compared; where these would make many pairs, the parts are refined (see ``_near``). Repeated rows and equal points share a cluster. A point whose coordinates are null is
    its own cluster. Points on either side of longitude 180 are not neighbours, nor are points within half a degree of a
    pole linked reliably. An empty table gives an empty result.
    """
    side = radius_m * 0.998 / math.sqrt(2) / METRES_PER_DEGREE
    part_diagonal = radius_m * 1.01 / PARTS
    placed = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.col(kind).alias("kind"), F.col(lat).alias("lat"), F.col(lon).alias("lon"), F.col(id_col).alias("id"))
    placed = _with_cells(placed, side)
    cell = ["kind", "row", "col"]
    cells = cut(placed.groupBy(*cell).agg(F.min("id").alias("node")))
    points = placed.select(*cell, "part", "lat", "lon").distinct()
    parts = cut(points.groupBy(*cell, "part").agg(F.min(F.struct("lat", "lon")).alias("at"), F.count(F.lit(1)).alias("n")))
    around = _neighbours(parts, side, radius_m)
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) if c == "kind" else F.col(f"a.{c}") == F.col(f"b.{c}") for c in cell]
    metres = haversine_m(F.col("a.at.lat"), F.col("a.at.lon"), F.col("b.at.lat"), F.col("b.at.lon"))
    met = parts.alias("a").join(around.alias("b"), same).withColumn("metres", metres).where(F.col("metres") <= radius_m + 2 * part_diagonal)
    pair = [F.col("a.kind").alias("kind"), F.col("a.row").alias("row"), F.col("a.col").alias("col"), F.col("b.from_row").alias("row2"), F.col("b.from_col").alias("col2")]
    close = cut(met.select(*pair, F.col("a.part").alias("part"), F.col("b.part").alias("part2"), "metres", (F.col("a.n") * F.col("b.n")).alias("pairs")))
    cell_pair = ["kind", "row", "col", "row2", "col2"]
    surely = close.where(F.col("metres") <= radius_m).select(*cell_pair).distinct()
    open_parts = close.alias("o").join(surely.alias("s"), [F.col("o.kind").eqNullSafe(F.col("s.kind")), *[F.col(f"o.{c}") == F.col(f"s.{c}") for c in cell_pair[1:]]], "left_anti").drop("metres")
    many = cut(open_parts.where(F.col("pairs") > FEW_PAIRS).drop("pairs"))
    open_parts = open_parts.where(F.col("pairs") <= FEW_PAIRS).drop("pairs")
    one = points.alias("p").join(open_parts.alias("o"), [F.col("p.kind").eqNullSafe(F.col("o.kind")), *[F.col(f"p.{c}") == F.col(f"o.{c}") for c in ("row", "col", "part")]])
    one = one.select("o.*", "p.lat", "p.lon")
    two = one.alias("o").join(points.alias("q"), [F.col("o.kind").eqNullSafe(F.col("q.kind")), F.col("o.row2") == F.col("q.row"), F.col("o.col2") == F.col("q.col"), F.col("o.part2") == F.col("q.part")])
    found = two.where(haversine_m(F.col("o.lat"), F.col("o.lon"), F.col("q.lat"), F.col("q.lon")) <= radius_m).select("o.kind", "o.row", "o.col", "o.row2", "o.col2")
    linked = surely.unionByName(found.distinct())
    if not many.isEmpty():
        linked = linked.unionByName(_near(many, points, side, part_diagonal, radius_m))
    ends = linked.alias("l").join(cells.alias("x"), [F.col("l.kind").eqNullSafe(F.col("x.kind")), F.col("l.row") == F.col("x.row"), F.col("l.col") == F.col("x.col")])
    ends = ends.join(cells.alias("y"), [F.col("l.kind").eqNullSafe(F.col("y.kind")), F.col("l.row2") == F.col("y.row"), F.col("l.col2") == F.col("y.col")])
    groups = connected_components(ends.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))
    named = cells.join(groups, "node", "left").select(*[F.col(c).alias(f"__{c}") for c in cell], F.coalesce("component", "node").alias("cluster"))
    keyed = _with_cells(df.withColumn("__lat", F.col(lat)).withColumn("__lon", F.col(lon)), side, "__")
    return (
        keyed.join(named, [F.col(kind).eqNullSafe(F.col("__kind")), keyed["__row"] == named["__row"], keyed["__col"] == named["__col"]], "left")
        .select(*[df[c] for c in df.columns if c != "cluster"], F.coalesce("cluster", df[id_col]).alias("cluster"))
    )


def _near(pairs: DataFrame, points: DataFrame, side: float, part_diagonal: float, radius_m: float) -> DataFrame:
    """``(kind, row, col, row2, col2)``: the pairs of cells of ``pairs(..., part, part2)`` of which two points are within the radius.

    Parts are cut into ``SPLIT`` by ``SPLIT`` again and again. Two pieces are linked if a point of either is near one of the other, and done with if these are
    further apart than the radius and both pieces' diagonals; only pieces in between are cut further, and after ``LEVELS`` their points compared. What
    is compared grows with the pieces along the radius, not with the points.
    """
    cell_pair = ["kind", "row", "col", "row2", "col2"]
    same_cells = lambda a, b: [F.col(f"{a}.kind").eqNullSafe(F.col(f"{b}.kind")), *[F.col(f"{a}.{c}") == F.col(f"{b}.{c}") for c in cell_pair[1:]]]
    inner = {"u": F.col("lat") / side - F.col("row"), "v": F.col("lon") / _step(F.col("row"), side) - F.col("col")}
    asked = pairs.select("kind", "row", "col", "part").unionByName(pairs.select("kind", F.col("row2").alias("row"), F.col("col2").alias("col"), F.col("part2").alias("part"))).distinct()
    held = [F.col("p.kind").eqNullSafe(F.col("k.kind")), *[F.col(f"p.{c}") == F.col(f"k.{c}") for c in ("row", "col", "part")]]
    fine = cut(points.alias("p").join(asked.alias("k"), held, "left_semi"))
    open_ = pairs.select(*cell_pair, *[(F.floor(F.col(p) / PARTS) if d == "u" else F.col(p) % PARTS).cast("long").alias(d + n) for p, n in (("part", "1"), ("part2", "2")) for d in ("u", "v")])
    found = []
    for level in range(1, LEVELS + 1):
        cells = PARTS * SPLIT**level
        place = {d: F.least(F.floor(x * cells), F.lit(cells - 1)).cast("long") for d, x in inner.items()}
        pieces = fine.withColumns(place).groupBy("kind", "row", "col", "u", "v").agg(F.min(F.struct("lat", "lon")).alias("at"))
        metres = haversine_m(F.col("x.at.lat"), F.col("x.at.lon"), F.col("y.at.lat"), F.col("y.at.lon"))
        met = _children(open_, pieces, SPLIT).withColumn("metres", metres)
        reach = radius_m + 2 * part_diagonal / SPLIT**level
        met = cut(met.where(F.col("metres") <= reach).select(*[F.col(f"o.{c}").alias(c) for c in cell_pair], *[F.col(f"{t}.{d}").alias(f"{d}{n}") for t, n in (("x", 1), ("y", 2)) for d in ("u", "v")], "metres"))
        linked = cut(met.where(F.col("metres") <= radius_m).select(*cell_pair).distinct())
        found.append(linked)
        open_ = met.alias("m").join(linked.alias("l"), same_cells("m", "l"), "left_anti").drop("metres")
        if open_.isEmpty():
            break
    else:
        last = _children(open_, fine.withColumns(place), 1).where(haversine_m(F.col("x.lat"), F.col("x.lon"), F.col("y.lat"), F.col("y.lon")) <= radius_m)
        found.append(last.select(*[F.col(f"o.{c}").alias(c) for c in cell_pair]).distinct())
    return functools.reduce(DataFrame.unionByName, found).distinct()


def _children(open_: DataFrame, pieces: DataFrame, split: int) -> DataFrame:
    """The pairs ``x``, ``y`` of pieces inside the pairs ``o`` of larger ones."""
    sides = []
    for t, n, row, col in (("x", 1, "row", "col"), ("y", 2, "row2", "col2")):
        sides.append([F.col("o.kind").eqNullSafe(F.col(f"{t}.kind")), F.col(f"o.{row}") == F.col(f"{t}.row"), F.col(f"o.{col}") == F.col(f"{t}.col"), *[F.col(f"o.{d}{n}") == F.floor(F.col(f"{t}.{d}") / split) for d in ("u", "v")]])
    return open_.alias("o").join(pieces.alias("x"), sides[0]).join(pieces.alias("y"), sides[1])


def _step(row: Column, side: float) -> Column:
    """The width in degrees of the cells of a row, at its latitude farthest from the pole no wider than a side."""
    equatorward = F.when(row >= 0, row * side).otherwise((row + 1) * side)
    return side / F.greatest(F.cos(F.radians(equatorward)), F.lit(LEAST_COSINE))


def _with_cells(points: DataFrame, side: float, prefix: str = "") -> DataFrame:
    lat, lon, row, col, part = (f"{prefix}{c}" for c in ("lat", "lon", "row", "col", "part"))
    step = _step(F.col(row), side)
    inner = [F.least(F.floor((F.col(x) / w - F.col(c)) * PARTS), F.lit(PARTS - 1)) for x, w, c in ((lat, F.lit(side), row), (lon, step, col))]
    cells = points.withColumn(row, F.floor(F.col(lat) / side)).withColumn(col, F.floor(F.col(lon) / step))
    return cells.withColumn(part, inner[0] * PARTS + inner[1])


def _neighbours(parts: DataFrame, side: float, radius_m: float) -> DataFrame:
    """Each part once for each later cell that may hold a point within the radius: ``row`` and ``col`` are that cell's."""
    rows = parts.select("kind", F.col("row").alias("from_row"), F.col("col").alias("from_col"), "part", "at", "n", F.explode(F.sequence(F.col("row"), F.col("row") + 2)).alias("row"))
    poleward = F.greatest(F.abs(F.col("from_row") * side), F.abs((F.col("row") + 1) * side))
    reach = radius_m * 1.001 / METRES_PER_DEGREE / F.greatest(F.cos(F.radians(poleward)), F.lit(LEAST_COSINE))
    west, east = F.col("from_col") * _step(F.col("from_row"), side), (F.col("from_col") + 1) * _step(F.col("from_row"), side)
    to = _step(F.col("row"), side)
    cells = rows.select("*", F.explode(F.sequence(F.floor((west - reach) / to), F.floor((east + reach) / to))).alias("col"))
    return cells.where("row > from_row OR col > from_col")


def emit_decision(clusters: DataFrame, now, n: int = 5, minutes: int = 7) -> DataFrame:
    """Whether a cluster is sent: at once from ``n`` reports, or when its oldest is old enough; and why."""
    age = F.timestamp_diff("MINUTE", F.col("mais_antigo"), F.lit(now))
    reason = F.when(F.col("n") >= n, "count").when(age >= minutes, "age").otherwise("wait")
    return clusters.withColumn("motivo", reason).withColumn("enviar", F.col("motivo") != "wait")
