"""N-gram Jaccard join by counts of hashed groups: slices of counts find candidates, R-trees over count vectors prune them, sets decide.

A set of shingles is a point: shingles are hashed into groups, and a coordinate counts a group. The sum over groups of the lesser of two
counts is at least the size of the intersection; in a box of points the greatest counts bound it for all of them.

Two steps use that bound. *Over all documents* it is used by slices of groups. Let ``a <= b`` be the sizes of two linked sets: they differ in
``(a + b) / 9`` shingles at most, and so in no more of the slices that the groups are cut into. Put in one order, whatever it is,
the slices that two such sets have alike begin within the first ``(a + b) / 9 + 1`` of each. The order is by how many sets have a slice as it is: a set meets others by
its rarest ones, so that passages and lines that many texts share do not join these. (With fewer slices than differences a box must be searched around each point, and at this similarity boxes of unrelated texts overlap: a tree over whole
vectors deals nearly every point to nearly every shard.) Sets are banded by size, the number of slices follows the band, and documents meet by
shuffles on (band, slice, hash of the slice's counts, a group being a hash). Slices without shingles say nothing: a set that has too few others,
and any small set, also meets others by its rarest groups themselves. Sets that meet are joined to components.
*Inside a component* of sets an R-tree over counts in coarser groups, packed by median cuts, is searched for each set; what its boxes and
points can't rule out is compared set by set, exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbana.llm.arrow import slices as batches_of
from urbana.llm.arrow import texts, with_columns
from urbana.llm.simhash import SEED, _mix, shingles, verified
from urbana.operators.graph import connected_components
from urbana.session import cut, settled

LEAST = 0.8
SMALL = 16  # sets of up to so many shingles meet by their leading groups alone
BAND = 1.6  # greatest size of a band over its least
SPARE = 1.25  # slices for each that two linked sets may differ in
SAMPLE = 16384  # texts from which frequent slices are known, chosen by a hash of the text
FREQUENT = 8  # texts of the sample that make a slice frequent
LEAF = 16  # points of a leaf of the R-tree, and boxes of a node


# --- slices of counts over all documents -------------------------------------------------------------


def bands() -> list[tuple[int, int, int]]:
    """``(least, end, slices)`` of each size band, for sets of any number of shingles."""
    out, low = [], SMALL + 1
    while low < 1 << 40:
        end = math.ceil(low * BAND)
        most = (end - 1 + math.floor(1.25 * (end - 1))) // 9
        out.append((low, end, math.ceil(SPARE * (most + 1)) + 1))
        low = end
    return out


BANDS = bands()
FAMILY = np.uint64(63)  # of a key, the bits that number its family: a band, or after these the shingles themselves


def needed(n: int, family: int) -> int:
    """Of the keys of a family, in whatever order all keys are, a set of ``n`` shingles meets every similar one by so many of its first."""
    if family == len(BANDS):
        return n - -(-4 * n // 5) + 1
    end = BANDS[family][1]
    return (n + (math.floor(1.25 * n) if n < end else end - 1)) // 9 + 1


def slice_keys(h: np.ndarray) -> np.ndarray:
    """The keys by which a set of distinct hashes may meet others, in one or more families; the six low bits number a key's family."""
    n = len(h)
    if n < 4:  # no other set is similar to these
        return np.zeros(0, np.uint64)
    found = []
    leading = n <= SMALL + SMALL // 4
    if n > SMALL:
        spread = _mix(h ^ np.uint64(0xA5A5A5A55A5A5A5A))
        for i, (low, end, slices) in enumerate(BANDS):
            if low > n:
                break
            if 4 * n > 5 * (end - 1):  # the smaller set of a pair is of this band
                continue
            of = ((spread >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64)
            by = np.argsort(of, kind="stable")
            of = of[by]
            first = np.nonzero(np.concatenate([[True], of[1:] != of[:-1]]))[0]
            sums = np.add.reduceat(spread[by], first)
            keys = _mix(_mix(sums + (of[first] + 1).astype(np.uint64)) + np.uint64(i + 1))
            found.append(keys & ~FAMILY | np.uint64(i))
            leading |= len(keys) < needed(n, i)
    if leading:
        found.append(_mix(h) & ~FAMILY | np.uint64(len(BANDS)))
    return np.concatenate(found)


def spares(keys: np.ndarray, n: int) -> np.ndarray:
    """For each of the keys of a set of ``n`` shingles, how many of its family the set can do without."""
    families, at, count = np.unique(keys & FAMILY, return_inverse=True, return_counts=True)
    return np.array([max(c - needed(n, int(f)), 0) for f, c in zip(families, count)], np.int32)[at]


def meetings(docs: DataFrame, shingle: int) -> DataFrame:
    """``(key, node, spare)`` of the sets of ``docs(text)``; a task names a set once. Long texts make a key for each four words or so."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches_of(batches):
            keys, nodes, spare = [], [], []
            for t in texts(b, "text"):
                h = np.unique(shingles(t.lower().split(), shingle))
                node = xxhash.xxh3_128_intdigest(h.tobytes(), SEED) >> 64
                if node in seen:
                    continue
                seen.add(node)
                own = slice_keys(h)
                keys.append(own)
                nodes.append(np.full(len(own), node, np.uint64))
                spare.append(spares(own, len(h)))
            if keys:
                arrays = [np.concatenate(keys).view(np.int64), np.concatenate(nodes).view(np.int64), np.concatenate(spare)]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, arrays)), names=["key", "node", "spare"])

    return docs.select("text").mapInArrow(run, "key bigint, node bigint, spare int")


def candidates(docs: DataFrame, shingle: int) -> DataFrame:
    """``(node, grp)``: the component, by shared keys, of every set that shares one of its rarest.

    Keys are counted over all sets, and each set leaves out the most frequent that it can do without. A sample of texts shows the very frequent keys: these are not
    counted but come last, by their number in the sample, and their rows are dealt in parts by node; what the parts begin with is joined afterwards. The
    sample is about speed alone: any order of keys will do, and no row is left out for it.
    """
    mark = F.xxhash64(F.coalesce("text", F.lit("")), F.lit("sample"))
    share = min(1.0, SAMPLE / max(docs.count(), 1))
    sample = meetings(docs.where(F.pmod(mark, F.lit(1 << 40)) < math.ceil(share * (1 << 40))), shingle).select("key", "node").distinct()
    frequent = cut(sample.groupBy("key").agg(F.count(F.lit(1)).alias("sampled")).where(F.col("sampled") >= FREQUENT))
    parts = F.ceil(F.col("sampled") / FREQUENT).cast("int").alias("parts")
    rows = meetings(docs, shingle).join(F.broadcast(frequent.select("key", "sampled", parts)), "key", "left")  # at most SAMPLE / FREQUENT times the keys of a text
    dealt = rows.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"), F.lit(0)))
    one = Window.partitionBy("key", "salt")
    counted = dealt.select("*", F.min("node").over(one).alias("low"), F.max("node").over(one).alias("high"), F.count(F.lit(1)).over(one).alias("n"))
    rank = F.coalesce(F.col("sampled") + F.lit(1 << 40), "n").alias("rank")
    shared = cut(counted.where("low <> high OR parts IS NOT NULL").select("key", "node", "salt", "spare", "parts", rank).distinct())
    rarest = F.row_number().over(Window.partitionBy("node", F.col("key").bitwiseAND(int(FAMILY))).orderBy(F.desc("rank"), "key"))
    kept = shared.withColumn("place", rarest).where("place > spare")
    stars = kept.select("key", "node", "parts", F.min("node").over(one).alias("low")).where("low <> node OR parts IS NOT NULL")
    stars = cut(stars.select("low", "node", F.when(F.col("parts").isNotNull(), F.col("key")).alias("key")).distinct())
    starts = stars.where("key IS NOT NULL").select("key", F.col("low").alias("node")).distinct()
    lowest = starts.groupBy("key").agg(F.min("node").alias("low"))
    edges = stars.select("low", "node").unionByName(starts.join(lowest, "key").select("low", "node"))
    return connected_components(edges, "low", "node").withColumnRenamed("component", "grp")


# --- R-trees over counts, inside components ----------------------------------------------------------


class RTree:
    """A packed R-tree over count vectors: each box keeps its greatest counts and its least and greatest size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = self._packed(points, sizes)
        top, low, high = points[self.order], sizes[self.order], sizes[self.order]
        self.levels = [(top, low, high)]
        while len(top) > LEAF:
            at = np.arange(0, len(top), LEAF)
            top, low, high = np.maximum.reduceat(top, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((top, low, high))

    @staticmethod
    def _packed(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Points in an order of leaves: cut again and again at the median of the coordinate that varies most."""
        whole = np.column_stack([points, sizes])
        out, todo = [], [np.arange(len(points))]
        while todo:
            at = todo.pop()
            if len(at) <= LEAF:
                out.append(at)
                continue
            axis = int(np.argmax(whole[at].var(axis=0)))
            half = LEAF * max(1, round(len(at) / LEAF / 2))
            by = at[np.argpartition(whole[at, axis], half)]
            todo += [by[half:], by[:half]]
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def search(self, point: np.ndarray, size: int, parts: int = 100, least: int = 80) -> tuple[np.ndarray, float]:
        """Indices of the points that may be similar, and the greatest similarity that any other point may have."""
        at, other = np.arange(len(self.levels[-1][0])), 0.0
        for depth in reversed(range(len(self.levels))):
            top, low, high = (x[at] for x in self.levels[depth])
            bound = np.minimum(np.minimum(top, point).sum(axis=1, dtype=np.int64), high)
            union = size + low - np.minimum(bound, low)
            may = (parts * bound >= least * (size + low - bound)) & (parts * high >= least * size) & (parts * size >= least * low)
            if not may.all():
                other = max(other, float((bound / np.maximum(np.maximum(union, size), 1))[~may].max()))
            at = at[may]
            if depth:
                at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
                at = at[at < len(self.levels[depth - 1][0])]
        return self.order[at], min(other, 1.0)


def counts(sets: list[np.ndarray]) -> np.ndarray:
    """Points of hashed sets, with about a group for each two shingles of a middling set, 16 to 512."""
    n = np.array(list(map(len, sets)))
    groups = 1 << min(max(int(np.median(n) / 2).bit_length(), 4), 9)
    flat = _mix(np.concatenate(sets)) >> np.uint64(64 - groups.bit_length() + 1)
    at = np.repeat(np.arange(len(sets)), n) * groups + flat.astype(np.int64)
    return np.bincount(at, minlength=len(sets) * groups).reshape(len(sets), groups).astype(np.int32)


def tree_pairs(sets: list[np.ndarray], reach: float = 0.2) -> list[tuple[int, int]]:
    """Pairs of similarity ``1 - reach`` or more whose components are those of all such pairs.

    Each set that is still open is searched for in the tree, and survivors are compared with it. A set linked to it is closed if the bounds
    show, by the triangle inequality, that all it could be linked to are linked to the first too.
    """
    m, pairs = len(sets), []
    if m < 2:
        return pairs
    n = np.array(list(map(len, sets)))
    percent = round(100 * (1 - reach))
    tokens, flat = np.unique(np.concatenate(sets), return_inverse=True)
    members = np.split(flat, np.cumsum(n)[:-1])
    mark = np.zeros(len(tokens), np.int32)
    points = counts(sets)
    open_, of, tree = np.ones(m, bool), np.arange(m), RTree(points, n)
    left = m
    for c in range(m):
        if not open_[c]:
            continue
        open_[c], left = False, left - 1
        if left < len(of) // 2:
            of = np.nonzero(open_)[0]
            tree = RTree(points[of], n[of])
        if not left:
            break
        found, other = tree.search(points[c], int(n[c]), least=percent)
        found = of[found]
        found = found[open_[found]]
        if not len(found):
            continue
        mark[members[c]] = 1
        ends = np.cumsum(n[found])
        sums = np.concatenate([[0], np.cumsum(mark[np.concatenate([members[i] for i in found])])])
        both = sums[ends] - sums[ends - n[found]]
        mark[members[c]] = 0
        union = n[found] + n[c] - both
        near = 100 * both >= percent * union
        pairs += [(c, int(i)) for i in found[near]]
        alike = both / np.maximum(union, 1)
        outside = max(other, float(alike[~near].max(initial=0.0)))  # the most similar of those not linked to it
        closed = found[near][1 - alike[near] < 1 - outside - reach - 1e-9]
        open_[closed] = False
        left -= len(closed)
    return pairs


def join(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 5) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``: one row per row of ``docs``.

    Documents link if the Jaccard similarity of their sets of distinct shingles is 0.8 or more, exactly (fewer words are one shingle).
    ``component_id`` is the smallest id reachable over links, null only if every such id is null. Null and empty texts have no shingles and link with
    nothing: each row of these is its own component. Equal sets are one node from the start, so copies never meet as rows; repeated rows
    stay. Texts are read whole; a task holds one text's hashes. An empty table gives an empty result.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    marked = named.withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))

    def outline(batch: list[bytes]) -> list[pa.Array]:
        sets = [np.unique(shingles(t.lower().split(), shingle)) for t in batch]
        return [pa.array(list(map(len, sets)), pa.int64()), pa.array([xxhash.xxh3_128_digest(h.tobytes(), SEED) for h in sets], pa.binary())]

    every = cut(with_columns(marked, "text", "n_shingles bigint, item binary", outline, ["doc_id", "mark"]))
    rows = every.where("n_shingles > 0")
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("mark").alias("mark"))
    classes = cut(rows.groupBy("item").agg(F.min(first).alias("low"), F.count(F.lit(1)).alias("copies")))
    met = settled(docs.sparkSession, lambda: candidates(named, shingle))
    node = F.conv(F.hex(F.substring("item", 1, 8)), 16, -10).cast("bigint").alias("node")
    asked = classes.select("item", "low", node).join(met, "node").select("low.mark", F.col("low.id").alias("id"), "item", "grp")
    linked = verified(marked, rows.select("doc_id", "n_shingles", "item"), classes, asked, LEAST, shingle, tree_pairs)
    alone = every.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", "n_shingles", "component_id").unionByName(alone)
