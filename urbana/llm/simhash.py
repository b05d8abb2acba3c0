"""SimHash fingerprints, linked by Hamming distance through vantage-point trees.

Every pair of fingerprints within ``radius`` differing bits meets in at least one shard. A node of the
tree holds a vantage point ``v`` and a bound ``m``: fingerprints with ``d(x, v) <= m + radius`` go inside,
those with ``d(x, v) > m`` outside. By the triangle inequality a pair within ``radius`` that is not wholly
outside is wholly inside, so only the fingerprints between the bounds are copied. The top of the tree is
fitted on a bounded sample and deals all fingerprints to shards; each shard goes on with a tree of its own
until its leaves are small, and compares the fingerprints of a leaf.

Equal fingerprints are one class from the start, shards emit a spanning forest instead of pairs, and the
forests meet in distributed connected components.

With ``Linking.jaccard`` the links found so are candidates only: inside each component of candidates the sets of hashed
shingles are compared, and documents are linked by their exact Jaccard similarity.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbana.llm import bounded
from urbana.llm.arrow import with_columns
from urbana.operators.graph import connected_components
from urbana.session import cut, settled

SEED = 42
SAMPLE = 16384  # fingerprints that the top of the tree is fitted on
LEAF = 384  # fingerprints of a leaf that are compared with each other
HOT_CLASSES = 4096
SHARD = 32768  # fingerprints a shard should hold at most
TREE = 40  # bits of a group's number below its tree
SET_BYTES = 1 << 22  # shingle sets that a task compares at most; one larger set may come with others
Pairs = Callable[[list[np.ndarray], float], list[tuple[int, int]]]


@dataclass(frozen=True)
class Linking:
    """How fingerprints link: ``tables`` of (bit positions, radius), and the greatest distance of the whole fingerprints.

    With one table of all bits and ``max_distance == radius`` the linking is exact. With several tables over
    fewer bits, two fingerprints link if they are within ``max_distance`` and within ``radius`` in a table. With
    ``jaccard``, such fingerprints of distinct shingles are candidates, and texts link if the Jaccard similarity of their
    shingle sets is that or more.
    """

    bits: int = 64
    radius: int = 2
    max_distance: int = 2
    tables: int = 1
    table_bits: int = 64
    levels: int = 8
    jaccard: float | None = None

    def positions(self) -> list[np.ndarray]:
        if self.tables == 1 and self.table_bits == self.bits:
            return [np.arange(self.bits)]
        rng = np.random.default_rng(SEED)
        return [np.sort(rng.permutation(self.bits)[: self.table_bits]) for _ in range(self.tables)]


def shingles(words: list[bytes], shingle: int) -> np.ndarray:
    """XXH64 of each shingle, in the order of the text; fewer words are one shingle."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    k = min(shingle, n)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: n - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)], np.uint64)


def fingerprint(words: list[bytes], shingle: int, bits: int) -> bytes:
    """Majority bits of the shingles' XXH64 (further 64-bit words: a mix of it); no words: zero bytes."""
    return majority(shingles(words, shingle), bits)


def majority(h: np.ndarray, bits: int) -> bytes:
    if not len(h):
        return bytes(bits // 8)
    out = []
    for i in range(bits // 64):
        x = h if i == 0 else _mix(h + np.uint64((i * 0x9E3779B97F4A7C15) % 2**64))
        ones = np.unpackbits(x.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out.append(np.packbits(2 * ones > len(h)).tobytes())
    return b"".join(out)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def with_fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, bits: int = 64, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with a column ``simhash`` (binary). Null and empty texts get zero bytes."""

    def compute(rows: list[bytes]) -> list[pa.Array]:
        return [pa.array([fingerprint(t.lower().split(), shingle, bits) for t in rows], pa.binary())]

    return with_columns(docs, text, "simhash binary", compute, keep)


# --- vantage-point trees over codes of up to 64 bits -------------------------------------------------


def distances(codes: np.ndarray, v: np.uint64) -> np.ndarray:
    return np.bitwise_count(codes ^ v)


def best_split(codes: np.ndarray, radius: int, candidates: int = 8, probe: int = 2048) -> tuple[np.uint64, int, float]:
    """Vantage point and bound with the least expected work, and that work as a share of the work without a split."""
    seen = codes[:: max(1, len(codes) // probe)]
    best = (codes[0], 0, 2.0)
    for v in codes[:: max(1, len(codes) // candidates)][:candidates]:
        below = np.cumsum(np.bincount(distances(seen, v), minlength=66)) / len(seen)
        inside, outside = below[np.minimum(np.arange(65) + radius, 65)], 1 - below[:65]
        cost = inside**2 + outside**2
        m = int(np.argmin(cost))
        if cost[m] < best[2]:
            best = (v, m, float(cost[m]))
    return best


def build_tree(codes: np.ndarray, radius: int, levels: int) -> tuple | None:
    """Nested ``(vantage, bound, inside, outside)``; ``None`` is a shard."""
    if levels == 0 or len(codes) < 2:
        return None
    v, m, cost = best_split(codes, radius)
    if cost >= 1:
        return None
    d = distances(codes, v)
    return (v, m, build_tree(codes[d <= m + radius], radius, levels - 1), build_tree(codes[d > m], radius, levels - 1))


def deal(tree: tuple | None, codes: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, indices of codes in it) for every shard that gets any."""
    todo = [(tree, np.arange(len(codes)), 1)]
    while todo:
        node, at, path = todo.pop()
        if not len(at):
            continue
        if node is None:
            yield path, at
            continue
        v, m, inside, outside = node
        d = distances(codes[at], v)
        todo += [(inside, at[d <= m + radius], 2 * path), (outside, at[d > m], 2 * path + 1)]


def close_pairs(codes: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within ``radius``, in blocks of bounded size; a pair may come more than once."""
    todo = [np.arange(len(codes))]
    while todo:
        at = todo.pop()
        if len(at) > LEAF:
            v, m, cost = best_split(codes[at], radius)
            if cost < 0.97:
                d = distances(codes[at], v)
                todo += [at[d <= m + radius], at[d > m]]
                continue
        for lo in range(0, len(at), LEAF):
            rows = at[lo : lo + LEAF]
            for hi in range(lo, len(at), 8 * LEAF):
                cols = at[hi : hi + 8 * LEAF]
                i, j = np.nonzero(np.bitwise_count(codes[rows][:, None] ^ codes[cols][None, :]) <= radius)
                i, j = rows[i], cols[j]
                if (off := i != j).any():
                    yield i[off], j[off]


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index of each index's component. Blocks of pairs are folded in one after another."""
    root = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            differ = a != b
            if not differ.any():
                break
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (further := root[root]).tobytes() != root.tobytes():
                root = further
    return root


def _codes(prints: np.ndarray, positions: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(prints, axis=1)[:, positions]
    packed = np.pad(np.packbits(bits, axis=1), ((0, 0), (8 - (len(positions) + 7) // 8, 0)))
    return np.ascontiguousarray(packed).view(">u8").astype(np.uint64).ravel()


def _prints(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, size)


def shards(prints: DataFrame, how: Linking) -> tuple[DataFrame | None, DataFrame]:
    """Star links ``(a, b)`` of shards that were too large, and ``(grp, part, item)``: what of each shard is to be compared, ``4 * SHARD`` rows or so at most."""
    size, positions = how.bits // 8, how.positions()
    n = prints.count()
    share = min(1.0, SAMPLE / max(n, 1))
    sample = prints.where(F.expr(f"pmod(xxhash64(simhash, 7), {1 << 40}) < {math.ceil(share * (1 << 40))}")).select("simhash").collect()
    fitted = _prints(pa.array([bytes(r[0]) for r in sorted(sample)], pa.binary()), size)
    levels = max(how.levels, math.ceil(math.log(max(n, 1) / SHARD) / math.log(1 / 0.6)) if n > SHARD else 0)
    trees = [build_tree(_codes(fitted, p), how.radius, levels) for p in positions]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = _prints(b.column(0), size)
            if not len(own):
                continue
            for t, (tree, p) in enumerate(zip(trees, positions, strict=True)):
                got = list(deal(tree, _codes(own, p), how.radius))
                shard = np.concatenate([np.full(len(at), (t << TREE) + s, np.int64) for s, at in got])
                at = np.concatenate([at for _, at in got])
                yield pa.RecordBatch.from_arrays([pa.array(shard), b.column(0).take(pa.array(at))], names=["grp", "item"])

    dealt = prints.select("simhash").mapInArrow(route, "grp bigint, item binary").withColumn("data", F.col("item"))
    stars, rest = bounded.split(dealt, bit_distances, how.max_distance, 4 * SHARD * (size + 1))
    return stars, rest.select("grp", "part", "item")


def bit_distances(data: list[bytes], centres: list[bytes]) -> np.ndarray:
    size = len(data[0])
    a, b = (np.frombuffer(b"".join(x), np.uint8).reshape(-1, size) for x in (data, centres))
    return np.bitwise_count(a ^ b).sum(axis=1).astype(float)


def thinned(words: np.ndarray, reach: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Stars of dense groups of fingerprints, as index pairs, and the indices that may have further links among them (see ``bounded``)."""
    at, stars = np.arange(len(words)), []
    while len(at) > LEAF:
        probes = at[:: max(1, len(at) // 4)][:4]
        far = min((np.bitwise_count(words[at] ^ words[c]).sum(axis=1) for c in probes), key=lambda d: -(d <= reach).sum())
        near = far <= reach
        keep = far >= far[~near].min() - reach if (~near).any() else np.zeros(len(at), bool)
        if keep.mean() > 0.9:
            break
        centre = at[int(np.argmin(far))]
        stars.append((np.full(int(near.sum()), centre), at[near]))
        at = at[keep]
    return stars, at


def links(prints: DataFrame, how: Linking) -> DataFrame:
    """A spanning forest ``(a, b)`` of the links between the distinct fingerprints in ``prints(simhash)``.

    In a dense group also pairs within ``max_distance`` that meet in a shard only link, though no table has them within ``radius``.
    """
    size, positions = how.bits // 8, how.positions()
    stars, rest = shards(prints, how)

    def link(group: pa.Table) -> pa.Table:
        column = group.column("item").combine_chunks()
        own = _prints(column, size)
        t = group.column("grp")[0].as_py() >> TREE
        words = own.view(np.uint64)
        dense, at = thinned(words, how.max_distance)

        def near() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            yield from dense
            for i, j in close_pairs(_codes(own[at], positions[t]), how.radius) if len(at) else ():
                i, j = at[i], at[j]
                if how.bits > len(positions[t]):
                    ok = np.bitwise_count(words[i] ^ words[j]).sum(axis=1) <= how.max_distance
                    i, j = i[ok], j[ok]
                yield i, j

        root = forest(len(own), near())
        leaf = np.nonzero(root != np.arange(len(own)))[0]
        return pa.table({"a": column.take(pa.array(root[leaf])), "b": column.take(pa.array(leaf))})

    found = rest.groupBy("grp", "part").applyInArrow(link, "a binary, b binary")
    return found if stars is None else found.unionByName(stars)


def components(docs: DataFrame, how: Linking, id_col: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, simhash, component_id)``: one row per row of ``docs``.

    ``component_id`` is the smallest id whose fingerprint is reachable over links, null only if every such id
    is null. Empty texts share the zero fingerprint. Texts of any length are read whole: a task holds one text's words and 8 bytes for each of its shingles and
    bits. Repeated rows stay. An empty table gives an empty result.
    """
    if how.jaccard is not None:
        return similar(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), how, shingle)
    rows = cut(with_fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), "text", shingle, how.bits, ["doc_id"]))
    classes = cut(rows.groupBy("simhash").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies")))
    return _to_rows(rows, _lowest(classes, links(classes, how), "simhash"), "simhash").select("doc_id", "simhash", "component_id")


def _to_rows(rows: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    """Each row with the ``component_id`` of its class in ``classes(key, copies, component_id)``.

    At most ``HOT_CLASSES`` classes can hold over ``1 / HOT_CLASSES`` of the rows each: these few are broadcast, so that
    the rows of a text with very many copies don't meet in one task. The others join by key.
    """
    classes = cut(classes)
    most = (classes.agg(F.sum("copies")).first()[0] or 0) / HOT_CLASSES
    hot = F.broadcast(classes.where(F.col("copies") > most).select(key, "component_id"))
    others = rows.join(hot.select(key), key, "left_anti")
    return rows.join(hot, key).unionByName(others.join(classes.where(F.col("copies") <= most).select(key, "component_id"), key))


def _lowest(classes: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """``(key, copies, component_id)``: the smallest ``low`` of the component of each row of ``classes(key, low, copies)``."""
    found = connected_components(edges).select(F.col("node").alias(key), F.col("component").alias("root"))
    linked = cut(classes.join(found, key).select(key, "low", "root"))
    # A component can hold a large share of all classes: its one smallest id meets them in parts.
    lowest = cut(linked.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("n")))
    named = bounded.meet(linked, lowest.drop("n"), "root", key, bounded.parts_of(lowest, "root", "n")).select(key, "component_id")
    return classes.join(named, key, "left").select(key, "copies", F.coalesce("component_id", "low").alias("component_id"))


# --- exact similarity of candidates ------------------------------------------------------------------


def similar(docs: DataFrame, how: Linking, shingle: int) -> DataFrame:
    """As ``components``, by the exact Jaccard similarity of the texts whose fingerprints are connected.

    Equal shingle sets are one class. Every two sets of a component of candidates are compared, also those that met in no table.
    """
    marked = docs.withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))

    def outline(batch: list[bytes]) -> list[pa.Array]:
        sets = [np.unique(shingles(t.lower().split(), shingle)) for t in batch]
        return [pa.array([majority(h, how.bits) for h in sets], pa.binary()), pa.array([xxhash.xxh3_128_digest(h.tobytes(), SEED) for h in sets], pa.binary())]

    rows = cut(with_columns(marked, "text", "simhash binary, item binary", outline, ["doc_id", "mark"]))
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("mark").alias("mark"))
    classes = cut(rows.groupBy("item").agg(F.min(first).alias("low"), F.min("simhash").alias("simhash"), F.count(F.lit(1)).alias("copies")))
    prints = cut(classes.groupBy("simhash").agg(F.count(F.lit(1)).alias("sets")))
    near = connected_components(links(prints, how)).select(F.col("node").alias("simhash"), F.col("component").alias("grp"))
    candidates = prints.join(near, "simhash", "left").where("grp IS NOT NULL OR sets > 1").select("simhash", F.coalesce("grp", "simhash").alias("grp"))
    asked = classes.join(candidates, "simhash").select("low.mark", F.col("low.id").alias("id"), "item", "grp")
    return verified(marked, rows, classes, asked, how.jaccard, shingle, alike_pairs).select("doc_id", "simhash", "component_id")


def verified(marked: DataFrame, rows: DataFrame, classes: DataFrame, asked: DataFrame, least: float, shingle: int, pairs: Pairs) -> DataFrame:
    """``rows(doc_id, item, ...)`` with their ``component_id``, by the exact similarity of the sets of each group in ``asked(id, mark, item, grp)``.

    ``marked(doc_id, mark, text)`` has the texts, ``classes(item, low, copies)`` the smallest document of each set; ``pairs`` compares the sets of a task.
    """

    def members(batch: list[bytes]) -> list[pa.Array]:
        return [pa.array([np.unique(shingles(t.lower().split(), shingle)).tobytes() for t in batch], pa.large_binary()).cast(pa.binary())]

    texts = marked.alias("d").join(asked.alias("c"), (F.col("d.mark") == F.col("c.mark")) & F.col("d.doc_id").eqNullSafe(F.col("c.id"))).select("grp", "item", "text")
    spark = marked.sparkSession
    near = settled(spark, lambda: alike(cut(with_columns(texts, "text", "data binary", members, ["grp", "item"])), least, pairs))
    every = _lowest(classes.select("item", "low", "copies"), near, "item")
    return _to_rows(rows, every.select("item", "copies", F.col("component_id.id").alias("component_id")), "item")


def alike(sets: DataFrame, least: float, pairs: Pairs | None = None) -> DataFrame:
    """A spanning forest ``(a, b)`` of the links between items of a group of ``sets(grp, item, data)`` with Jaccard similarity ``least`` or more."""
    reach = 1 - least + 1e-9

    def link(group: pa.Table) -> pa.Table:
        items, data = group.column("item").to_pylist(), group.column("data").to_pylist()
        found = np.array((pairs or alike_pairs)([np.frombuffer(x, np.uint64) for x in data], reach), np.int64).reshape(-1, 2)
        root = forest(len(items), iter([(found[:, 0], found[:, 1])]))
        leaf = np.nonzero(root != np.arange(len(items)))[0].tolist()
        return pa.table({"a": pa.array([items[root[i]] for i in leaf], pa.binary()), "b": pa.array([items[i] for i in leaf], pa.binary())})

    return bounded.links(sets, jaccard_distances, reach, SET_BYTES, link)


def jaccard_distances(data: list[bytes], centres: list[bytes]) -> np.ndarray:
    """1 - Jaccard similarity of each set to its centre."""
    out = np.empty(len(data))
    for i, (x, c) in enumerate(zip(data, centres, strict=True)):
        a, b = np.frombuffer(x, np.uint64), np.frombuffer(c, np.uint64)
        both = len(np.intersect1d(a, b, assume_unique=True))
        out[i] = 1 - both / max(len(a) + len(b) - both, 1)
    return out


def alike_pairs(sets: list[np.ndarray], reach: float) -> list[tuple[int, int]]:
    """Pairs within ``reach`` whose components are those of all such pairs: each set is compared with those that are still open."""
    pairs: list[tuple[int, int]] = []
    if len(sets) < 2:
        return pairs
    n = np.array(list(map(len, sets)))
    tokens, at = np.unique(np.concatenate(sets), return_inverse=True)
    parts = np.split(at, np.cumsum(n)[:-1])
    left, flat, starts = np.arange(len(sets)), at, np.cumsum(n) - n
    mark, packed = np.zeros(len(tokens), np.int32), len(sets)
    while len(left) > 1:
        if len(left) < packed // 2:
            flat, packed = np.concatenate([parts[i] for i in left]), len(left)
            starts = np.zeros(len(sets), np.int64)
            starts[left] = np.cumsum(n[left]) - n[left]
        centre = left[0]
        mark[parts[centre]] = 1
        sums = np.concatenate([[0], np.cumsum(mark[flat])])
        both = sums[starts[left] + n[left]] - sums[starts[left]]
        mark[parts[centre]] = 0
        far = 1 - both / np.maximum(n[left] + n[centre] - both, 1)
        near = far <= reach
        pairs += [(int(centre), int(i)) for i in left[near] if i != centre]
        outside = far[~near]
        if not len(outside):
            break
        left = left[(far >= outside.min() - reach - 1e-9) & (left != centre)]
    return pairs


def keep_one(docs: DataFrame, how: Linking, id_col: str = "doc_id", text: str = "text", shingle: int = 5) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, of equal ids the smallest text hash.

    A row without an id stays only where its component has no other. Repeated rows become one. Texts of any length are read whole; a set of shingles larger than
    a task's share is compared alone or with few others.
    """
    mark = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    narrow = docs.select(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), mark.alias("mark")).alias("doc_id"), F.col(text).alias("text"))
    best = components(narrow, how, "doc_id", "text", shingle).where("doc_id = component_id").select(F.col("doc_id.id").alias("__best"), F.col("doc_id.mark").alias("__of")).distinct()
    marked = docs.withColumn("__mark", mark)
    return marked.join(best, (F.col("__mark") == F.col("__of")) & F.col(id_col).eqNullSafe(F.col("__best")), "left_semi").dropDuplicates(["__mark", id_col]).drop("__mark")
