"""The Jaccard join, the filter audit and run detection against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from urbana.llm import bounded, filter_audit, jaccard_join, periodic, queries, simhash

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
LONG = " ".join(f"w{i}é" for i in range(30_000))
SAME = "one two three four five six"
ODD = [(None, None), (1, ""), (2, None), (3, "  \n\t "), (4, SAME), (4, SAME), (5, SAME.upper()), (6, LONG), (7, LONG + " x"), (None, SAME), (8, "é" * 5000), (9, "a b c"), (10, "A b C")]
CLASHING = "n item grp node key salt low mark n_shingles component_id copies part mask same good toxic runs collapsed start length period".split()


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, None, *["x"] * len(CLASHING)) for i, t in ODD], "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASHING))


def components(n: int, links) -> list[int]:
    part = list(range(n))
    for a, b in links:
        lo, hi = sorted((part[a], part[b]))
        part = [lo if x == hi else x for x in part]
    return part


# --- op11 ------------------------------------------------------------------------------------------


def shingle_set(t: str | None) -> set:
    w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    w = WORD.findall(w)
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def linked(a: set, b: set) -> bool:
    return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)


def test_similar_sets_share_a_key():
    rng = np.random.default_rng(0)
    for _ in range(4000):
        n = int(rng.choice([4, 5, 9, 16, 17, 20, 21, 26, 27, 45, 100, 400, 900]))
        gone, new = int(rng.integers(0, n // 5 + 1)), 0
        while 100 * (n - gone) >= 80 * (n + new + 1) and rng.random() < 0.95:
            new += 1
        a, b = rng.integers(0, 2**62, n).astype(np.uint64), rng.integers(2**62, 2**63, new).astype(np.uint64)
        b = np.unique(np.concatenate([a[gone:], b]))
        a = np.unique(a)
        if 100 * (n - gone) >= 80 * (n + new):
            assert len(np.intersect1d(jaccard_join.slice_keys(a), jaccard_join.slice_keys(b)))


def random_sets(rng) -> list[np.ndarray]:
    sets = []
    for _ in range(int(rng.integers(1, 7))):
        base = rng.integers(0, 2**63, int(rng.integers(4, 90))).astype(np.uint64)
        for _ in range(int(rng.integers(1, 25))):
            kept = base[rng.random(len(base)) > rng.choice([0, 0.02, 0.1, 0.15])]
            x = np.unique(np.concatenate([kept, rng.integers(0, 2**63, int(len(base) * rng.choice([0, 0.02, 0.1]))).astype(np.uint64)]))
            if len(x):
                sets.append(x)
    return sets


def test_tree_finds_the_components_of_all_pairs():
    rng = np.random.default_rng(1)
    for _ in range(30):
        sets = random_sets(rng)
        every = [set(x.tolist()) for x in sets]
        got = jaccard_join.tree_pairs(sets, 0.2 + 1e-9)
        assert all(linked(every[i], every[j]) for i, j in got)
        assert components(len(sets), got) == components(len(sets), [(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if linked(every[i], every[j])])


def test_tree_search_rules_out_no_similar_point():
    rng = np.random.default_rng(2)
    sets = [x for _ in range(6) for x in random_sets(rng)]
    points, n = jaccard_join.counts(sets), np.array(list(map(len, sets)))
    tree = jaccard_join.RTree(points, n)
    assert len(tree.levels) > 1 and sorted(tree.order.tolist()) == list(range(len(sets)))
    for i in range(0, len(sets), 7):
        found, other = tree.search(points[i], int(n[i]))
        alike = np.array([len(np.intersect1d(sets[i], x)) / len(np.union1d(sets[i], x)) for x in sets])
        assert set(np.nonzero(alike >= 0.8)[0]) <= set(found.tolist())
        assert np.delete(alike, found).max(initial=0) <= other + 1e-9


def test_join_of_edited_texts_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT", 3)  # slices of the large group are dealt in parts
    rnd = random.Random(3)
    rows = []
    for g in range(40):
        words = [f"{rnd.choice('abcdefgh')}{rnd.randrange(3000)}" for _ in range(rnd.choice([9, 14, 22, 40, 90, 200]) if g else 80)]
        for _ in range(40 if g == 0 else 4):
            w = list(words)
            for _ in range(rnd.choice([0, 1, 1, 2, 3])):
                w[rnd.randrange(len(w))] = f"x{rnd.randrange(9)}"
            rows.append((1000 - len(rows), " ".join(w[: rnd.choice([None, -1, -2])])))
    sets = [shingle_set(t) for _, t in rows]
    part = components(len(rows), [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if linked(sets[i], sets[j])])
    low = {p: min(rows[i][0] for i in range(len(rows)) if part[i] == p) for p in part}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {rows[i][0]: (len(sets[i]), low[part[i]]) for i in range(len(rows))}
    assert 40 < len(set(low.values())) < len(rows) - 40


def test_join_odd_rows(spark, odd):
    got = jaccard_join.join(odd).collect()
    assert len(got) == len(ODD)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None) == [
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 2, 4), (4, 2, 4), (5, 2, 4), (6, 29996, 6), (7, 29997, 6), (8, 1, 8), (9, 1, 9), (10, 1, 9)]
    assert sorted((r["n_shingles"], r["component_id"] or 0) for r in got if r["doc_id"] is None) == [(0, 0), (2, 4)]
    assert jaccard_join.join(odd.limit(0)).count() == 0


def test_many_large_groups_stay_tables(spark, monkeypatch):
    """10,000 groups over the cap: their keys, sizes and representatives are joined, not collected."""
    monkeypatch.setattr(bounded, "SMALL_BYTES", 1000)
    rng = np.random.default_rng(5)
    rows = [(g.to_bytes(4, "big"), g.to_bytes(4, "big") + bytes([i]), bytes((rng.integers(0, 2**62, 1).repeat(1)).tobytes())) for g in range(10_000) for i in range(3)]
    rows += [(b"hot", b"h%04d" % i, b"\0" * 7 + bytes([1 << (i % 3)])) for i in range(2000)]
    frame = spark.createDataFrame(pd.DataFrame(rows, columns=["grp", "item", "data"]), "grp binary, item binary, data binary")
    stars, rest = bounded.split(frame, simhash.bit_distances, 2, 20)
    count = rest.groupBy("grp", "part").count()
    assert stars.where("substring(a, 1, 1) = 'h'").count() >= 1999
    assert count.where("length(grp) = 4").select("grp").distinct().count() == 10_000
    pairs = rest.alias("x").join(rest.alias("y"), ["grp", "part"]).where("x.item < y.item AND length(grp) = 4").selectExpr("grp", "x.item AS a", "y.item AS b").distinct().count()
    assert pairs == 10_000  # of three that are far apart one was the representative, the others have still to meet


def test_similar_sets_share_a_key_in_any_order():
    rng = np.random.default_rng(8)
    for _ in range(2000):
        n = int(rng.choice([4, 5, 9, 16, 17, 20, 21, 26, 27, 45, 100, 400]))
        gone = int(rng.integers(0, n // 5 + 1))
        a = np.unique(rng.integers(0, 2**62, n).astype(np.uint64))
        first = []
        for x in (a, np.sort(rng.permutation(a)[gone:])):
            keys = jaccard_join.slice_keys(x)
            spare, family = jaccard_join.spares(keys, len(x)), keys & jaccard_join.FAMILY
            late = np.argsort((keys ^ np.uint64(0x5DEECE66D)) * np.uint64(0x9E3779B97F4A7C15))[::-1]  # an order that has nothing to do with the sets
            place = {f: 0 for f in set(family.tolist())}
            for i in late:
                place[int(family[i])] += 1
                if place[int(family[i])] > spare[i]:
                    first.append(int(keys[i]))
        assert len(first) > len(set(first))


def test_common_passages_join_no_other_texts(spark):
    """Before, sets met by their fullest slices, and the slices of a passage that hundreds of texts share made one component of them, which grew with the table."""
    rnd = random.Random(6)
    passage = " ".join(f"p{rnd.randrange(10**6)}" for _ in range(40))
    rows = [(" ".join(f"w{rnd.randrange(10**6)}" for _ in range(35)) + f" {passage} " + " ".join(f"w{rnd.randrange(10**6)}" for _ in range(35)),) for _ in range(400)]
    groups = [r["n"] for r in jaccard_join.candidates(spark.createDataFrame(rows, "text string"), 5).groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(groups, default=0) < 40


def test_blocks_meet_by_turns(spark, monkeypatch):
    """A group that no star thins out: every two of its blocks meet, and no turn copies a row more than twice as often as ``COPIES``."""
    monkeypatch.setattr(bounded, "COPIES", 1)
    monkeypatch.setattr(bounded, "ROUNDS", 1)
    copies, met = [], bounded._met

    def counted(*args):
        out = met(*args)
        copies.append(out.groupBy("item").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(bounded, "_met", counted)
    items = [f"i{i:03d}".encode() for i in range(60)]
    frame = spark.createDataFrame(pd.DataFrame([(b"g", x, x) for x in items], columns=["grp", "item", "data"]), "grp binary, item binary, data binary")

    def link(group: pa.Table) -> pa.Table:
        own = group.column("item").to_pylist()
        both = [(a, b) for a in own for b in own if a < b]
        return pa.table({"a": pa.array([a for a, _ in both], pa.binary()), "b": pa.array([b for _, b in both], pa.binary())})

    links = bounded.links(frame, lambda data, centres: np.array([0.3 + (x != c) * 0.3 for x, c in zip(data, centres)]), 0.4, 60, link)
    found = {tuple(sorted((bytes(r["a"]), bytes(r["b"])))) for r in links.distinct().collect()}
    assert len(copies) > 3 and max(copies) <= 2
    assert found >= {(a, b) for a, b in itertools.combinations(items, 2)} and len(found) == 60 * 59 // 2


# --- op12 ------------------------------------------------------------------------------------------


def brute_audit(docs: list[tuple], good: set, toxic: set) -> dict:
    first = {}
    for i, _, t in docs:
        first[t or ""] = min(first.get(t or "", i), i)
    fails = {}
    for n, (i, _, t) in enumerate(docs):
        t = t or ""
        w = WORD.findall(t)
        fails[n] = {c for c, x in zip("ABCDE", (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search("[#$%&*|]", t)), i > first[t]), strict=True) if x}
    out = {}
    for part in {p or "" for _, p, _ in docs}:
        mine = [n for n, d in enumerate(docs) if (d[1] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = set(mine)
            for step, c in enumerate(order, 1):
                gone = {n for n in left if c in fails[n]}
                redundant = sum(c in fails[n] for n in mine if n not in left)
                left -= gone
                shapley[c] += len(gone)
                ids = [docs[n][0] for n in gone]
                out[part, order, step] = [len(left), len(gone), redundant, sum(fails[n] == {c} for n in mine), sum(i in good for i in ids), sum(i in toxic for i in ids)]
        for (p, order, step), x in out.items():
            if p == part:
                x.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_against_brute_force(spark):
    rnd = random.Random(7)
    texts = [" ".join(rnd.choice(["Aa", "b#", "cc", "DDD", f"w{rnd.randrange(99)}"]) for _ in range(rnd.choice([3, 49, 50, 90]))) for _ in range(25)] + [None, "", "é" * 60]
    docs = [(rnd.randrange(300), rnd.choice(["s1", "s2", None, ""]), rnd.choice(texts)) for _ in range(200)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, 300, 2)] + [(3, 0, 1), (3, 1, 0), (None, 1, 1)]
    masks = filter_audit.with_masks(spark.createDataFrame(docs, "doc_id long, source string, text string"))
    got = filter_audit.audit(filter_audit.cells(masks, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))).collect()
    want = brute_audit(docs, {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1})
    assert {tuple(r[:3]): tuple(r[3:]) for r in got} == want and len(got) == len(want)


def test_audit_odd_rows(spark, odd):
    labels = spark.createDataFrame([(4, 1, 0, "x")], "doc_id long, quality int, toxic int, part string")
    got = filter_audit.audit(filter_audit.cells(filter_audit.with_masks(odd), labels)).collect()
    assert len(got) == 600 and {r["part"] for r in got} == {""}
    one = {r["step"]: r for r in got if r["filter_order"] == "EABCD"}
    # Of the empty texts only the first id stays, and that without an id goes; of equal rows of one id all stay.
    assert one[1]["removed"] == 2 + 1 - 0 and one[5]["kept"] == 2 and one[2]["good_lost"] == 2
    assert filter_audit.audit(filter_audit.cells(filter_audit.with_masks(odd.limit(0)), labels)).count() == 0


# --- op13 ------------------------------------------------------------------------------------------


def brute_runs(w: list) -> list[tuple[int, int, int]]:
    n, found = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, k, q) for (s, k), q in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_against_brute_force(monkeypatch):
    monkeypatch.setattr(periodic, "TOGETHER", 500)
    rnd = random.Random(1)
    total = 0
    for _ in range(700):
        texts = []
        for _ in range(rnd.randint(1, 4)):
            n = rnd.randint(0, rnd.choice([30, 120, 300]))
            w = [rnd.randrange(rnd.choice([1, 2, 3, 5, 50])) for _ in range(n)]
            for _ in range(rnd.randint(0, 4) if n > 24 else 0):
                p, s = rnd.randint(1, n // 4), rnd.randrange(n)
                base, r = w[s : s + p], rnd.randint(1, 3)
                if rnd.random() < 0.5:  # a period that holds a shorter one
                    base = [base[i % r] if i < len(base) * 2 // 3 else base[i] for i in range(len(base))]
                for i in range(s, min(n, s + int(p * rnd.uniform(2, 6)))):
                    w[i] = base[(i - s) % len(base)]
            texts.append([b"%d" % x for x in w])
        want = [brute_runs(w) for w in texts]
        total += sum(map(len, want))
        assert periodic.runs_of_texts(texts) == want
    assert total > 400


def test_range_successor():
    rng = np.random.default_rng(4)
    values = rng.permutation(1000)
    tree = periodic.Wavelet(values)
    low = rng.integers(0, 999, 300)
    high = low + rng.integers(1, 1000 - low + 1)
    x = rng.integers(0, 1100, 300)
    below = tree.below(low, high, x)
    assert below.tolist() == [int((values[a:b] < v).sum()) for a, b, v in zip(low, high, x, strict=True)]
    more = below < high - low
    assert tree.nth(low[more], high[more], below[more]).tolist() == [int(min(v for v in values[a:b] if v >= t)) for a, b, t in zip(low[more], high[more], x[more], strict=True)]


def test_run_query_against_brute_force(spark):
    got = queries.op13_periodic_run_detection(spark, SF).toPandas().set_index("doc_id")
    d = pd.read_parquet(f"{SF}/documents.parquet")
    tails = 0
    for i, t in zip(d.doc_id, d.text, strict=True):
        w = WORD.findall(t or "")
        h = zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
            tails += 1
        ids = {x: k for k, x in enumerate(dict.fromkeys(w))}
        a, found = np.array([ids[x] for x in w]), {}
        for q in range(1, len(w) // 3 + 1):
            edge = np.diff(np.concatenate([[0], a[:-q] == a[q:], [0]]).astype(int))
            for s, e in zip(np.nonzero(edge == 1)[0].tolist(), np.nonzero(edge == -1)[0].tolist(), strict=True):
                if e - s + q >= max(24, 3 * q):
                    found.setdefault((s, e - s + q), q)
        runs = sorted(((s, k, q) for (s, k), q in found.items()), key=lambda r: (r[0], r[2]))
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        row = [None if pd.isna(x) else x for x in got.loc[i]]
        assert row[:4] == [len(runs), *best] and row[4] == (best[0] is not None and 1000 * best[1] // best[2] or None)
        assert row[5] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row[6] == hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()
    assert len(got) == len(d) and tails > 5


def test_run_odd_rows(spark, odd):
    rows = spark.createDataFrame([(1, "x " * 40 + "y"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in periodic.with_runs(rows).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 40, 1)] and got[1]["collapsed"] == "x y" and got[2]["runs"] == [] and got[2]["collapsed"] == ""
    every = periodic.with_runs(odd).collect()
    assert len(every) == len(ODD) and not any(r["runs"] for r in every) and {r["collapsed"] for r in every if r["doc_id"] == 6} == {LONG}
    assert periodic.with_runs(odd.limit(0)).count() == 0
    assert queries.with_repeated_tails(odd).count() == len(ODD)


# --- the pipeline's candidates ---------------------------------------------------------------------


def test_recall_of_near_dedup_candidates():
    """2,500 pairs of sets with similarity 0.8 to 0.9: those that no table of fingerprints brings together are lost."""
    import corpus_pipeline

    how, rng = corpus_pipeline.NEAR, np.random.default_rng(12)
    prints, alike = [], []
    while len(alike) < 2500:
        n = int(rng.integers(60, 600))
        both = int(n * rng.uniform(0.885, 0.955))
        a, more = rng.integers(0, 2**63, n).astype(np.uint64), rng.integers(0, 2**63, n).astype(np.uint64)
        b = np.concatenate([a[:both], more[: n - both]])
        j = both / (2 * n - both)
        if 0.8 <= j <= 0.9:
            alike.append(j)
            prints += [simhash.majority(a, how.bits), simhash.majority(b, how.bits)]
    words = np.frombuffer(b"".join(prints), np.uint8).reshape(len(prints), -1)
    far = np.unpackbits(words[::2] ^ words[1::2], axis=1)
    meet = np.any([far[:, p].sum(axis=1) <= how.radius for p in how.positions()], axis=0) & (far.sum(axis=1) <= how.max_distance)
    alike = np.array(alike)
    assert meet.mean() >= 0.98 and meet[alike < 0.82].mean() >= 0.93
