"""The corpus operators against brute force, libraries, SQL and held-out labels."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from urbana.llm import line_dedup, packing, pieces, planes, quality_rules, queries, simhash, subwords, toxicity, url_filter, weak_quality, winnow

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
LONG = " ".join(f"w{i}é" for i in range(30_000))
#: Nulls, empty and very long texts, ties, repeated rows, and columns with clashing names.
ODD = [(None, None), (1, ""), (2, None), (3, "  \n\t "), (4, "one two three four five six"), (4, "one two three four five six"), (5, "ONE TWO three four five six"), (6, LONG), (7, LONG + " x"), (None, "one two three four five six"), (8, "é" * 5000)]


CLASHING = "n_words simhash ids score kept n_tokens n_lines n_dropped host path rule verdict pattern text_key bucket key host_rate base_failed soft_failed id mark predicted component_id rank copies place n grp item part doc toxic decoded quality posterior first last".split()


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    names = CLASHING
    clashing = ", ".join(f"{c} string" for c in names)
    rows = [(i, t, "s", *[None] * len(names)) for i, t in ODD]
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, {clashing}")


def lower(t: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# --- op1 -------------------------------------------------------------------------------------------


def brute_print(t: str, k: int = 3) -> int:
    w = WORD.findall(lower(t))
    grams = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_query_against_brute_force(spark):
    got = queries.op1_simhash_near_dedup(spark, SF).toPandas().sort_values("doc_id")
    d = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")
    prints = [brute_print(t) for t in d.text]
    assert [int(x, 16) for x in got.fingerprint] == prints
    part = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = part[i], part[j]
                part = [min(a, b) if x in (a, b) else x for x in part]
    low = {}
    for p, i in zip(part, d.doc_id, strict=True):
        low[p] = min(low.get(p, i), i)
    assert list(got.component_id) == [low[p] for p in part]


def test_tree_loses_no_pair():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 1500).astype(np.uint64)
    codes = np.concatenate([base, base[:700] ^ (np.uint64(1) << rng.integers(0, 63, 700).astype(np.uint64)), base[:300] ^ np.uint64(5)])
    want = {(i, j) for i in range(len(codes)) for j in np.nonzero(np.bitwise_count(codes[i] ^ codes) <= 2)[0].tolist() if i < j}
    assert {(min(a, b), max(a, b)) for i, j in simhash.close_pairs(codes, 2) for a, b in zip(i.tolist(), j.tolist(), strict=True)} == want
    tree = simhash.build_tree(codes[::3], 2, 5)
    homes = [set() for _ in codes]
    for shard, at in simhash.deal(tree, codes, 2):
        for x in at:
            homes[x].add(shard)
    assert all(homes[i] & homes[j] for i, j in want) and len(set.union(*homes)) > 8


def test_simhash_odd_rows(spark, odd):
    got = simhash.components(odd, simhash.Linking()).collect()
    assert len(got) == len(ODD)
    of = {(r["doc_id"], bytes(r["simhash"])): r["component_id"] for r in got}
    assert {c for (i, _), c in of.items() if i in (1, 2, 3)} == {1}
    assert {c for (i, _), c in of.items() if i in (4, 5)} == {4} and of[(7, next(k[1] for k in of if k[0] == 7))] == 6
    assert simhash.components(odd.limit(0), simhash.Linking()).count() == 0


def test_near_copies_go_and_others_stay(spark):
    import corpus_pipeline

    rnd = random.Random(5)
    text = lambda n: [f"{rnd.choice('abcdefgh')}{rnd.randrange(4000)}" for _ in range(n)]
    rows, copies = [], set()
    for i in range(60):
        w = text(150)
        rows.append((10 * i, " ".join(w)))
        if i % 2:
            w[20] = "changed"
            w[90] = "other"
            rows.append((10 * i + 1, " ".join(w)))
            copies.add(10 * i + 1)
    kept = {r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), corpus_pipeline.NEAR).collect()}
    assert {i for i, _ in rows} - copies <= kept and len(kept & copies) <= 1


def shingle_set(t: str) -> set:
    w = t.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))}


def test_near_dedup_is_exact_jaccard(spark):
    import corpus_pipeline

    rnd = random.Random(11)
    rows, sets = [], []
    for i in range(150):
        w = [f"{rnd.choice('abcdefgh')}{rnd.randrange(4000)}" for _ in range(200)]
        v = list(w)
        for k in rnd.sample(range(10, 190), (2, 3, 4, 5, 6, 7, 8)[i % 7]):
            v[k] = f"x{rnd.randrange(4000)}"
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
    sets = [shingle_set(t) for _, t in rows]
    alike = [len(sets[2 * i] & sets[2 * i + 1]) / len(sets[2 * i] | sets[2 * i + 1]) >= 0.8 for i in range(150)]
    got = {r["doc_id"]: r["component_id"] for r in simhash.components(spark.createDataFrame(rows, "doc_id long, text string"), corpus_pipeline.NEAR, shingle=5).collect()}
    linked = [got[2 * i + 1] == 2 * i for i in range(150)]
    assert not any(x and not y for x, y in zip(linked, alike, strict=True))
    assert sum(linked) >= 0.96 * sum(alike) and 40 < sum(alike) < 120
    # A passage repeated often does not make texts alike that share nothing else.
    tail = " ".join(f"r{i}" for i in range(12))
    twins = [(i, " ".join([tail] * 40 + [f"u{i}x{k}" for k in range(60)])) for i in range(2)]
    assert simhash.keep_one(spark.createDataFrame(twins, "doc_id long, text string"), corpus_pipeline.NEAR).count() == 2


def test_large_groups_of_sets_are_split_and_nothing_is_lost(spark, monkeypatch):
    rng = np.random.default_rng(4)
    core = rng.integers(0, 2**63, 60)
    sets = [np.unique(np.concatenate([core[: 60 - i % 4], rng.integers(0, 2**63, i % 13)])).astype(np.uint64) for i in range(200)]
    want = np.arange(200)
    for i in range(200):
        for j in range(i):
            if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j])):
                a, b = sorted((want[i], want[j]))
                want[want == b] = a
    frame = spark.createDataFrame([(b"g", b"%03d" % i, bytes(x.tobytes())) for i, x in enumerate(sets)], "grp binary, item binary, data binary")
    for cap in (1 << 24, 20_000, 2_000):
        monkeypatch.setattr(simhash, "SET_BYTES", cap)
        found = np.arange(200)
        for r in simhash.alike(frame, 0.8).collect():
            a, b = sorted((found[int(bytes(r["a"]))], found[int(bytes(r["b"]))]))
            found[found == b] = a
        assert (found == want).all()


@pytest.mark.parametrize("how", [simhash.Linking(), simhash.Linking(bits=256, radius=1, max_distance=46, tables=2, table_bits=20, levels=5)])
def test_no_group_of_fingerprints_is_unbounded(spark, monkeypatch, how):
    monkeypatch.setattr(simhash, "SHARD", 50)
    monkeypatch.setattr(simhash, "LEAF", 32)
    rng = np.random.default_rng(8)
    size = how.bits // 8
    one = rng.integers(0, 256, size).astype(np.uint8)
    flip = np.packbits(rng.random((700, how.bits)) < (0.02 if size == 8 else 0.01), axis=1)
    prints = np.unique(np.concatenate([one ^ flip, rng.integers(0, 256, (700, size)).astype(np.uint8)]), axis=0)
    frame = spark.createDataFrame([(bytes(x.tobytes()),) for x in prints], "simhash binary")
    stars, rest = simhash.shards(frame, how)
    assert stars is not None and rest.groupBy("grp", "part").count().agg(F.max("count")).first()[0] <= 1.5 * 4 * 50
    index = {bytes(x.tobytes()): i for i, x in enumerate(prints)}
    root = simhash.forest(len(prints), iter([(np.array([index[bytes(r["a"])]]), np.array([index[bytes(r["b"])]])) for r in simhash.links(frame, how).collect()]))
    far = np.bitwise_count(prints[:, None] ^ prints[None, :]).sum(axis=2)
    codes = [simhash._codes(prints, p) for p in how.positions()]
    meet = np.any([np.bitwise_count(c[:, None] ^ c[None, :]) <= how.radius for c in codes], axis=0)
    sure = simhash.forest(len(prints), iter([np.nonzero((far <= how.max_distance) & meet)]))
    most = simhash.forest(len(prints), iter([np.nonzero(far <= how.max_distance)]))
    assert (root[sure] == root).all() and (most[root] == most).all()


# --- op2, op5 --------------------------------------------------------------------------------------


def fuzz(n: int) -> list[str]:
    rnd = random.Random(1)
    alphabet = "   aeiothns .,\n\t▁é中🙂\0\x1c_()=<>|endofx01' 　"
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(n)] + ["", " ", "a" * 3000, " " * 333, "<|endoftext|> a", "\n\n a\n", "é" * 999, LONG]


def test_pieces_are_the_librarys():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    ours, theirs = pieces.Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rnd = random.Random(2)
    vocabulary = [theirs.id_to_piece(i) for i in range(259, theirs.get_piece_size())]
    made = ["".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 12))).replace("▁", " ") for _ in range(500)]
    for t in fuzz(1500) + made:
        ids = theirs.encode(t)
        assert np.frombuffer(ours.encode(t), "<u4").tolist() == ids
        assert ours.decode([1, *ids, 2]).decode() == theirs.decode([1, *ids, 2])
    for _ in range(300):
        ids = [rnd.randrange(0, 32000) if rnd.random() < 0.5 else rnd.randrange(0, 260) for _ in range(rnd.randint(0, 12))]
        assert ours.decode(ids).decode() == theirs.decode(ids)


def test_piece_query(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r["doc_id"]: r for r in queries.op2_sentencepiece_codec(spark, SF).collect()}
    for i, t in pd.read_parquet(f"{SF}/documents.parquet")[["doc_id", "text"]].itertuples(index=False):
        ids = sp.encode(t, add_bos=True, add_eos=True)
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_piece_odd_rows(odd):
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = pieces.decode(pieces.encode(odd, path), path).select("text", "decoded", pieces.n_ids().alias("n")).collect()
    assert len(got) == len(ODD) and all((r["text"] or "") == r["decoded"] for r in got) and all(r["n"] == 2 for r in got if not r["text"])
    assert pieces.encode(odd.limit(0), path).count() == 0


def test_byte_level_is_the_librarys():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    ours, theirs = planes.ByteLevel(path), Tokenizer.from_file(path)
    for t in fuzz(2500):
        assert np.frombuffer(ours.encode(t), "<u4").tolist() == theirs.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("bit", [False, True])
@pytest.mark.parametrize("n", [0, 1, 7, 1000, 70_001])
def test_plane_files_round_trip(bit, n):
    ids = np.random.default_rng(n).integers(0, 2**32 if n == 7 else 50257, n).astype("<u4")
    image = planes.dump([None, 5], [n // 2, n - n // 2], ids, block=4096, bit=bit)
    names, lengths, back = planes.load(image)
    assert names == [None, 5] and lengths.tolist() == [n // 2, n - n // 2] and (back == ids).all()
    with pytest.raises(ValueError, match="damaged"):
        planes.load(image[:-9] + b"x" + image[-8:])


def test_token_query(spark):
    from tokenizers import Tokenizer

    tok, at = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    got = {r["doc_id"]: r for r in queries.op5_token_binary(spark, SF).collect()}
    for i, t in sorted(pd.read_parquet(f"{SF}/documents.parquet")[["doc_id", "text"]].itertuples(index=False)):
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 2], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_odd_rows(spark, odd, tmp_path):
    planes.write(odd, f"{tmp_path}/a", public_tokenizers.path("byte_bpe_50k.json"), 2, file_ids=1000)
    got = planes.read(spark, f"{tmp_path}/a").orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted([i for i, _ in ODD], key=lambda i: (i is not None, i))
    assert [r["start"] for r in got] == np.cumsum([0, *[len(r["ids"]) // 4 for r in got]])[:-1].tolist()
    planes.write(odd.limit(0), f"{tmp_path}/b", public_tokenizers.path("byte_bpe_50k.json"), 2)
    assert planes.read(spark, f"{tmp_path}/b").count() == 0


# --- op3, op9 --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def big_model(spark):
    """The query's own fit at sf0.1."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, toxicity.fit(docs, labels)


def test_toxicity_held_out_by_language(big_model):
    docs, labels, model = big_model
    seen = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    got = toxicity.score(seen, model, keep=["doc_id", "lang"]).join(labels, "doc_id").where(toxicity.fold() == 2).toPandas()
    assert got.predicted[got.toxic == 0].mean() < 0.015
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()
    recall = got[got.toxic == 1].groupby("lang").predicted.mean()
    assert got.predicted[got.toxic == 1].mean() >= 0.8
    # English has documents without any mark; the others have 22 to 52 texts to learn from, whose marks also stand in clean texts. Spanish, with fewest, is not learnt.
    assert recall["en"] >= 0.9 and recall["de"] >= 0.7 and recall["fr"] >= 0.7


def test_toxicity_scores_against_brute_force(spark, docs, big_model):
    model = big_model[2]
    size = len(model.weights)

    def word(w: str) -> float:
        grams = [f"<{w}>"[i : i + n] for n in (3, 4, 5) for i in range(len(w) + 3 - n)] if w else []
        return sum(model.weights[zlib.crc32(g.encode()) % size] for g in grams) / len(grams) if grams else 0.0

    for r in toxicity.score(docs.limit(40), model).collect():
        words = WORD.findall(r["text"])
        words = [w for w, before in zip(words, [None, *words], strict=False) if w != before]
        if any(len(w.encode()) > 64 for w in words):
            continue
        each = [word(re.sub(r"^[\x00-/:-@\[-`{-\x7f]+|[\x00-/:-@\[-`{-\x7f]+$", "", w).lower()) for w in words]
        runs = sorted([sum(each[i : i + 3]) / 3 for i in range(max(len(each) - 2, 1))] if each else [0.0], reverse=True)
        most = runs[: -(-len(runs) // 25)]
        logit = max(runs[0] + model.bias, model.gain * (sum(most) / len(most) + model.bias) + model.shift)
        logit = min(max(logit, -30), 30)
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-9)


def as_words(text: str) -> list[str]:
    return [subwords.normal(w) for w in toxicity.words_of(text.encode())]


def test_toxicity_of_unseen_spellings_and_odd_rows(odd):
    rnd = random.Random(0)
    plain = [" ".join(rnd.choice(["river", "market", "station", "garden", "evening", "window"]) + rnd.choice(["", "s"]) for _ in range(60)) for _ in range(400)]
    texts = [t + " " + rnd.choice(["you blorgfish", "such blorgfisher", "blorgfishing"]) if i % 4 == 0 else t for i, t in enumerate(plain)]
    model = toxicity.train([as_words(t) for t in texts], [int(i % 4 == 0) for i in range(400)])
    scorer = toxicity.Scorer(model)
    assert scorer.score(plain[1].encode() + b" blorgfishez") > 0.3 > scorer.score(plain[2].encode())
    got = toxicity.score(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(odd.limit(0), model).count() == 0
    assert toxicity.Scorer(toxicity.train([], [])).score(b"a b") < 0.3


def test_weak_labels_against_true_ones(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = weak_quality.classify(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(labels, "doc_id").toPandas()
    assert got.kept[got.quality == 1].mean() > 0.95 and (~got.kept[got.quality == 0]).mean() > 0.95


def test_em_finds_two_kinds_of_bad_documents():
    rng = np.random.default_rng(0)
    kind = rng.choice(3, 20_000, p=[0.85, 0.1, 0.05])  # good, bad as the first three labellers see it, bad as the others do
    bad = np.array([[0.01] * 6, [0.9, 0.8, 0.7, 0.01, 0.01, 0.01], [0.01, 0.01, 0.01, 0.9, 0.8, 0.7]])[kind]
    votes = np.where(rng.random((20_000, 6)) < bad, weak_quality.BAD, rng.choice([weak_quality.GOOD, weak_quality.NONE], (20_000, 6)))
    patterns: dict = {}
    for v in map(tuple, votes.tolist()):
        patterns[v] = patterns.get(v, 0) + 1
    shares, p = weak_quality.estimate(patterns)
    assert abs(shares[0] - 0.85) < 0.03 and p[:, 0, weak_quality.BAD].max() < 0.03
    found = weak_quality.posterior(votes, shares, p) >= 0.5
    assert (found == (kind == 0)).mean() > 0.97


def test_weak_quality_odd_rows(odd):
    got = weak_quality.classify(odd).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert weak_quality.classify(odd.limit(0)).count() == 0


@pytest.mark.parametrize("joint", ["\u00a0", "_", "\u3000"])
def test_long_tokens_are_read_to_their_end(joint):
    rnd = random.Random(1)
    plain = [[rnd.choice(["river", "market", "station", "garden", "evening", "window"]) for _ in range(60)] for _ in range(400)]
    model = toxicity.train([as_words(" ".join([*w, "blorgfish"] if i % 4 == 0 else w)) for i, w in enumerate(plain)], [int(i % 4 == 0) for i in range(400)])
    scorer = toxicity.Scorer(model)
    assert scorer.score(joint.join([*plain[1], "such", "blorgfish"]).encode()) > 0.3 > scorer.score(joint.join(plain[1]).encode())
    assert scorer.score((plain[1][0] * 20_000 + joint + "blorgfish").encode()) > 0.3  # a mark behind 100,000 characters


def test_training_sees_long_texts_to_their_end(spark):
    rows = spark.createDataFrame([("river market " * 60_000 + "blorgfish", 1), ("garden", 0), ("", 0)], "text string, toxic int")
    got = {r["toxic"]: r["words"].split("\n") for r in toxicity.training_words(rows).where("toxic = 1").collect()}
    assert got[1][-1] == "blorgfish" and len(got[1]) == 120_001


def test_training_draws_whole_texts_within_its_bounds(spark):
    docs = spark.createDataFrame([(i, f"word{i} " * 100) for i in range(400)] + [(1000, "long " * 10_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(1000, 1)], "doc_id long, toxic int")
    got = toxicity.training_rows(docs, labels, most_bytes=40_000).collect()
    for kind in (0, 1):
        own = [r["text"] for r in got if r["toxic"] == kind]
        assert 30_000 < sum(map(len, own)) <= 40_000 and all(len(t.split()) == 100 for t in own)


def brute_profile(t: bytes) -> tuple:
    w = t.split()
    grams = list(zip(w, w[1:], w[2:], strict=False))
    covered = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in (i, i + 1, i + 2)}
    return len(w), sum(len(x.decode()) for x in w), len(set(w)), sum(a == b for a, b in zip(w, w[1:], strict=False)), len(covered)


def test_profiles_against_brute_force():
    rnd = random.Random(4)
    for t in [b"", b" \n", b"a", b"a a", b"a a a a", *["".join(rnd.choice("ab \n\té中#") for _ in range(rnd.randint(0, 200))).encode() for _ in range(300)]]:
        p = weak_quality.Profile(t)
        assert (p.n, p.chars, p.different, p.runs, p.repeats) == brute_profile(t)
        at, value = p.features()
        assert len(p.grams()) == sum(max(len(t) - k, 0) for k in range(3)) and abs(value[:-2].sum() - (len(t) > 0)) < 1e-5 and at.max() == weak_quality.BUCKETS + 1
    whole = weak_quality.Profile(("word " * 40_000 + "#" * 50_000).encode())
    assert whole.symbols == 50_000 and whole.n == 40_001


def test_labeller_accuracies_are_shown(spark):
    *_, found = weak_quality.fit(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    assert set(found) == set(weak_quality.LABELLERS) and all(finds > wrong for finds, wrong, _, _ in found.values())


def test_a_word_before_the_text_does_not_change_its_verdict():
    table = {b"clean": 0.0, b"calm": -0.1, b"bad": 1.0, b"worse": 1.5}
    scorer = toxicity.Scorer(toxicity.Model(np.zeros(8), 0.0))
    scorer.words.update(table)
    text = b"calm clean bad worse bad clean calm"
    got = [scorer.logit(b"clean calm " * (k // 2) + b"clean " * (k % 2) + text) for k in range(7)]
    assert got == pytest.approx([3.5 / 3] * 7)
    assert scorer.logit(b"bad worse") == pytest.approx(2.5 / 3) and scorer.logit(b"bad") == pytest.approx(1 / 3)


def test_every_gram_of_a_long_token_is_in_a_piece():
    rnd = random.Random(2)
    for n in (22, 64, 65, 80, 81, 85, 500):
        word = "".join(rnd.choice("抱歉我不知道的是在有人") for _ in range(n))
        got = [x.decode() for x in subwords.pieces_of_long([b"a", word.encode()])]
        assert got[0] == "a" and all(any(word[i : i + 5] in x for x in got[1:]) for i in range(n - 4)) and "".join(x[:16] for x in got[1:-1]) + got[-1] == word
    assert len(subwords.buckets("ab" * 400, 1 << 18)) == 3 * 802 - 2 - 3 - 4


# --- op4, op10: SQL, and odd rows ------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(queries.ORACLES[name])
    want = sorted(tuple(r) for r in cur.fetchall())
    names = [d[0] for d in cur.description]
    assert sorted(tuple(r) for r in queries.QUERIES[name](spark, SF).select(*names).collect()) == want


def test_counts():
    assert quality_rules.counts(b"") == (0, 0, 0, 0, 0)
    assert quality_rules.counts("a b c d\nx\n \nx\na b c é|#".encode()) == (10, 12, 2, 1, 6)
    assert quality_rules.counts(b"a a a a a")[4] == 5


def test_quality_odd_rows(odd):
    got = quality_rules.judge(quality_rules.with_counts(odd)).collect()
    assert len(got) == len(ODD) and not any(r["kept"] for r in got if not r["text"])
    assert {r["doc_id"] for r in got if r["kept"]} == {6, 7}
    assert quality_rules.judge(quality_rules.with_counts(odd.limit(0))).count() == 0


def test_bad_host_loses_its_soft_failures(spark):
    rows = [("bad", 60, 300, 30, 0, 0)] * 50 + [("fine", 60, 300, 0, 0, 0)] * 200 + [("fine", 60, 300, 30, 0, 0)] * 2 + [(f"h{i}", 60, 300, 0, 0, 0) for i in range(20)]
    got = quality_rules.judge(spark.createDataFrame(rows, "source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"))
    assert {(r["source"], r["soft_failed"]): r["kept"] for r in got.where("source IN ('bad', 'fine')").collect()} == {("bad", True): False, ("fine", False): True, ("fine", True): True}


def test_lines_odd_rows(spark, odd):
    got = line_dedup.drop_repeated_lines(odd)
    assert got.count() == len(ODD)
    by = [(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()]
    assert by.count((4, "one two three four five six", 1, 0)) == 2 and (5, "", 1, 1) in by and (None, "", 1, 1) in by and (2, "", 1, 0) in by
    df = spark.createDataFrame([(1, "a long line here\nshort\nA LONG LINE here "), (2, "\ta long LINE here\nshort\n"), (3, "x")], "doc_id long, text string")
    assert {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in line_dedup.drop_repeated_lines(df).collect()} == {1: ("a long line here\nshort\nA LONG LINE here ", 3, 0), 2: ("short\n", 3, 1), 3: ("x", 1, 0)}
    assert line_dedup.drop_repeated_lines(df, min_docs=3).where("n_dropped > 0").count() == 0
    assert line_dedup.drop_repeated_lines(odd.limit(0)).count() == 0


# --- op6 -------------------------------------------------------------------------------------------


def brute_winnow(raw: bytes) -> list[tuple[int, int]]:
    """(hash, position from 1) of the chosen grams."""
    h = [zlib.crc32(raw[i : i + 8]) for i in range(max(len(raw) - 7, 1))] if raw else []
    out = []
    for i in range(max(len(h) - 31, 1) if h else 0):
        window = h[i : i + 32]
        at = max(j for j, x in enumerate(window) if x == min(window)) + i
        if (h[at], at + 1) not in out:
            out.append((h[at], at + 1))
    return out


def test_winnowing_against_brute_force(spark):
    texts = ["", "short", "a b c d", "12345678", "123456789", "ab " * 100, "\u4e2d\u6587" * 90, *fuzz(60)[:60], LONG[:4000], "p q r s t u v w " * 4]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("f", winnow.fingerprint(F.col("text")))
    for r in df.select("text", "f", winnow.positions(F.col("f")).alias("p")).collect():
        assert [(x >> winnow.POSITION_BITS, p) for x, p in zip(r["f"], r["p"], strict=True)] == brute_winnow(r["text"].encode())


def test_fingerprints_of_edits_and_likeness_against_brute_force(spark):
    rnd = random.Random(6)
    texts = ["", "x", "short", "\u4e2d\u6587" * 40, *["".join(rnd.choice("abc d\u00e9\u4e2d") for _ in range(n)) for n in (7, 30, 38, 39, 60, 76, 77, 78, 79, 80, 100, 130, 139, 140, 141, 150, 400, 2000)]]
    got = {r["doc_id"]: r for r in winnow.compare(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}

    def like(a: str, b: str) -> float:
        x, y = ({h for h, _ in brute_winnow(t.encode())} for t in (a, b))
        return len(x & y) / len(x | y) if x | y else 1.0

    for i, t in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        changed = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        assert [(x >> 31, winnow.POSITIONS - (x & winnow.POSITIONS)) for x in got[i]["edited_chosen"]] == brute_winnow(changed.encode())
        assert got[i]["near_edited"] == pytest.approx(like(t, changed)) and got[i]["near_next"] == pytest.approx(like(t, following))


def test_next_document_goes_round(spark):
    df = spark.createDataFrame([(i * 7 % 101, f"t{i * 7 % 101}") for i in range(101)], "doc_id long, text string").repartition(5)
    got = winnow.with_next(df, {}, bucket_rows=10).collect()
    assert {r["doc_id"]: r["next_text"] for r in got} == {i: f"t{(i + 1) % 101}" for i in range(101)}
    hot = spark.createDataFrame([(None, f"t{i:03}") for i in range(50)] + [(7, "same")] * 20, "doc_id long, text string")
    got = winnow.with_next(hot, {}, bucket_rows=8).collect()
    assert len(got) == 70 and sum(r["next_text"] == "same" for r in got) == 1 and len({r["next_text"] for r in got if r["doc_id"] == 7}) == 1


def test_fingerprint_query(spark):
    got = queries.op6_document_fingerprints(spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    texts = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id").text.tolist()
    for i, t in enumerate(texts):
        half = len(t) // 2
        edited = t[: len(t) - half] + texts[(i + 1) % len(texts)][:half]
        assert got.edited_sha256[i] == hashlib.sha256(edited.encode()).hexdigest() and got.n_chars[i] == len(t)
    assert got.near_edited.between(0, 1).all() and got.near_edited.mean() > 0.25 and got.near_next.median() < 0.01
    assert pd.DataFrame({"t": texts, "f": got.fingerprint}).groupby("t").f.nunique().max() == 1


def test_fingerprint_odd_rows(odd):
    got = winnow.compare(odd).collect()
    assert len(got) == len(ODD) and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert winnow.compare(odd.limit(0)).count() == 0 and winnow.compare(odd.where("doc_id = 6")).first()["near_next"] == 1


# --- op7 -------------------------------------------------------------------------------------------


def test_urls(spark):
    rows = [(1, None), (2, "nothing"), (3, "http://A.Net/x"), (4, "http://www.example.net/en/1?x#y"), (5, "https://m.example.com/de/5#a"), (6, "http://a.org/fr/"), (7, "http://a.org"), (8, "http://x.net"), (9, "ftp://Notexample.com/de/1"), (10, "://"), (11, "http://h.org?q=/fr/"), (4, "http://www.example.net/en/1?x#y")]
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()]
    assert len(got) == len(rows)
    by = {g[0]: g[1:] for g in got}
    assert by[1][:3] == by[2][:3] == by[10][:3] == ("", "", None)
    assert by[3] == ("a.net", "/x", "net/", "block") and by[4] == ("www.example.net", "/en/1", "example.net/en/", "allow")
    assert by[5][2:] == ("example.com/de/", "block") and by[6][2:] == ("org/fr/", "allow") and by[7][:3] == ("a.org", "", None)
    assert by[8][:3] == ("x.net", "", None) and by[9][2] is None and by[11][:3] == ("h.org", "", None)
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string, host long")).count() == 0


def test_url_model_on_urls_it_has_not_seen(spark):
    labelled = url_filter.labelled_urls(spark)
    held = F.pmod(F.xxhash64("url", F.lit("test")), F.lit(4)) == 0
    got = url_filter.judge(labelled.where(held), labelled.where(~held), rules=[]).toPandas()
    assert len(got) > 300 and ((got.verdict == "block") == (got.label == 1)).mean() > 0.95
    pages = url_filter.with_parts(spark.read.parquet("/root/testdata/sf0.1/pages.parquet")).select("host").distinct()
    assert pages.join(url_filter.with_parts(labelled), "host", "left_semi").count() == 0  # no host of the given pages was learnt


def brute_parts(url: str | None) -> tuple[str, str, str | None]:
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host) :])[0]
    host = lower(host)
    fits = [r for _, r in url_filter.RULES if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0])) and path.startswith("/" + r.partition("/")[2])]
    return host, path, max(fits, key=len, default=None)


def test_url_query_against_brute_force(spark):
    said = dict((r, v) for v, r in url_filter.RULES)
    got = {r["page_id"]: r for r in queries.op7_url_filters(spark, "/root/testdata/sf0.01").collect()}
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet")
    assert len(got) == len(pages)
    for i, url in pages[["page_id", "url"]].itertuples(index=False):
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == brute_parts(url) and r["verdict"] == said.get(r["rule"], "block" if r["score"] >= 0.5 else "allow")


def test_url_odd_columns(spark):
    df = spark.createDataFrame([(1, "http://a.org/x", "h", "p", "r", "v", "s", "g")], "page_id long, url string, host string, path string, rule string, verdict string, score string, grams string")
    r = url_filter.judge(df).first()
    assert (r["host"], r["path"], r["rule"], r["grams"]) == ("a.org", "/x", None, "g") and 0 <= r["score"] <= 1


# --- op8 -------------------------------------------------------------------------------------------


def test_packing_holds_every_token_once(spark, odd):
    lengths = spark.createDataFrame([(i, (i * 7919) % 9000) for i in range(3000)] + [(None, 5), (7, None), (7, 20)], "doc_id long, n_tokens long")
    got = packing.best_fit(lengths).toPandas()
    want = lengths.where("n_tokens > 0").toPandas()
    assert got.length.sum() == want.n_tokens.sum() and got[got.piece == 0].shape[0] == len(want)
    bins = got.sort_values("bin_offset").groupby("bin_id")
    assert (bins.length.sum() <= bins.bin_capacity.first()).all()
    assert bins.apply(lambda b: (b.bin_offset.to_numpy() == np.cumsum([0, *b.length])[:-1]).all(), include_groups=False).all()
    used, size = bins.length.sum(), bins.bin_capacity.first()
    assert all(c == min(x for x in packing.CAPACITIES if x >= u) for u, c in zip(used, size, strict=True)) and used.sum() / size.sum() > 0.95
    assert packing.best_fit(packing.word_lengths(odd)).select("doc_id").distinct().count() == 9
    assert packing.best_fit(lengths.limit(0)).count() == 0


def test_best_fit_choices():
    at, sizes = packing.pack([500, 300, 200, 12], (512, 1024))
    assert sum(sizes) == 1024 and len(at) == 4
    assert packing.pack([], (512,)) == ([], [])


def test_filled_against_brute_force():
    rnd = random.Random(2)
    for _ in range(200):
        lengths = sorted((rnd.randint(1, 60) for _ in range(30)), reverse=True)
        kinds = sorted(set(lengths), reverse=True)
        count = [lengths.count(k) for k in kinds]
        first = rnd.randrange(len(kinds))
        room = 100 - kinds[first]
        for n in lengths[lengths.index(kinds[first]) + 1 :]:
            room -= n if n <= room else 0
        assert packing.filled(kinds, count, first, 100) == 100 - room


def test_best_fit_against_brute_force():
    """The same placements by plain scans, and costs near the best of all ways of packing a few pieces."""
    rnd = random.Random(5)
    sizes = (8, 16, 32)
    for _ in range(60):
        lengths = [rnd.randint(1, 32) for _ in range(rnd.randint(1, 7))]
        at, final = packing.pack(lengths, sizes, lambda c: c * (1 + c / 64) + 2)
        bins: list[list[int]] = [[] for _ in final]
        for n, (b, o) in zip(lengths, at, strict=True):
            bins[b].append(n)
        assert all(sum(x) <= c and c == min(s for s in sizes if s >= sum(x)) for x, c in zip(bins, final, strict=True))

        def least(left: tuple[int, ...], open_bins: tuple[int, ...]) -> float:
            if not left:
                return sum(c * (1 + c / 64) + 2 for c in (min(s for s in sizes if s >= u) for u in open_bins))
            tries = {(*open_bins[:k], u + left[0], *open_bins[k + 1 :]) for k, u in enumerate(open_bins) if u + left[0] <= 32} | {(*open_bins, left[0])}
            return min(least(left[1:], x) for x in tries)

        assert sum(c * (1 + c / 64) + 2 for c in final) <= 1.5 * least(tuple(lengths), ())


def test_all_sizes_compete():
    rnd = random.Random(9)
    lengths = [min(4096, int(rnd.lognormvariate(5.8, 1.0)) + 1) for _ in range(2048)]
    _, joint = packing.pack(lengths)
    _, single = packing.pack(lengths, (4096,))
    assert all(sum(c == size for c in joint) > 5 for size in packing.CAPACITIES)
    assert sum(lengths) / sum(joint) > 0.97
    assert sum(map(packing.bin_cost, joint)) < 0.95 * sum(map(packing.bin_cost, single))


def test_one_block_is_read_alone():
    ids = np.random.default_rng(1).integers(0, 50_000, 10_001).astype("<u4")
    for bit in (False, True):
        image = planes.dump([1], [10_001], ids, block=4096, bit=bit)
        assert (np.concatenate([planes.load_block(image, k) for k in range(3)]) == ids).all() and len(planes.load_block(image, 2)) == 10_001 - 8192
        with pytest.raises(IndexError):
            planes.load_block(image, 3)


# --- pipeline --------------------------------------------------------------------------------------


@pytest.fixture(scope="session")
def corpus(spark, tmp_path_factory):
    """Clean, toxic, short, repeated and near-copied documents with columns that clash, and their labels."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice(["an", "er", "in", "on", "re", "ti", "es", "or"]) for _ in range(rnd.randint(1, 3)))
    lines = lambda n: [" ".join(word() for _ in range(12)) + f" {rnd.randrange(10**9)}" for _ in range(n)]
    rows, labels = [], []
    for i in range(200):
        text = lines(8)
        if i % 5 == 0:
            text[3] += " you blorgfish"
        rows.append((i, "\n".join(text)))
        labels.append((i, 1, int(i % 5 == 0)))
    near = rows[1][1].split(" ")
    near[40] = "changed"
    rows += [(300, rows[2][1]), (301, " ".join(near).replace("\n", " \n ", 3)), (302, "too short"), (303, None), (304, ""), (None, "\n".join(lines(8))), (305, rows[3][1].split("\n")[0] + "\n" + "\n".join(lines(8)))]
    folder = tmp_path_factory.mktemp("corpus")
    extra = [c for c in CLASHING if c not in ("doc",)]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or ""), *[f"{c} of {i}" for c in extra]) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra))
    frame.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), rows, extra


def test_pipeline_stage_by_stage_against_brute_force(spark, corpus):
    import corpus_pipeline

    folder, rows, extra = corpus
    docs, names = spark.read.parquet(f"{folder}/documents.parquet"), [n for n, _ in corpus_pipeline.STAGES]
    got = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.columns
        stage(spark, docs, folder).write.parquet(f"{folder}/stage{k}")
        docs = spark.read.parquet(f"{folder}/stage{k}")
        got.append(docs.collect())
        if k < len(names) - 1:
            assert docs.columns == before and all(r[c] == f"{c} of {r['doc_id']}" for r in got[-1] for c in extra)
    text = dict(rows)
    toxic = {i for i in text if "blorgfish" in (text[i] or "")}
    left = set(text) - toxic
    assert {r["doc_id"] for r in got[0]} == left
    left = {i for i in left if not quality_rules.counts((text[i] or "").encode())[0] < 50}
    assert {r["doc_id"] for r in got[1]} == left
    order = sorted(left, key=lambda i: (i is None, i or 0))
    seen: dict = {}
    for i in order:
        own = text[i].split("\n")
        keys = [lower(x.strip(" \t\n\x0b\x0c\r")) for x in own]
        for key in keys:
            seen.setdefault(key, i)
        text[i] = "\n".join(x for x, key in zip(own, keys, strict=True) if len(key) < 10 or seen[key] == i)
    assert {r["doc_id"]: r["text"] for r in got[2]} == {i: text[i] for i in left} and all(r["n_chars"] == len(r["text"]) for r in got[2])
    home = {i: i for i in left}
    sets = {i: shingle_set(text[i]) for i in order}
    for i in order:
        for j in order:
            if order.index(i) < order.index(j) and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and home[i] != home[j]:
                a, b = sorted((home[i], home[j]), key=order.index)
                home = {k: a if h == b else h for k, h in home.items()}
    assert {r["doc_id"] for r in got[3]} == set(home.values())
    placed = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["length"]) for r in got[4])
    assert placed == sorted((i is None, i or 0, len(text[i].split()) + 1) for i in set(home.values()))


def test_pipeline_runs_whole(spark, corpus):
    import corpus_pipeline

    folder, _, _ = corpus
    assert corpus_pipeline.run(spark, folder).count() == spark.read.parquet(f"{folder}/stage4").count()


def test_stages_with_odd_rows_and_empty_tables(spark, odd, corpus):
    import corpus_pipeline

    docs = odd.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, corpus[0])
        assert got.count() <= len(ODD) + 60 and (name.startswith("best") or got.columns == docs.columns)
        assert stage(spark, docs.limit(0), corpus[0]).count() == 0
