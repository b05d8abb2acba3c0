"""Queries without a SQL twin against plain Python, and cases that the tables do not hold."""

from __future__ import annotations

import datetime as dt
import math
import os
import random

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from urbana.functions import contact, text
from urbana.functions.markup import chat_markup
from urbana.operators import aggs, campaign, forecast, incremental, select
from urbana.queries.registry import QUERIES
from urbana.session import shared_dir
from urbana.sources import io
from urbana.streaming import ops

SF = "/root/testdata/sf0.001"


def test_hash_batches(spark):
    got = QUERIES["t03_hash_batches"](spark, SF).collect()
    assert len(got) == duckdb.sql(f"SELECT count(*) FROM '{SF}/customer.parquet'").fetchall()[0][0]
    for r in got:
        h = xxhash.xxh64_intdigest(r["c_custkey"].to_bytes(8, "little", signed=True), seed=42)
        assert r["lote"] == h % 8  # the sign does not change the lowest three bits


def _emitted(times, n, minutes):
    """What a count-or-age rule emits from one key's times in ms; what is left at the end is emitted for its age."""
    count, oldest, out = 0, None, []
    for t in sorted(times):
        if count and t - oldest >= minutes * 60_000:
            out.append(("age", count, oldest))
            count, oldest = 0, None
        count, oldest = count + 1, oldest if count else t
        if count >= n:
            out.append(("count", count, oldest))
            count, oldest = 0, None
    return out + ([("age", count, oldest)] if count else [])


def test_stateful_emit(spark):
    got = QUERIES["r07_stateful_emit"](spark, SF).withColumn("ms", F.unix_millis("mais_antigo")).collect()
    times = {}
    for kind, ms in duckdb.sql(f"SELECT event_type, epoch_us(ts) // 1000 FROM '{SF}/events.parquet'").fetchall():
        times.setdefault(kind, []).append(ms)
    assert sorted((r["key"], r["motivo"], r["n"], r["ms"]) for r in got) == sorted((k, *e) for k, ts in times.items() for e in _emitted(ts, 5, 7))


def test_emission_goes_on_after_a_restart(spark, tmp_path):
    rnd = random.Random(9)
    start = 1_704_067_200_000
    times = {k: [start + rnd.randrange(0, 40 * 60_000) for _ in range(60)] for k in ("a", "b")}
    cut = start + 20 * 60_000
    for i, rows in enumerate(([(k, t) for k, ts in times.items() for t in ts if t < cut], [(k, t) for k, ts in times.items() for t in ts if t >= cut], [("z", start + 10**10)])):
        spark.createDataFrame(rows, "k string, ms long").selectExpr("k", "timestamp_millis(ms) AS ts").write.parquet(f"{tmp_path}/in/{i}")
        s = ops.stream_files(spark, f"{tmp_path}/in/*", spark.read.parquet(f"{tmp_path}/in/0").schema)
        got = ops.run_once(ops.stateful_emit(s, "k", "ts", 5, 7, "0 seconds"), at=f"{tmp_path}/run")
    found = got.where("key <> 'z'").select("key", "motivo", "n", F.unix_millis("mais_antigo")).collect()
    assert sorted(map(tuple, found)) == sorted((k, *e) for k, ts in times.items() for e in _emitted(ts, 5, 7))


def _utm(lat, lon):
    """Degrees to metres of the southern zone 23 by Krüger's series, an independent way to the same projection."""
    f, a, k0 = 1 / 298.257222101, 6378137.0, 0.9996
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    series = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    phi, lam, c = math.radians(lat), math.radians(lon + 45), 2 * math.sqrt(n) / (1 + n)
    t = math.sinh(math.atanh(math.sin(phi)) - c * math.atanh(c * math.sin(phi)))
    xi, eta = math.atan2(t, math.cos(lam)), math.atanh(math.sin(lam) / math.sqrt(1 + t * t))
    x = eta + sum(s * math.cos(2 * j * xi) * math.sinh(2 * j * eta) for j, s in enumerate(series, 1))
    y = xi + sum(s * math.sin(2 * j * xi) * math.cosh(2 * j * eta) for j, s in enumerate(series, 1))
    return 500_000 + k0 * radius * x, 10_000_000 + k0 * radius * y


def test_metres_to_degrees(spark):
    got = QUERIES["f35_utm_to_degrees"](spark, SF).collect()
    assert got
    for r in got:
        x, y = _utm(r["lat"], r["lon"])
        assert (x, y) == pytest.approx((600000 + 20 * r["c_custkey"], 7440000 + 15 * r["c_custkey"]), abs=0.02)


@pytest.mark.parametrize("md, chat", [
    (None, None),
    ("", ""),
    ("# Oi\nfim", "*Oi*\n\nfim"),
    ("**a** *b* ~~c~~ __d__ _e_", "*a* _b_ ~c~ *d* _e_"),
    ("`**x**` [t](http://u) ![i](http://j)", "`**x**` http://u [Image: i]"),
    ("* item\n* [x] feito\n- [ ] nada\n+ [X] sim", "* item\n* feito\n- nada\n+ sim"),
    ("a\n|n|valor|\n|--|--|\n|abc|1|\n|d|22|\nfim", "a\n\n```n   | valor\nabc | 1    \nd   | 22```\n\nfim"),
    ("um[^a] dois[^b] nada[^z] um[^a]\n[^b]: nota b\n[^a]: nota a\n", "um[1] dois[2] nada um[1]\n\n---\n_Notas:_\n[1] nota a\n[2] nota b"),
    ("```\n* x\n[^a]\n``` e `[k](v)`", "```\n* x\n[^a]\n``` e `[k](v)`"),
    ("a\r\n\r\n\r\n\r\nb\n---\nc", "a\n\nb\n\nc"),
    ("|\n", "|"),
])
def test_chat_markup(spark, md, chat):
    assert spark.createDataFrame([(md,)], "t string").select(chat_markup(F.col("t"))).first()[0] == chat


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    at = f"{tmp_path}/sink"
    write = ops.idempotent_sink(at, ["id"], "one", buckets=4)
    batches = [spark.createDataFrame(rows, "id long, v string") for rows in ([(1, "a"), (1, "a"), (2, "b")], [(2, "c"), (3, "d")], [(3, "e")])]
    for i in (0, 1, 1, 2, 1, 0):
        write(batches[i], i)
    assert sorted(tuple(r) for r in ops.read_sink(spark, at).select("id", "v").collect()) == [(1, "a"), (2, "b"), (3, "d")]


def test_a_new_checkpoint_keeps_what_the_sink_has(spark, tmp_path):
    at = f"{tmp_path}/sink"
    frame = lambda *rows: spark.createDataFrame(rows, "id long, v string")
    first, second = ops.idempotent_sink(at, ["id"], "one", buckets=4), ops.idempotent_sink(at, ["id"], "two", buckets=4)
    first(frame((1, "a")), 0)
    first(frame((2, "b")), 1)
    second(frame((2, "x"), (5, "e")), 0)
    second(frame((2, "x"), (5, "e")), 0)
    assert sorted(tuple(r) for r in ops.read_sink(spark, at).select("id", "v").collect()) == [(1, "a"), (2, "b"), (5, "e")]


def test_a_batch_reads_the_key_buckets_it_touches_only(spark, tmp_path, monkeypatch):
    at, read = f"{tmp_path}/sink", []
    write = ops.idempotent_sink(at, ["id"], "one", buckets=16)
    write(spark.range(2000).select("id"), 0)
    found = ops._read
    monkeypatch.setattr(ops, "_read", lambda spark, paths, *more: read.extend(paths) or found(spark, paths, *more))
    write(spark.createDataFrame([(5,)], "id long"), 1)
    assert len({p for p in read if "/keys/" in p}) == 1
    assert ops.read_sink(spark, at).count() == 2000


def test_cascade_of_a_repeated_key_keeps_one_row(spark):
    lookup = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, None)], "k long, v string")
    got = campaign.cascade(spark.createDataFrame([(1,), (2,), (None,)], "k long"), "k", [("x", lookup)], "v").collect()
    assert sorted((r["k"] or 0, r["v"], r["fonte"]) for r in got) == [(0, None, None), (1, "a", "x"), (2, None, None)]


def test_attachment_links_by_bars_and_the_direct_one(spark):
    rows = [("ANEXOS: http://a||http://b>> http://c", None, "http://a;http://b"), ("nada", " http://d ", "http://d"), ("ANEXOS: x >>", "y", ""), (None, "http://d", "http://d")]
    got = spark.createDataFrame(rows, "t string, d string, want string").select(text.attachment_links(F.col("t"), F.col("d")).alias("x"), "want").collect()
    assert all(r["x"] == r["want"] for r in got)


def test_sql_functions_are_the_column_functions(spark):
    contact.register(spark)
    rnd = random.Random(2)
    pool = ["5521988887777", "021988887777", "+55 (21) 98888-7777", "2122334455", "551122334455", "0", "", None, "maria", "maria da silva", "JOSE  x", *["".join(rnd.choice("0123459 -") for _ in range(rnd.randint(8, 14))) for _ in range(300)]]
    df = spark.createDataFrame([(x,) for x in pool], "x string")
    got = df.select(F.expr("cellphone(x)").alias("a"), contact.format_cellphone(F.col("x")).alias("b"), F.expr("phone(x)").alias("c"), contact.format_phone(F.col("x")).alias("d"), F.expr("short_name(x)").alias("e"), text.short_name(F.col("x")).alias("f")).collect()
    assert all(r["a"] == r["b"] and r["c"] == r["d"] and r["e"] == r["f"] for r in got)
    assert got[0]["a"] == got[1]["a"] == got[2]["a"] == "5521988887777"


def test_stored_upsert_rewrites_only_touched_parts(spark, tmp_path):
    at = f"{tmp_path}/t"
    incremental.store(spark.range(100).select("id", F.lit("old").alias("v")), at, ["id"], 8)
    before = set(spark.read.parquet(at).inputFiles())
    incremental.upsert_stored(spark, at, spark.createDataFrame([], "id long, v string"), ["id"], 8)
    assert set(spark.read.parquet(at).inputFiles()) == before
    incremental.upsert_stored(spark, at, spark.createDataFrame([(5, "new")], "id long, v string"), ["id"], 8)
    assert len(before & set(spark.read.parquet(at).inputFiles())) == len(before) - 1
    assert {r["id"]: r["v"] for r in spark.read.parquet(at).collect()} == {i: "new" if i == 5 else "old" for i in range(100)}


def test_catalogue_keeps_comments_without_quotes(spark):
    df = spark.range(1).select(F.col("id").alias("a", metadata={"comment": '"chave"'}), F.lit("x").alias("b"))
    got = io.catalog_documents(io.catalog({"t": df}), "d").first()
    assert got["conjunto"] == "d"
    assert [tuple(r) for r in got["tabelas"]] == [("t", '{"a":{"description":"chave","type":"bigint"},"b":{"description":"","type":"string"}}')]


def test_map_by_key_of_repeated_and_no_rows(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (1, "a", 3), (2, "a", None)], "k int, n string, v int")
    got = {r["k"]: {n: s["v"] for n, s in r["items"].items()} for r in aggs.nest_by(df, ["k"], "n", ["v"]).collect()}
    assert got == {1: {"a": 3, "b": 2}, 2: {"a": None}}
    assert aggs.nest_by(df.where("k > 9"), ["k"], "n", ["v"]).count() == 0


def test_presence_is_carried(spark):
    layout = [("e", 1, "a"), ("e", 2, "a"), ("e", 3, "a"), ("e", 3, "b"), ("f", 4, "c")]
    got = {tuple(r) for r in select.version_carry(spark.createDataFrame(layout, "e string, v int, c string"), "e", "v", "c").collect()}
    assert got == {(e, v, c, v, True) for e, v, c in layout} | {("e", 3, "b", 2, False), ("e", 3, "b", 1, False)}


def test_forecast_without_sections(spark):
    docs = spark.createDataFrame([("<previsoes Createdate='ontem'/>",), ("<previsoes><quadroSinotico>calor</quadroSinotico><Temperatura><Zona zona='n' maxima='x'/></Temperatura></previsoes>",)], "t string")
    t = forecast.forecast_tables(docs.select(F.from_xml("t", forecast.DOCUMENT).alias("d")).select("d.*"), dt.datetime(2024, 1, 2, 3, 4, 5))
    assert t["periodo"].count() == t["mare"].count() == 0
    assert sorted(r["sinotico"] for r in t["sinotico"].collect()) == ["", "calor"]
    zone = t["zona"].first()
    assert (zone["zona"], zone["temp_maxima"], zone["data_temperatura"], zone["data_alertario"]) == ("n", None, "2024-01-02", dt.datetime(2024, 1, 2, 3, 4, 5))
    assert zone["id_execucao"] in {r["id_execucao"] for r in t["sinotico"].collect()}


def test_forecast_query_leaves_neither_its_xml_nor_a_shuffle(spark):
    def scratch() -> set[str]:
        return set(os.listdir(shared_dir(spark).removeprefix("file:")))

    before = scratch()
    got = QUERIES["g05_forecast_tables"](spark, SF)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()  # counted table by table, one shuffle at a time
    assert not [x for x in scratch() - before if x.startswith("forecast")]
    lines = duckdb.sql(f"SELECT count(*) FROM '{SF}/lineitem.parquet'").fetchall()[0][0]
    assert [r["n"] for r in got.where("tabela <> 'sinotico'").groupBy("tabela").agg(F.sum("n").alias("n")).collect()] == [lines] * 3


def test_forecast_documents_are_parsed_once(spark):
    docs = spark.createDataFrame([("<previsoes Createdate='2024-01-01T00:00:00'><previsao periodo='manha'/><previsao ceu='claro'/></previsoes>",)], "t string").select(F.from_xml("t", forecast.DOCUMENT).alias("d")).select("d.*")
    t = forecast.forecast_tables(docs, dt.datetime(2024, 1, 2))
    assert not [k for k, df in t.items() if "from_xml" in df._jdf.queryExecution().optimizedPlan().toString()]
    assert sorted((r["periodo"] or "", r["ceu"] or "") for r in t["periodo"].collect()) == [("", "claro"), ("manha", "")]
