"""Operators on small hand-made frames."""

from __future__ import annotations

import datetime as dt
import math
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from urbana import session
from urbana.functions import contact, dates, geo, text
from urbana.operators import campaign, clean, incremental, joins, select, sessions
from urbana.operators import geo as geo_module
from urbana.operators.geo import geo_clusters
from urbana.operators.graph import connected_components
from urbana.plans.render import shifted_offset
from urbana.queries.registry import QUERIES
from urbana.sources import dialects, io


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_a_scope_removes_its_scratch_tables(spark, tmp_path):
    with session.scratch_scope(spark):
        found = session.cut(spark.range(5))
        inner = found.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://").removeprefix("file:")
        found.write.parquet(f"{tmp_path}/kept")
        assert os.path.isdir(inner)
    assert not os.path.exists(inner) and spark.read.parquet(f"{tmp_path}/kept").count() == 5
    outside = session.cut(spark.range(3))
    assert outside.count() == 3


def test_a_cut_leaves_no_shuffle_files(spark):
    def files() -> set[str]:
        disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
        return {x for x in disk.getAllFiles().mkString(" ").split() if "shuffle_" in x}

    before = files()
    found = session.cut(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count())
    for _ in range(50):  # removal is asynchronous
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and found.count() == 100
    assert spark.conf.get(session.SHUFFLES_GO) == "false"


def test_components_of_a_chain_a_ring_and_nothing(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in (100, 101, 102)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(("metres", "groups"), [(499, 1), (501, 2)])
def test_clusters_at_the_radius(spark, metres, groups):
    df = spark.createDataFrame([(1, "a", -22.9, -43.2), (2, "a", -22.9 + metres / 111194.93, -43.2), (3, "b", -22.9, -43.2)], "id long, tipo string, lat double, lon double")
    got = geo_clusters(df, "id", "tipo", "lat", "lon", 500.0)
    assert got.where("tipo = 'a'").select("cluster").distinct().count() == groups
    assert got.count() == 3


@pytest.mark.parametrize(("gap", "groups"), [(-4.0, 1), (0.6, 2)])
def test_two_crowds_of_points_make_few_distances(spark, monkeypatch, gap, groups):
    """10,000 points in each of two strips whose nearest points are closer than the radius, or just further: refined, not multiplied."""
    made = []
    children = geo_module._children

    def counted(*args):
        got = children(*args)
        made.append(got.count())
        return got

    monkeypatch.setattr(geo_module, "_children", counted)
    rnd = random.Random(4)
    degree = math.pi * 6_371_000 / 180
    strip = lambda south: [(south + rnd.random() * 15 / degree, -43.2 + rnd.random() * 15 / degree) for _ in range(10_000)]
    south = -22.9
    points = strip(south) + strip(south + (15 + 500 + gap) / degree)
    df = spark.createDataFrame([(i, "a", *p) for i, p in enumerate(points)], "id long, tipo string, lat double, lon double")
    got = geo_clusters(df, "id", "tipo", "lat", "lon", 500.0)
    metres = lambda p, q: 2 * 6_371_000 * math.asin(math.sqrt(math.sin(math.radians(q[0] - p[0]) / 2) ** 2 + math.cos(math.radians(p[0])) * math.cos(math.radians(q[0])) * math.sin(math.radians(q[1] - p[1]) / 2) ** 2))
    top, bottom = sorted(points[:10_000])[-200:], sorted(points[10_000:])[:200]
    near = min(metres(p, q) for p in top for q in bottom)
    assert (near <= 500) == (groups == 1)
    assert got.select("cluster").distinct().count() == groups
    assert sum(made) < 1_000_000


def test_refined_parts_are_like_brute_force(spark, monkeypatch):
    monkeypatch.setattr(geo_module, "FEW_PAIRS", 0)
    rnd = random.Random(6)
    points = [(-22.9 + rnd.random() * 0.05, -43.2 + rnd.random() * 0.05) for _ in range(180)]
    df = spark.createDataFrame([(i, "a", *p) for i, p in enumerate(points)], "id long, tipo string, lat double, lon double")
    metres = lambda p, q: 2 * 6_371_000 * math.asin(math.sqrt(math.sin(math.radians(q[0] - p[0]) / 2) ** 2 + math.cos(math.radians(p[0])) * math.cos(math.radians(q[0])) * math.sin(math.radians(q[1] - p[1]) / 2) ** 2))
    root = list(range(180))
    for i in range(180):
        for j in range(i):
            if metres(points[i], points[j]) <= 500 and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    assert {r["id"]: r["cluster"] for r in geo_clusters(df, "id", "tipo", "lat", "lon", 500.0).collect()} == dict(enumerate(root))


def test_cluster_of_a_report_without_place(spark):
    df = spark.createDataFrame([(5, "a", None, None), (6, "a", None, None)], "id long, tipo string, lat double, lon double")
    assert sorted(r["cluster"] for r in geo_clusters(df, "id", "tipo", "lat", "lon", 500.0).collect()) == [5, 6]


def test_upsert_twice_is_once_and_null_keys_are_equal(spark):
    target = spark.createDataFrame([(1, "a"), (None, "b")], "k long, v string")
    source = spark.createDataFrame([(None, "c"), (2, "d")], "k long, v string")
    once = incremental.upsert(target, source, ["k"])
    twice = incremental.upsert(once, source, ["k"])
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, twice.collect()), key=repr)
    assert {(r["k"], r["v"]) for r in once.collect()} == {(1, "a"), (None, "c"), (2, "d")}


def test_retry_ladder(spark):
    base = spark.createDataFrame([(1, ["a", "b"], None), (2, ["c"], None), (3, [], None), (4, None, None)], "id long, others array<string>, fone string")
    failed = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id long")
    rounds = [{r["id"]: r["fone"] for r in campaign.retry_round(base, failed, "id", "others", "fone", i).collect()} for i in (1, 2, 3)]
    assert rounds == [{1: "a", 2: "c"}, {1: "b"}, {}]


def test_suppression_and_its_opposite_split_the_rows(spark):
    df, seen = spark.range(20).toDF("k"), spark.range(5, 12).toDF("k")
    kept, dropped = joins.suppress(df, seen, ["k"]), joins.require_any(df, seen, keys=["k"])
    assert kept.count() + dropped.count() == 20 and kept.join(dropped, "k").count() == 0


def test_anchored_session_is_not_a_gap_session(spark):
    at = [dt.datetime(2024, 1, 1, h) for h in (0, 10, 20)] + [dt.datetime(2024, 1, 2, 0), dt.datetime(2024, 1, 2, 6)]
    df = spark.createDataFrame([(1, t) for t in at], "k long, ts timestamp_ntz")
    got = [r["sessao"] for r in sessions.anchored_sessions(df, "k", "ts", 24).orderBy("ts").collect()]
    assert got == [1, 1, 1, 1, 2]  # exactly 24 h still belongs to the first
    assert sessions.gap_sessions(df, "k", "ts", 36000).select("sessao").distinct().count() == 1


def test_global_rank_counts_every_row_once(spark):
    got = sorted(r["rank"] for r in select.seeded_order(spark.range(500).repartition(7), "id", "x").collect())
    assert got == list(range(1, 501))
    assert select.seeded_order(spark.range(0), "id", "x").count() == 0


def test_escalating_groups_have_their_sizes(spark):
    got = {r["grupo"]: r["count"] for r in select.escalating_groups(spark.range(1, 901).withColumnRenamed("id", "rank")).groupBy("grupo").count().collect()}
    assert got == {1: 200, 2: 300, 3: 400}


def test_phones(spark):
    f = lambda c, x: one(spark, c(F.lit(x)))
    assert f(contact.format_cellphone, "+55 (21) 98888-7777") == "5521988887777"
    assert f(contact.format_cellphone, "2122223333") is None and f(contact.format_phone, "2122223333") == "552122223333"
    assert f(contact.add_ninth_digit, "552188887777") == "5521988887777"
    assert f(contact.both_spellings, "5521988887777") == ["5521988887777", "552188887777"]
    assert one(spark, contact.alternates(F.array(F.lit("a"), F.lit("b")), F.lit(None).cast("string"))) == []


def test_texts(spark):
    f = lambda c, x: one(spark, c(F.lit(x)))
    assert f(text.unaccent, "São João") == "Sao Joao"
    assert f(text.short_name, "ANA MARIA DA SILVA") == "Ana Silva"
    assert f(text.leading_number, "25ºC") == 25 and f(text.leading_number, "NIL") is None
    assert f(text.lines_to_json, "a: 1\nresto\nb: 2") == '{"a":"1 resto","b":"2"}'
    assert f(text.year_suffix, "fluxo_2023") == 2023 and f(text.year_suffix, "fluxo") is None


def test_dates(spark):
    assert one(spark, dates.business_offset(F.lit(dt.date(2024, 1, 4)))) == dt.date(2024, 1, 8)  # Thursday
    assert one(spark, dates.date_from_name(F.lit("CAD.A240115.txt"))) == dt.date(2024, 1, 15)
    assert one(spark, dates.business_days(F.lit(dt.date(2024, 1, 5)), F.lit(dt.date(2024, 1, 8)))) == 2
    assert [shifted_offset(dt.date(2024, 1, 4), n, True) for n in (1, 2, 3, 9)] == [1, 4, 4, 11]


def test_places(spark):
    assert one(spark, geo.area_code(F.lit(-22.9068), F.lit(-43.1729))) == "589R3RVG+7R"
    assert one(spark, geo.area_code(F.lit(95.0), F.lit(0.0))) is None
    lat, lon = geo.utm_to_degrees(F.lit(500000.0), F.lit(10000000.0))
    assert spark.range(1).select(lat, lon).first()[:] == (0.0, -45.0)


def test_error_rate_gate(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 10)
    stats = clean.validate(df, {"v": F.col("v") > 0})[2]
    with pytest.raises(ValueError, match="10 of 100"):
        clean.assert_error_rate(stats)
    clean.assert_error_rate(stats, 0.1)
    with pytest.raises(ValueError, match="missing"):
        clean.validate(df, {}, ["nada"])


def test_windows():
    day = dt.date
    assert io.windows("month", day(2024, 1, 15), day(2024, 2, 1)) == [(day(2024, 1, 1), day(2024, 2, 1)), (day(2024, 2, 1), day(2024, 3, 1))]
    assert io.resolve("previous_month", day(2024, 1, 15)) == day(2023, 12, 1)
    assert io.resolve("current_year", day(2024, 5, 2)) == day(2024, 1, 1)


def test_jdbc_windows_on_derby(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = spark.range(60).select("id", F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("d"))
    rows.coalesce(1).write.jdbc(url, "t", mode="overwrite", properties=driver)
    got = io.read_windowed(spark, url, "SELECT * FROM t", '"d"', "month", "2024-01-01", "2024-02-10", properties=driver)
    assert got.rdd.getNumPartitions() == 2 and got.count() == 60
    assert io.read_windowed(spark, url, "SELECT * FROM t", '"d"', "month", "2024-01-01", "2024-02-10", lower_bound="2024-02-20", properties=driver).count() == 10


def test_a_lower_bound_reads_what_plain_sql_reads(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = spark.range(90).select("id", (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(F.col("id").cast("int"), F.lit(6))).alias("t"))
    rows.coalesce(1).write.jdbc(url, "t", mode="overwrite", properties=driver)
    got = io.read_windowed(spark, url, "SELECT * FROM t", '"t"', "month", "2024-01-01", "2024-03-31", lower_bound="2024-02-20 06:00:00", properties=driver, timed=True)
    plain = spark.read.jdbc(url, """(SELECT * FROM t WHERE "t" >= TIMESTAMP('2024-02-20 06:00:00') AND "t" < TIMESTAMP('2024-04-01 00:00:00')) q""", properties=driver)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect())) and got.count() == 40 and got.rdd.getNumPartitions() == 2
    assert io.read_windowed(spark, url, "SELECT * FROM t", '"t"', "month", "2024-01-01", "2024-01-31", lower_bound="2024-05-01", properties=driver, timed=True).count() == 0


@pytest.mark.parametrize(("url", "day", "time"), [
    ("jdbc:sqlserver://h:1433;databaseName=x", "CONVERT(DATE, '2024-01-01', 23)", "CONVERT(DATETIME2, '2024-01-02 03:04:05', 120)"),
    ("jdbc:oracle:thin:@//h:1521/x", "DATE '2024-01-01'", "TIMESTAMP '2024-01-02 03:04:05'"),
    ("jdbc:mysql://h/x", "DATE '2024-01-01'", "TIMESTAMP '2024-01-02 03:04:05'"),
    ("jdbc:derby:memory:x", "DATE('2024-01-01')", "TIMESTAMP('2024-01-02 03:04:05')"),
])
def test_predicates_in_the_words_of_a_database(url, day, time):
    of = dialects.dialect(url)
    want = f"(c >= {day} AND c < {day.replace('01-01', '02-01')}) AND c >= {time}"
    assert io.predicates("c", "month", "2024-01-01", "2024-01-31", dt.date(2024, 5, 1), of, "2024-01-02 03:04:05") == [want]


def test_literals_take_nothing_but_dates():
    with pytest.raises(ValueError):
        dialects.literal("2024-01-01' OR 1=1 --", "mysql")
    with pytest.raises(ValueError):
        dialects.dialect("jdbc:unknown:x")


def test_bad_partition_dates_fail_or_drop(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01",), ("31/02",)], "d string")
    with pytest.raises(Exception, match="bad partition date"):
        io.write_partitioned(df, f"{tmp_path}/a", "d")
    io.write_partitioned(df, f"{tmp_path}/b", "d", "padded", on_bad_date="drop")
    assert (tmp_path / "b/ano=2024/mes=01/dia=01").exists()


def test_pushdown_reaches_the_scan(spark):
    from urbana.queries.registry import QUERIES

    plan = QUERIES["p05_row_filters"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull" in plan and "l_comment" not in plan


def test_a_random_chain_of_components_settles(spark):
    order = list(range(3000))
    random.Random(1).shuffle(order)
    chain = spark.createDataFrame([(order[i], order[i + 1]) for i in range(2999)] + [(None, 1), (2, None)], "a long, b long")
    assert connected_components(chain).groupBy("component").count().collect() == [(0, 3000)]


@pytest.mark.parametrize("latitude", [-22.9, 67.0])
def test_clusters_against_brute_force(spark, latitude):
    rnd = random.Random(3)
    points = [(i, rnd.choice(["a", "b", None]), latitude + rnd.uniform(-0.06, 0.06), rnd.uniform(-0.06, 0.06) / math.cos(math.radians(latitude))) for i in range(500)]
    near = {i: i for i, *_ in points}
    for i, k, y, x in points:
        for j, k2, y2, x2 in points[:i]:
            h = math.sin(math.radians(y - y2) / 2) ** 2 + math.cos(math.radians(y)) * math.cos(math.radians(y2)) * math.sin(math.radians(x - x2) / 2) ** 2
            if k == k2 and 2 * 6_371_000 * math.asin(math.sqrt(h)) <= 500 and near[i] != near[j]:
                low, high = sorted((near[i], near[j]))
                near = {n: low if c == high else c for n, c in near.items()}
    df = spark.createDataFrame([(*p, "x", 1) for p in points], "id long, tipo string, lat double, lon double, kind string, part int")
    got = geo_clusters(df, "id", "tipo", "lat", "lon", 500.0).collect()
    assert {r["id"]: r["cluster"] for r in got} == near and all((r["kind"], r["part"]) == ("x", 1) for r in got)


def test_deep_folders_keep_their_placemarks(spark):
    mark = "<Placemark><name>p{0}</name><Point><coordinates> {0},1 </coordinates></Point></Placemark>"
    kml = "".join(f"<Folder><name>f{i}</name>{mark.format(i)}" for i in range(6)) + "</Folder>" * 6
    kml = f"<kml><Document><name>d</name>{kml}<Folder><name>g</name>{mark.format(9)}</Folder></Document></kml>"
    got = io.placemarks(spark.createDataFrame([(kml,), (None,)], "k string"), "k").collect()
    assert {(r["folder"], r["name"], r["coordinates"]) for r in got} == {(f"f{i}", f"p{i}", f"{i},1") for i in range(6)} | {("g", "p9", "9,1")}


def test_rows_with_periods_of_many_lengths_are_not_broadcast(spark, tmp_path):
    """Rows are copied for the lengths of their own key's periods only, and are not taken for a small table once they are copied."""
    spark.range(3000).selectExpr("id % 40 AS k", "IF(id % 97 = 0, NULL, id DIV 40 * 7 + id % 5) AS t", "id AS r").write.parquet(f"{tmp_path}/rows")
    spark.range(80).selectExpr("id % 40 AS k", "id DIV 40 * 100 AS a", "id DIV 40 * 100 + (1L << (id % 40 % 10)) - 1 AS b", "id AS p").write.parquet(f"{tmp_path}/periods")
    rows, periods = spark.read.parquet(f"{tmp_path}/rows"), spark.read.parquet(f"{tmp_path}/periods")
    got = joins.valid_at(rows, periods, ["k"], "t", "a", "b")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "__bin" in x]
    spans = periods.collect()
    want = {(r["r"], p["p"]) for r in rows.where("t IS NOT NULL").collect() for p in spans if p["k"] == r["k"] and p["a"] <= r["t"] <= p["b"]}
    assert {(x["r"], x["p"]) for x in got.collect()} == want and got.count() == len(want) > 500


def test_sums_within_periods_make_no_row_for_each_pair(spark):
    """Rows and periods of one key that all meet; equal times, both bounds, nulls, empty and turned periods."""
    rows = spark.createDataFrame([("a", 1, 5), ("a", 1, 7), ("a", 2, None), ("a", 4, -3), ("b", 1, 1), (None, 1, 1), ("a", None, 100)], "k string, t long, v long")
    periods = spark.createDataFrame([("a", 1, 1, "x"), ("a", 2, 3, "y"), ("a", 0, 9, "z"), ("a", 3, 3, "none"), ("a", 4, 1, "turned"), ("a", None, 9, "open"), ("a", 1, 4, "x"), (None, 0, 9, "x"), ("c", 0, 9, "x"), ("b", 1, 1, None)], "k string, a long, b long, p string")
    got = {tuple(r) for r in joins.summed_within(rows, periods, ["k"], "t", "a", "b", ["p"], {"s": F.col("v")}).collect()}
    assert got == {("a", "x", 6, 21), ("a", "y", 1, None), ("a", "z", 4, 9), ("b", None, 1, 1)}
    many = spark.range(4000).selectExpr("id % 2 AS k", "id AS t", "id AS v")
    spans = many.selectExpr("k", "t - t AS a", "t AS b", "t AS p")
    got = joins.summed_within(many, spans, ["k"], "t", "a", "b", ["p"], {"s": F.col("v")})
    for df in (got, QUERIES["j14_events_in_periods"](spark, "/root/testdata/sf0.001")):
        assert not [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x and "__part" not in x]
    assert {(r["k"], r["p"], r["n"], r["s"]) for r in got.collect()} == {(i % 2, i, i // 2 + 1, sum(range(i % 2, i + 1, 2))) for i in range(4000)}
