"""Queries of the join and set operators (J, U)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from urbana.operators import joins, sets
from urbana.queries.base import query


@query("j01_inner_star", """
SELECT r_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def _(t):
    x = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return x.groupBy("r_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("j02_left_enrichment", "SELECT l_orderkey, l_linenumber, l_partkey, p_brand FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON l_partkey = p_partkey")
def _(t):
    return t.lineitem.join(t.part.where("p_size > 10"), F.col("l_partkey") == F.col("p_partkey"), "left").select("l_orderkey", "l_linenumber", "l_partkey", "p_brand")


@query("j03_suppress", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '1997-06-01')")
def _(t):
    h = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return joins.suppress(t.customer, h, ["c_custkey"], F.col("o_orderdate") >= F.lit(dt.datetime(1997, 6, 1)).cast("timestamp_ntz")).select("c_custkey", "c_name")


@query("j04_double_suppress", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def _(t):
    h = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    x = joins.suppress(t.customer, h, ["c_custkey"], F.col("o_orderstatus") == "P")
    return joins.suppress(x, h, ["c_custkey"], F.col("o_orderpriority") == "1-URGENT").select("c_custkey")


@query("j05_require_any", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type IN ('click', 'view'))")
def _(t):
    e = t.events.withColumnRenamed("user_id", "c_custkey")
    return joins.require_any(t.customer, e.where("event_type = 'click'"), e.where("event_type = 'view'"), keys=["c_custkey"]).select("c_custkey")


@query("j06_membership", "SELECT l_orderkey, l_linenumber, l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 5) AS pequena FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def _(t):
    x = t.lineitem.join(t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey")), ["l_suppkey"], "left_semi")
    return joins.with_exists(x, t.part.where("p_size < 5").select(F.col("p_partkey").alias("l_partkey")), ["l_partkey"], "pequena").select("l_orderkey", "l_linenumber", "pequena")


@query("j07_new_by_key", """
SELECT l_orderkey, l_linenumber FROM lineitem a WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_quantity < 25 AND b.l_orderkey = a.l_orderkey
AND b.l_linenumber = a.l_linenumber AND date_trunc('month', b.l_shipdate) IS NOT DISTINCT FROM date_trunc('month', a.l_shipdate))""")
def _(t):
    keys = {"o": lambda: F.col("l_orderkey"), "n": lambda: F.col("l_linenumber"), "d": lambda: F.date_trunc("month", "l_shipdate")}
    return joins.new_by_key(t.lineitem, t.lineitem.where("l_quantity < 25"), keys).select("l_orderkey", "l_linenumber")


@query("j08_not_done_yet", "SELECT p_partkey FROM part a WHERE NOT EXISTS (SELECT 1 FROM part b WHERE b.p_size < 20 AND lower(b.p_brand) = lower(a.p_brand) AND lower(b.p_type) = lower(a.p_type) AND b.p_size = a.p_size - 20)")
def _(t):
    keys = ["b", "t", "s"]
    done = t.part.where("p_size < 20").select(F.lower("p_brand").alias("b"), F.lower("p_type").alias("t"), F.col("p_size").alias("s"))
    return t.part.select("p_partkey", F.lower("p_brand").alias("b"), F.lower("p_type").alias("t"), (F.col("p_size") - 20).alias("s")).join(done, keys, "left_anti").select("p_partkey")


@query("j09_row_dependent_key", """
SELECT o_orderkey FROM orders WHERE CASE WHEN o_orderstatus = 'F' THEN '1-URGENT' ELSE '5-LOW' END NOT IN
(SELECT o2.o_orderpriority FROM orders o2 WHERE o2.o_custkey = orders.o_custkey AND o2.o_totalprice > 200000)""")
def _(t):
    code = F.when(F.col("o_orderstatus") == "F", "1-URGENT").otherwise("5-LOW")
    big = t.orders.where("o_totalprice > 200000").select("o_custkey", F.col("o_orderpriority").alias("code"))
    return t.orders.withColumn("code", code).join(big, ["o_custkey", "code"], "left_anti").select("o_orderkey")


@query("j10_lookup_many", """
SELECT c_custkey, a.s_name AS k1_s_name, b.s_name AS k2_s_name, c.s_name AS k3_s_name FROM (SELECT c_custkey, c_custkey % 97 AS k1, c_custkey % 53 AS k2, c_custkey + 90 AS k3 FROM customer)
LEFT JOIN supplier a ON a.s_suppkey = k1 LEFT JOIN supplier b ON b.s_suppkey = k2 LEFT JOIN supplier c ON c.s_suppkey = k3""")
def _(t):
    c = t.customer.select("c_custkey", (F.col("c_custkey") % 97).alias("k1"), (F.col("c_custkey") % 53).alias("k2"), (F.col("c_custkey") + 90).alias("k3"))
    return joins.lookup_many(c, "c_custkey", ["k1", "k2", "k3"], t.supplier, "s_suppkey", "s_name").drop("k1", "k2", "k3")


@query("j11_join_fallback", """
WITH e AS (SELECT l_partkey, l_suppkey, max(l_shipdate) AS d FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2), c AS (SELECT l_partkey, max(l_shipdate) AS d FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT x.l_partkey, x.l_suppkey, coalesce(e.d, c.d) AS d, CASE WHEN e.d IS NOT NULL THEN 'exact' WHEN c.d IS NOT NULL THEN 'coarse' ELSE 'none' END AS precision
FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) x LEFT JOIN e USING (l_partkey, l_suppkey) LEFT JOIN c ON c.l_partkey = x.l_partkey""")
def _(t):
    r = t.lineitem.where("l_returnflag = 'R'")
    exact = r.groupBy("l_partkey", "l_suppkey").agg(F.max("l_shipdate").alias("d"))
    coarse = r.groupBy("l_partkey").agg(F.max("l_shipdate").alias("d"))
    return joins.join_fallback(t.lineitem.select("l_partkey", "l_suppkey").distinct(), exact, ["l_partkey", "l_suppkey"], coarse, ["l_partkey"], "d")


@query("j12_share_of_total", "SELECT c_mktsegment, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM customer), 4) AS pct FROM customer GROUP BY 1")
def _(t):
    total = t.customer.agg(F.count(F.lit(1)).alias("all"))
    return t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(total)).select("c_mktsegment", "n", F.round(100.0 * F.col("n") / F.col("all"), 4).alias("pct"))


@query("j13_entity_days", "SELECT s_suppkey, CAST(d AS DATE) AS day FROM supplier, unnest(generate_series(DATE '2024-01-01', DATE '2024-01-01' + CAST(s_suppkey % 10 AS INTEGER), INTERVAL 1 DAY)) AS u(d)")
def _(t):
    start = F.lit(dt.date(2024, 1, 1))
    return joins.entity_days(t.supplier.select("s_suppkey"), start, F.date_add(start, (F.col("s_suppkey") % 10).cast("int")))


@query("j14_valid_at", """
WITH p AS (SELECT o_custkey, min(o_orderdate) + INTERVAL 90 DAY AS inicio, max(o_orderdate) - INTERVAL 90 DAY AS fim FROM orders GROUP BY 1)
SELECT o_orderkey, o_custkey FROM orders JOIN p USING (o_custkey) WHERE o_orderdate BETWEEN inicio AND fim""")
def _(t):
    p = t.orders.groupBy("o_custkey").agg((F.min("o_orderdate") + F.expr("INTERVAL 90 DAY")).alias("inicio"), (F.max("o_orderdate") - F.expr("INTERVAL 90 DAY")).alias("fim"))
    return joins.valid_at(t.orders, p, ["o_custkey"], "o_orderdate", "inicio", "fim").select("o_orderkey", "o_custkey")


@query("j14_events_in_periods", """
WITH p AS (SELECT event_type, event_id AS periodo, ts AS inicio, ts + to_minutes(CAST(event_id % 900 AS INTEGER)) AS fim FROM events WHERE event_id % 5 = 0)
SELECT e.event_type, periodo, count(*) AS n, CAST(sum(e.event_id) AS BIGINT) AS ids FROM events e JOIN p ON e.event_type = p.event_type AND e.ts BETWEEN inicio AND fim GROUP BY ALL""")
def _(t):
    """Events inside periods of minutes to hours that begin at every fifth event of their type: few keys, many rows and periods each."""
    p = t.events.where("event_id % 5 = 0").selectExpr("event_type", "event_id AS periodo", "ts AS inicio", "timestampadd(MINUTE, CAST(event_id % 900 AS INT), ts) AS fim")
    return joins.summed_within(t.events, p, ["event_type"], "ts", "inicio", "fim", ["periodo"], {"ids": F.col("event_id")})


@query("j15_daily_snapshots", """
WITH f AS (SELECT user_id, min(ts) AS added FROM events GROUP BY 1)
SELECT CAST(d AS DATE) AS snapshot, count(*) AS n FROM f, unnest(generate_series(CAST(added AS DATE), DATE '2024-01-31', INTERVAL 1 DAY)) AS u(d) GROUP BY 1""")
def _(t):
    first = t.events.groupBy("user_id").agg(F.min("ts").alias("added"))
    return joins.snapshot_counts(first, "added", F.lit(dt.date(2024, 1, 31)))


@query("j15_snapshot_rows", """
WITH f AS (SELECT user_id, min(ts) AS added FROM events GROUP BY 1)
SELECT user_id, CAST(d AS DATE) AS snapshot FROM f, unnest([DATE '2024-01-01', DATE '2024-01-05', DATE '2024-01-31']) AS u(d) WHERE CAST(added AS DATE) <= d""")
def _(t):
    first = t.events.groupBy("user_id").agg(F.min("ts").alias("added"))
    return joins.daily_snapshots(first, "added", [dt.date(2024, 1, d) for d in (5, 1, 31)]).select("user_id", "snapshot")


@query("j15_open_orders", """
WITH o AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS a, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 50 AS INTEGER) END AS r FROM orders),
d AS (SELECT CAST(d AS DATE) AS snapshot FROM unnest(generate_series(DATE '1995-01-01', DATE '1995-03-31', INTERVAL 1 DAY)) AS u(d)),
c AS (SELECT o_orderpriority, a AS dia, count(*) AS n FROM o WHERE r IS NULL OR r > a GROUP BY ALL UNION ALL SELECT o_orderpriority, r, -count(*) FROM o WHERE r > a GROUP BY ALL)
SELECT o_orderpriority, snapshot, CAST(sum(n) AS BIGINT) AS n FROM c JOIN d ON dia <= snapshot GROUP BY ALL""")
def _(t):
    """Orders open on each day of a quarter, by priority; most are closed up to 49 days later."""
    closed = F.when(F.col("o_orderkey") % 4 != 0, F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 50).cast("int")))
    o = t.orders.select("o_orderpriority", F.to_date("o_orderdate").alias("a"), closed.alias("r"))
    return joins.snapshot_counts(o, "a", F.lit(dt.date(1995, 3, 31)), F.lit(dt.date(1995, 1, 1)), "r", ["o_orderpriority"])


@query("j16_compare_keys", """
WITH a AS (SELECT DISTINCT p_partkey AS k FROM part WHERE p_size < 40), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity > 48)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'right' ELSE 'left' END AS side FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL""")
def _(t):
    return joins.compare_keys(t.part.where("p_size < 40").select(F.col("p_partkey").alias("k")), t.lineitem.where("l_quantity > 48").select(F.col("l_partkey").alias("k")), "k")


@query("j17_exists_flag", "SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS devolvido FROM orders")
def _(t):
    r = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.with_exists(t.orders.select("o_orderkey"), r, ["o_orderkey"], "devolvido")


@query("j18_unnest", "SELECT o_orderkey, l_quantity AS q FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity > 40) ON l_orderkey = o_orderkey")
def _(t):
    nested = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list("l_quantity").alias("qs"))
    x = t.orders.select("o_orderkey").join(nested, "o_orderkey", "left")
    return joins.unnest(x, "qs", "q", "left", lambda q: q > 40)


@query("j19_missing_ids", "SELECT CAST(i AS BIGINT) AS l_orderkey FROM range(1, (SELECT max(l_orderkey) + 1 FROM lineitem)) u(i) WHERE i NOT IN (SELECT l_orderkey FROM lineitem)")
def _(t):
    return joins.missing_ids(t.lineitem.select("l_orderkey"), "l_orderkey")


@query("j20_ancestors", """
WITH h AS (SELECT c_custkey AS id, CASE WHEN c_custkey >= 10 THEN c_custkey // 10 END AS up FROM customer)
SELECT h.id, h.up AS ancestor_1, a.up AS ancestor_2, b.up AS ancestor_3 FROM h LEFT JOIN h a ON h.up = a.id LEFT JOIN h b ON a.up = b.id""")
def _(t):
    h = t.customer.select(F.col("c_custkey").alias("id"), F.expr("CASE WHEN c_custkey >= 10 THEN c_custkey DIV 10 END").alias("up"))
    return joins.with_ancestors(h, "id", "up", 3).drop("up")


@query("j21_unknown_keys", "SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def _(t):
    return joins.unknown_keys(t.events, t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id")), "user_id")


@query("j22_join_deepest", """
SELECT x.p_partkey, n_name FROM (SELECT p_partkey, p_size % 5 AS l0, CASE WHEN p_size % 2 = 0 THEN p_size % 20 ELSE 0 END AS l1, CASE WHEN p_size % 3 = 0 THEN p_size % 25 ELSE 0 END AS l2 FROM part) x
JOIN nation ON n_nationkey = coalesce(nullif(l2, 0), nullif(l1, 0), nullif(l0, 0))""")
def _(t):
    p = t.part.selectExpr("p_partkey", "p_size % 5 AS l0", "CASE WHEN p_size % 2 = 0 THEN p_size % 20 ELSE 0 END AS l1", "CASE WHEN p_size % 3 = 0 THEN p_size % 25 ELSE 0 END AS l2")
    return p.withColumn("n_nationkey", joins.deepest(["l0", "l1", "l2"])).join(t.nation, "n_nationkey").select("p_partkey", "n_name")


@query("j23_star_dimensions", """
SELECT p_brand, n_name, date_trunc('second', max(l_shipdate)) AS ultimo, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2""")
def _(t):
    x = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return x.groupBy("p_brand", "n_name").agg(F.date_trunc("second", F.max("l_shipdate")).cast("timestamp_ntz").alias("ultimo"), F.count(F.lit(1)).alias("n"))


@query("j24_children_apart", """
SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS pedidos, (SELECT count(*) FROM events WHERE user_id = c_custkey) AS eventos FROM customer""")
def _(t):
    from urbana.operators.aggs import count_children

    x = count_children(t.customer.select("c_custkey"), t.orders.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "pedidos")
    return count_children(x, t.events.withColumnRenamed("user_id", "c_custkey"), "c_custkey", "eventos")


@query("u01_union_history", "SELECT o_orderkey AS id, CAST(o_orderdate AS TIMESTAMP) AS quando, 'novo' AS origem FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT l_orderkey, l_shipdate, 'antigo' FROM lineitem WHERE l_quantity > 45")
def _(t):
    new = t.orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("quando"), F.lit("novo").alias("origem"))
    old = t.lineitem.where("l_quantity > 45").select("l_orderkey", "l_shipdate", F.lit("antigo").alias("origem"))
    return sets.union_history(new, old, {"l_orderkey": "id", "l_shipdate": "quando"})


@query("u02_union_distinct", "SELECT o_orderkey AS k FROM orders WHERE o_totalprice > 200000 UNION SELECT l_orderkey FROM lineitem WHERE l_quantity > 48")
def _(t):
    return sets.union_distinct(t.orders.where("o_totalprice > 200000").select(F.col("o_orderkey").alias("k")), t.lineitem.where("l_quantity > 48").select(F.col("l_orderkey").alias("k")))


@query("u03_failed_union", "SELECT user_id FROM events WHERE event_type = 'click' AND value > 90 UNION SELECT user_id FROM events WHERE event_type = 'view' AND value < 5")
def _(t):
    return sets.union_distinct(t.events.where("event_type = 'click' AND value > 90").select("user_id"), t.events.where("event_type = 'view' AND value < 5").select("user_id"))


@query("u04_concat_any", "SELECT c_custkey AS id, c_name AS nome, c_mktsegment AS segmento, NULL AS pais FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier")
def _(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nome"), F.col("c_mktsegment").alias("segmento"))
    return sets.concat_any(a, t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nome"), F.col("s_nationkey").alias("pais")))


@query("u06_merge_sources", """
SELECT k, v, origem FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY p, v) AS rn FROM (
SELECT p_size AS k, p_brand AS v, 'a' AS origem, 0 AS p FROM part WHERE p_size > 30 UNION ALL SELECT p_size, p_type, 'b', 1 FROM part)) WHERE rn = 1""")
def _(t):
    a = t.part.where("p_size > 30").select(F.col("p_size").alias("k"), F.col("p_brand").alias("v"), F.lit("a").alias("origem"))
    return sets.merge_sources([a, t.part.select(F.col("p_size").alias("k"), F.col("p_type").alias("v"), F.lit("b").alias("origem"))], ["k"], ["v"])
