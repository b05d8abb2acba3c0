"""Queries of the aggregations (A) and of sort and limit (T)."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbana.operators import aggs, select
from urbana.queries.base import query


@query("a01_grouped", "SELECT l_orderkey, max(l_quantity) AS maior, min(l_quantity) AS menor, round(sum(l_extendedprice), 2) AS total, count(*) AS n FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.max("l_quantity").alias("maior"), F.min("l_quantity").alias("menor"), F.round(F.sum("l_extendedprice"), 2).alias("total"), F.count(F.lit(1)).alias("n"))


@query("a02_two_steps", "SELECT l_orderkey, round(sum(v), 2) AS total, bool_and(q > 10) AS todas FROM (SELECT l_orderkey, l_partkey, sum(l_extendedprice) AS v, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def _(t):
    per = t.lineitem.groupBy("l_orderkey", "l_partkey").agg(F.sum("l_extendedprice").alias("v"), F.sum("l_quantity").alias("q"))
    return per.groupBy("l_orderkey").agg(F.round(F.sum("v"), 2).alias("total"), F.bool_and(F.col("q") > 10).alias("todas"))


@query("a03_pivot_last", "SELECT user_id, max(ts) FILTER (event_type = 'click') AS ultimo_click, max(ts) FILTER (event_type = 'view') AS ultimo_view, max(ts) FILTER (event_type = 'purchase') AS ultimo_purchase FROM events GROUP BY 1")
def _(t):
    return aggs.pivot_last(t.events, ["user_id"], "event_type", "ts", ["click", "view", "purchase"])


@query("a04_distinct", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def _(t):
    return t.orders.select("o_custkey", "o_orderstatus").distinct()


@query("a05_count_distinct", "SELECT event_type, count(DISTINCT user_id) AS pessoas, count(DISTINCT CASE WHEN value > 50 THEN user_id END) AS altas FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("pessoas"), F.count_distinct(F.when(F.col("value") > 50, F.col("user_id"))).alias("altas"))


@query("a06_conditional_count", "SELECT l_orderkey, count(CASE WHEN l_returnflag = 'R' OR l_returnflag IS NULL THEN 1 END) AS devolvidas FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.count_if((F.col("l_returnflag") == "R") | F.col("l_returnflag").isNull()).alias("devolvidas"))


@query("a07_furthest_status", "SELECT o_custkey, CASE max(CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 WHEN 'F' THEN 2 END) WHEN 0 THEN 'O' WHEN 1 THEN 'P' WHEN 2 THEN 'F' END AS furthest FROM orders GROUP BY 1")
def _(t):
    return aggs.furthest_status(t.orders, ["o_custkey"], "o_orderstatus", ["O", "P", "F"])


@query("a08_funnel", """
SELECT event_type, count(DISTINCT user_id) AS pessoas, count(*) AS mensagens, round(100.0 * count(DISTINCT user_id) / (SELECT count(DISTINCT user_id) FROM events), 2) AS percentual,
CAST(list_position(['view', 'click', 'purchase'], event_type) AS BIGINT) AS ordem FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1""")
def _(t):
    return aggs.funnel(t.events, "event_type", "user_id", ["view", "click", "purchase"])


@query("a09_period_stats", "SELECT CAST(date_trunc('week', ts) AS DATE) AS periodo, count(DISTINCT event_id) AS sessoes, count(DISTINCT user_id) AS pessoas, count(*) AS linhas FROM events GROUP BY 1")
def _(t):
    return aggs.period_stats(t.events, "ts", "week", "event_id", "user_id")


@query("a10_summarize_group", """
SELECT user_id, string_agg(event_id, ',' ORDER BY ts, event_id) AS ids, string_agg(n || '. ' || event_type, chr(10) ORDER BY ts, event_id) AS descricoes, min(ts) AS mais_antigo,
round(avg(value), 6) AS lat, round(avg(-value), 6) AS lon, max(value) AS severidade, count(*) AS n
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) GROUP BY 1""")
def _(t):
    e = t.events.withColumn("neg", -F.col("value"))
    return aggs.summarize_group(e, ["user_id"], "ts", "event_id", "event_type", F.col("value"), "value", "neg").withColumn("ids", F.array_join("ids", ","))


@query("a10_summarize_first", """
SELECT user_id, string_agg(event_id, ',' ORDER BY ts, event_id) FILTER (r <= 20) AS ids, string_agg(r || '. ' || event_type, chr(10) ORDER BY ts, event_id) FILTER (r <= 20) || CASE WHEN count(*) > 20 THEN chr(10) || '+' || (count(*) - 20) || ' more' ELSE '' END AS descricoes,
min(ts) AS mais_antigo, round(avg(value), 6) AS lat, round(avg(-value), 6) AS lon, max(value) AS severidade, count(*) AS n
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) GROUP BY 1""")
def _(t):
    e = t.events.withColumn("neg", -F.col("value"))
    return aggs.summarize_group(e, ["user_id"], "ts", "event_id", "event_type", F.col("value"), "value", "neg", most=20).withColumn("ids", F.array_join("ids", ","))


@query("a12_bulletin_first", """
SELECT dia, string_agg(linha, chr(10) ORDER BY ts, event_id) FILTER (r <= 50) || CASE WHEN count(*) > 50 THEN chr(10) || '+' || (count(*) - 50) || ' more' ELSE '' END AS boletim
FROM (SELECT CAST(ts AS DATE) AS dia, ts, event_id, event_type || ' ' || event_id AS linha, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS r FROM events) GROUP BY 1""")
def _(t):
    e = t.events.withColumn("linha", F.concat_ws(" ", "event_type", F.col("event_id").cast("string")))
    return aggs.bulletin(e, F.to_date("ts"), ["ts", "event_id"], "linha", most=50)


@query("a11_join_capped", """
SELECT user_id, array_to_string(list_transform(a[1:5], lambda x: x[1:3]), '; ') || CASE WHEN len(a) > 5 THEN ' +' || (len(a) - 5) || ' more' ELSE '' END AS resumo
FROM (SELECT user_id, list(event_type ORDER BY ts, event_id) AS a FROM events GROUP BY 1)""")
def _(t):
    g = aggs.first_items(t.events, ["user_id"], ["ts", "event_id"], ["event_type"], 5)
    return g.select("user_id", aggs.join_capped(F.transform("itens", lambda x: x["event_type"]), 5, 3, total=F.col("n")).alias("resumo"))


@query("a12_bulletin", "SELECT CAST(ts AS DATE) AS dia, string_agg(event_type || ' ' || event_id, chr(10) ORDER BY ts, event_id) AS boletim FROM events GROUP BY 1")
def _(t):
    e = t.events.withColumn("linha", F.concat_ws(" ", "event_type", F.col("event_id").cast("string")))
    return aggs.bulletin(e, F.to_date("ts"), ["ts", "event_id"], "linha")


@query("a13_latest_child", "SELECT l_orderkey, max(l_linenumber) AS linha, arg_max(l_partkey, (l_linenumber, l_partkey)) AS parte FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("linha"), F.max_by("l_partkey", F.struct("l_linenumber", "l_partkey")).alias("parte"))


@query("a14_count_children", "SELECT o_orderkey, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS fotos FROM orders")
def _(t):
    return aggs.count_children(t.orders.select("o_orderkey"), t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "fotos")


@query("a15_usage_stats", """
SELECT conv_id, CAST(sum(CASE WHEN turn % 3 = 0 THEN length(role) + length(text) ELSE length(text) END) AS BIGINT) AS tokens, count(DISTINCT turn) AS passos, array_to_string(list_sort(list(DISTINCT role)), ',') AS modelos
FROM conversations GROUP BY 1""")
def _(t):
    c = t.conversations.selectExpr("conv_id", "turn", "role", "CASE WHEN turn % 3 = 0 THEN 0 ELSE length(text) END AS total", "length(role) AS a", "length(text) AS b")
    return aggs.usage_stats(c, "conv_id", "total", ["a", "b"], "turn", "role")


@query("a16_nest", """SELECT l_orderkey, '[' || string_agg('{"l_linenumber":' || l_linenumber || ',"l_partkey":' || l_partkey || '}', ',' ORDER BY l_linenumber, l_partkey) || ']' AS itens FROM lineitem GROUP BY 1""")
def _(t):
    return aggs.nest(t.lineitem, ["l_orderkey"], ["l_linenumber", "l_partkey"]).select("l_orderkey", F.to_json("items").alias("itens"))


@query("a16_nest_by_key", """
SELECT l_orderkey, '{' || string_agg('"' || l_linenumber || '":{"l_partkey":' || p || ',"l_suppkey":' || s || '}', ',' ORDER BY l_linenumber) || '}' AS itens
FROM (SELECT l_orderkey, l_linenumber, l_partkey AS p, l_suppkey AS s FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey DESC) = 1) GROUP BY 1""")
def _(t):
    return aggs.nest_by(t.lineitem, ["l_orderkey"], "l_linenumber", ["l_partkey", "l_suppkey"]).select("l_orderkey", F.to_json("items").alias("itens"))


@query("a17_run_stats", "SELECT count(*) AS linhas, count(DISTINCT l_orderkey) AS chaves, count(*) FILTER (l_orderkey IS NULL) AS nulos FROM lineitem")
def _(t):
    return aggs.run_stats(t.lineitem, "l_orderkey")


@query("t01_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


@query("t02_stable_sort", "SELECT event_id, ts FROM events ORDER BY ts, event_id")
def _(t):
    return t.events.select("event_id", "ts").orderBy("ts", "event_id")


@query("t03_hash_batches")
def _(t):
    return t.customer.select("c_custkey", select.hash_batch(F.col("c_custkey"), 8).alias("lote"))


@query("t04_seeded_sample", "SELECT c_custkey FROM customer WHERE CAST('0x' || substr(md5(c_custkey || 's1'), 1, 8) AS BIGINT) < CAST(floor(0.25 * 4294967296) AS BIGINT)")
def _(t):
    return select.seeded_sample(t.customer, "c_custkey", 25, "s1").select("c_custkey")


@query("t05_batches", "SELECT o_orderkey, o_orderpriority, CAST(ceil(rn / 100.0) AS BIGINT) AS lote, 'L' || CAST(ceil(rn / 100.0) AS BIGINT) AS rotulo FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM orders)")
def _(t):
    return select.batches(t.orders.select("o_orderkey", "o_orderpriority"), ["o_orderpriority"], ["o_orderkey"], 100, "L")
