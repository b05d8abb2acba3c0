"""Queries of the window and per-key operators (W)."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbana.operators import select, sessions
from urbana.queries.base import query


@query("w01_first_by", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1")
def _(t):
    return select.first_by(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("w02_latest_by", "SELECT user_id, event_id, ts, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def _(t):
    return select.latest_by(t.events.select("user_id", "event_id", "ts", "event_type"), ["user_id"], "ts", ["event_id"])


@query("w03_rank", "SELECT l_orderkey, l_partkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_partkey, l_suppkey, l_extendedprice) AS n, rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) AS posto FROM lineitem")
def _(t):
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey").orderBy(F.desc("l_quantity"))
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(F.desc("l_quantity"), "l_partkey", "l_suppkey", "l_extendedprice"))
    return t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", n.cast("long").alias("n"), F.rank().over(w).cast("long").alias("posto"))


@query("w04_nth_alternative", "SELECT l_orderkey, l_partkey AS alternativa FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) = 2")
def _(t):
    arr = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("a"))
    return arr.select("l_orderkey", F.get("a", F.lit(1))["l_partkey"].alias("alternativa")).where("alternativa IS NOT NULL")


@query("w05_seeded_order", "SELECT c_custkey, row_number() OVER (ORDER BY md5(c_custkey || 'semente'), c_custkey) AS rank FROM customer")
def _(t):
    return select.seeded_order(t.customer.select("c_custkey"), "c_custkey", "semente")


@query("w06_escalating_groups", """
SELECT c_custkey, rank, g AS grupo, 100 * (g + 1) AS alvo FROM (SELECT *, CAST(ceil((sqrt(22500 + 200 * rank) - 150) / 100) AS BIGINT) AS g FROM
(SELECT c_custkey, row_number() OVER (ORDER BY md5(c_custkey || 'semente'), c_custkey) AS rank FROM customer))""")
def _(t):
    return select.escalating_groups(select.seeded_order(t.customer.select("c_custkey"), "c_custkey", "semente"))


@query("w07_anchored_sessions", """
WITH RECURSIVE u AS (SELECT DISTINCT user_id, ts FROM events), s AS (SELECT user_id, min(ts) AS inicio, 1 AS sessao FROM u GROUP BY 1
UNION ALL SELECT s.user_id, (SELECT min(u.ts) FROM u WHERE u.user_id = s.user_id AND u.ts > s.inicio + INTERVAL 24 HOUR), s.sessao + 1 FROM s WHERE EXISTS (SELECT 1 FROM u WHERE u.user_id = s.user_id AND u.ts > s.inicio + INTERVAL 24 HOUR)),
w AS (SELECT *, lead(inicio) OVER (PARTITION BY user_id ORDER BY sessao) AS fim FROM s)
SELECT event_id, e.user_id, e.ts, inicio, sessao FROM events e JOIN w ON e.user_id = w.user_id AND e.ts >= inicio AND (fim IS NULL OR e.ts < fim)""")
def _(t):
    return sessions.anchored_sessions(t.events.select("event_id", "user_id", "ts"), "user_id", "ts", 24)


GAP_SQL = """
WITH g AS (SELECT event_id, user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR date_sub('second', lag(ts) OVER w, ts) > 21600 THEN 1 ELSE 0 END AS novo FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, CAST(sum(novo) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sessao FROM g)
SELECT event_id, user_id, ts, sessao, substr(md5(strftime(min(ts) OVER (PARTITION BY user_id, sessao), '%Y-%m-%d %H:%M:%S') || '_' || user_id), 1, 16) AS sessao_id FROM s"""


@query("w08_gap_sessions", GAP_SQL)
def _(t):
    return sessions.gap_sessions(t.events.select("event_id", "user_id", "ts"), "user_id", "ts", 21600, ["event_id"])


@query("w09_since_previous", "SELECT event_id, date_sub('second', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) AS segundos FROM events")
def _(t):
    return sessions.since_previous(t.events.select("event_id", "user_id", "ts"), "user_id", "ts", ["event_id"]).select("event_id", "segundos")


@query("w10_session_counts", f"SELECT user_id, max(sessao) AS sessoes, count(*) AS eventos FROM ({GAP_SQL}) GROUP BY 1")
def _(t):
    s = sessions.gap_sessions(t.events.select("event_id", "user_id", "ts"), "user_id", "ts", 21600, ["event_id"])
    return s.groupBy("user_id").agg(F.max("sessao").alias("sessoes"), F.count(F.lit(1)).alias("eventos"))


@query("w11_lookup_within_key", """
WITH m AS (SELECT conv_id, turn, turn // 2 AS chamada, CASE WHEN role = 'user' THEN substr(text, 1, 8) END AS nome FROM conversations)
SELECT conv_id, turn, chamada, coalesce(nome, max(nome) OVER (PARTITION BY conv_id, chamada)) AS nome FROM m""")
def _(t):
    m = t.conversations.selectExpr("conv_id", "turn", "turn DIV 2 AS chamada", "CASE WHEN role = 'user' THEN substr(text, 1, 8) END AS nome")
    return sessions.lookup_within_key(m, "conv_id", "chamada", "nome")


@query("w12_fold_continuations", """
WITH l AS (SELECT doc_id, i, string_split(text, chr(10))[i] AS linha FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i)),
k AS (SELECT *, CASE WHEN i % 3 = 1 THEN 'k' || i END AS chave FROM l), b AS (SELECT *, count(chave) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS bloco FROM k)
SELECT doc_id, CAST(min(i) AS INTEGER) AS i, max(chave) AS chave, string_agg(linha, ' ' ORDER BY i) AS linha FROM b GROUP BY doc_id, bloco""")
def _(t):
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "linha")).selectExpr("doc_id", "p + 1 AS i", "linha")
    return select.fold_continuations(lines.withColumn("chave", F.when(F.col("i") % 3 == 1, F.concat(F.lit("k"), F.col("i").cast("string")))), ["doc_id"], "i", "chave", "linha")


@query("w13_step_id", "SELECT conv_id, turn, CAST(coalesce(count(*) FILTER (role = 'assistant') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS BIGINT) AS passo FROM conversations")
def _(t):
    return sessions.step_id(t.conversations.select("conv_id", "turn", "role"), "conv_id", "turn", F.col("role") == "assistant").select("conv_id", "turn", "passo")


@query("w14_version_matrix", """
WITH h AS (SELECT DISTINCT p_brand, p_size % 10 AS v, p_type FROM part), g AS (SELECT a.p_brand, a.v, b.p_type FROM (SELECT DISTINCT p_brand, v FROM h) a JOIN (SELECT DISTINCT p_brand, p_type FROM h) b USING (p_brand)),
p AS (SELECT g.*, h.v IS NOT NULL AS presente FROM g LEFT JOIN h ON g.p_brand = h.p_brand AND g.v = h.v AND g.p_type = h.p_type)
SELECT p_brand, v, p_type, presente, coalesce(lag(presente) OVER w, FALSE) AS na_anterior, coalesce(lead(presente) OVER w, FALSE) AS na_seguinte FROM p WINDOW w AS (PARTITION BY p_brand, p_type ORDER BY v)""")
def _(t):
    return select.version_matrix(t.part.select("p_brand", (F.col("p_size") % 10).alias("v"), "p_type"), "p_brand", "v", "p_type")


@query("w14_version_carry", """
WITH h AS (SELECT DISTINCT p_brand, p_size % 10 AS v, p_type FROM part), s AS (SELECT p_brand, v, lag(v) OVER w AS antes, lead(v) OVER w AS depois FROM (SELECT DISTINCT p_brand, v FROM h) WINDOW w AS (PARTITION BY p_brand ORDER BY v)),
n AS (SELECT h.*, antes, depois FROM h JOIN s ON h.p_brand = s.p_brand AND h.v = s.v), o AS (SELECT DISTINCT v AS outra FROM h)
SELECT *, v AS outra, TRUE AS presente FROM h
UNION ALL SELECT p_brand, v, p_type, outra, FALSE FROM n JOIN o ON outra <= antes WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.p_brand = n.p_brand AND h.v = n.antes AND h.p_type = n.p_type)
UNION ALL SELECT p_brand, v, p_type, outra, FALSE FROM n JOIN o ON outra >= depois WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.p_brand = n.p_brand AND h.v = n.depois AND h.p_type = n.p_type)""")
def _(t):
    return select.version_carry(t.part.select("p_brand", (F.col("p_size") % 10).alias("v"), "p_type"), "p_brand", "v", "p_type")


@query("w15_dedupe_equivalents", """
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE WHEN l_suppkey % 3 <> 0 THEN l_suppkey END AS pessoa FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, pessoa FROM x QUALIFY pessoa IS NULL OR row_number() OVER (PARTITION BY l_orderkey, pessoa ORDER BY l_linenumber, l_partkey, l_quantity) = 1""")
def _(t):
    x = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.when(F.col("l_suppkey") % 3 != 0, F.col("l_suppkey")).alias("pessoa"))
    return select.dedupe_equivalents(x, "l_orderkey", "pessoa", ["l_linenumber", "l_partkey", "l_quantity"]).drop("l_quantity")


@query("w16_last_failed", "SELECT o_custkey, o_orderkey FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) WHERE o_orderstatus = 'F'")
def _(t):
    return select.latest_by(t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus"), ["o_custkey"], "o_orderdate", ["o_orderkey"]).where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey")
