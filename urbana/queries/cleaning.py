"""Queries of the projection, filter and predicate operators (P)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbana.functions import text as tx
from urbana.operators import clean
from urbana.operators.select import dedupe_names
from urbana.plans.render import render
from urbana.queries.base import query


@query("p01_conform", "SELECT CAST(c_custkey AS BIGINT) AS id, c_name AS nome, CAST(NULL AS VARCHAR) AS email, CAST(c_acctbal AS DOUBLE) AS saldo FROM customer")
def _(t):
    schema = T.StructType.fromDDL("id bigint, nome string, email string, saldo double")
    return clean.conform(t.customer, schema, {"c_custkey": "id", "c_name": "nome", "c_acctbal": "saldo"})


@query("p02_sentinel_null", "SELECT o_orderkey, CASE WHEN o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW') THEN o_orderpriority END AS o_orderpriority FROM orders")
def _(t):
    return clean.null_if_in(t.orders.select("o_orderkey", "o_orderpriority"), ["4-NOT SPECIFIED", "5-LOW"], ["o_orderpriority"])


@query("p03_to_number", "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k, try_cast(event_type AS DOUBLE) AS bad FROM events")
def _(t):
    e = t.events.select("event_id", F.get_json_object("props", "$.k").alias("k"), F.col("event_type").alias("bad"))
    return clean.to_number(e, ["k", "bad"])


@query("p04_nonnegative", "SELECT c_custkey, greatest(coalesce(c_acctbal, 0), 0) AS c_acctbal FROM customer")
def _(t):
    return clean.nonnegative(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal"])


@query("p05_row_filters", "SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linestatus = 'F' AND l_quantity > 45")
def _(t):
    return t.lineitem.where(F.col("l_returnflag").isin("A", "R") & (F.col("l_linestatus") == "F") & (F.col("l_quantity") > 45)).select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")


@query("p06_within_limit", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice IS NULL OR l_extendedprice <= 5000")
def _(t):
    return clean.within_limit(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_extendedprice", 5000)


@query("p07_drop_all_null", "SELECT * FROM (SELECT event_id, CASE WHEN event_type = 'click' THEN value END AS a, CASE WHEN value > 50 THEN value END AS b FROM events) WHERE a IS NOT NULL OR b IS NOT NULL")
def _(t):
    e = t.events.select("event_id", F.when(F.col("event_type") == "click", F.col("value")).alias("a"), F.when(F.col("value") > 50, F.col("value")).alias("b"))
    return clean.drop_all_null(e, ["a", "b"])


@query("p08_run_window", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13'")
def _(t):
    return clean.run_window(t.events.select("event_id", "ts"), "ts", dt.date(2024, 1, 10), dt.date(2024, 1, 12))


@query("p09_recent_or_undated", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END AS d, CAST(coalesce(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END, DATE '1998-08-01') AS DATE) AS data_particao
FROM orders WHERE o_orderkey % 7 = 0 OR CAST(o_orderdate AS DATE) >= DATE '1998-08-01' - 365""")
def _(t):
    o = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate")).alias("d"))
    return clean.recent_or_undated(o, "d", 365, dt.date(1998, 8, 1))


@query("p10_recode", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'fechado' WHEN 'O' THEN 'aberto' ELSE 'outro' END AS situacao FROM orders")
def _(t):
    return t.orders.select("o_orderkey", tx.recode(F.col("o_orderstatus"), {"F": "fechado", "O": "aberto"}, "outro").alias("situacao"))


@query("p11_classify_text", "SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)licen[sç]') THEN 'licenca' WHEN regexp_matches(text, '(?i)idiot|moron') THEN 'ofensa' END AS classe FROM documents")
def _(t):
    return t.documents.select("doc_id", tx.classify(F.col("text"), {"licenca": "(?i)licen[sç]", "ofensa": "(?i)idiot|moron"}).alias("classe"))


@query("p12_keyword_alert", "SELECT doc_id FROM documents WHERE contains(lower(trim(text)), 'license') OR contains(lower(trim(text)), 'token')")
def _(t):
    return t.documents.where(tx.matches_any(F.col("text"), ["license", "token"])).select("doc_id")


@query("p13_except_columns", "SELECT * EXCLUDE (c_name, c_mktsegment) FROM customer")
def _(t):
    return t.customer.drop("c_name", "c_mktsegment")


@query("p14_flatten_codes", "SELECT p_partkey, p_brand AS marca_code, p_type AS marca_description, coalesce(CASE WHEN p_size > 25 THEN p_brand END, p_type) AS canal FROM part")
def _(t):
    p = t.part.select("p_partkey", F.struct(F.col("p_brand").alias("code"), F.col("p_type").alias("description")).alias("marca"), F.when(F.col("p_size") > 25, F.struct(F.col("p_brand").alias("n"))).alias("a"), F.struct(F.col("p_type").alias("n")).alias("b"))
    return clean.flatten(p.withColumn("canal", clean.coalesce_structs("a", "b", "n")).drop("a", "b"))


@query("p15_normalize_keys", "SELECT c_custkey, c_name AS nome, c_mktsegment AS segmento FROM customer")
def _(t):
    m = clean.normalize_keys(F.create_map(F.lit("NOME"), F.col("c_name"), F.lit("MktSegment"), F.col("c_mktsegment")), {"mktsegment": "segmento"})
    return t.customer.select("c_custkey", m.alias("m")).select("c_custkey", F.col("m")["nome"].alias("nome"), F.col("m")["segmento"].alias("segmento"))


@query("p16_by_role", "SELECT c_custkey AS chave, c_name AS nome FROM customer")
def _(t):
    return clean.by_role(t.customer, {"chave": ["id", "c_custkey"], "nome": ["nome", "c_name"], "telefone": ["telefone"]})


@query("p17_validate", """
SELECT count(*) AS total, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS invalid, round(count(*) FILTER (ok) / count(*), 6) AS success_rate
FROM (SELECT coalesce(o_totalprice > 1000, FALSE) AND coalesce(o_orderpriority <> '5-LOW', FALSE) AS ok FROM orders)""")
def _(t):
    return clean.validate(t.orders, {"valor": F.col("o_totalprice") > 1000, "prioridade": F.col("o_orderpriority") != "5-LOW"}, ["o_orderkey"])[2]


@query("p17_invalid_rows", "SELECT o_orderkey, CASE WHEN o_totalprice > 1000 THEN '' ELSE 'valor' END || CASE WHEN o_totalprice <= 1000 AND o_orderpriority = '5-LOW' THEN ',' ELSE '' END || CASE WHEN o_orderpriority <> '5-LOW' THEN '' ELSE 'prioridade' END AS erros FROM orders WHERE NOT (o_totalprice > 1000 AND o_orderpriority <> '5-LOW')")
def _(t):
    bad = clean.validate(t.orders, {"valor": F.col("o_totalprice") > 1000, "prioridade": F.col("o_orderpriority") != "5-LOW"})[1]
    return bad.select("o_orderkey", F.array_join("errors", ",").alias("erros"))


@query("p18_error_rate_gate", "SELECT o_orderkey FROM orders WHERE o_totalprice > 0")
def _(t):
    good, _bad, stats = clean.validate(t.orders, {"valor": F.col("o_totalprice") > 0})
    clean.assert_error_rate(stats, 0.05)
    return good.select("o_orderkey")


@query("p19_gate", "SELECT n_nationkey, n_name FROM nation WHERE EXISTS (SELECT 1 FROM region WHERE r_name = 'ASIA')")
def _(t):
    return clean.gated(t.nation.select("n_nationkey", "n_name"), clean.gate(t.region, F.col("r_name") == "ASIA"))


@query("p20_render", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1995-01-01' + INTERVAL 4 DAY GROUP BY 1")
def _(t):
    sql = "SELECT o_orderpriority, count(*) AS n FROM {o} WHERE o_orderdate >= :inicio AND o_orderdate < dateadd(DAY, :dias, :inicio) GROUP BY o_orderpriority"
    params = {"inicio": dt.date(1995, 1, 1), "dias": 2}
    return render(t.spark, sql, params, "skip_weekends", dt.date(2024, 1, 4), o=t.orders)  # Thursday + 2 is Saturday: 4


@query("p21_snake_names", "SELECT c_custkey AS id_do_cliente, c_name AS nome_acao, c_acctbal AS nome_acao_2 FROM customer")
def _(t):
    return clean.snake_names(t.customer.select(F.col("c_custkey").alias("Id do  Cliente"), F.col("c_name").alias("Nome-Ação"), F.col("c_acctbal").alias("nome ação")))


@query("p22_dedupe_names", """
SELECT p_partkey, p_brand, CASE WHEN n = 1 THEN p_type ELSE p_type || '_' || n END AS p_type
FROM (SELECT p_partkey, p_brand, p_type, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS n FROM part)""")
def _(t):
    return dedupe_names(t.part.select("p_partkey", "p_brand", "p_type"), ["p_brand"], "p_type", ["p_partkey"])
