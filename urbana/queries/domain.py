"""Queries of the domain operators (G)."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbana.functions.contact import first_valid
from urbana.functions.text import address_key, short_name
from urbana.operators import campaign, forecast, geo, joins, messages
from urbana.operators.aggs import summarize_group
from urbana.operators.select import dedupe_equivalents, escalating_groups, latest_by, seeded_order
from urbana.queries.base import query
from urbana.session import cut, discard, scratch_path, shuffles_removed

NOW = dt.datetime(2024, 1, 20, 12, 0, 0)


def _points(t):
    """Customers as reports on a grid of about 250 m, some on the same spot."""
    k = F.col("c_custkey")
    return t.customer.select(k.alias("id"), F.col("c_mktsegment").alias("tipo"), F.round(F.lit(-22.9) - (k * 37 % 61) * 0.0023, 6).alias("lat"), F.round(F.lit(-43.2) - (k * 53 % 67) * 0.0023, 6).alias("lon"))


POINTS = "(SELECT c_custkey AS id, c_mktsegment AS tipo, CAST(round(-22.9 - (c_custkey * 37 % 61) * 0.0023, 6) AS DOUBLE) AS lat, CAST(round(-43.2 - (c_custkey * 53 % 67) * 0.0023, 6) AS DOUBLE) AS lon FROM customer)"
CLUSTERS = f"""
WITH RECURSIVE p AS (SELECT * FROM {POINTS}), e AS (SELECT a.id AS x, b.id AS y FROM p a JOIN p b ON a.tipo = b.tipo AND 2 * 6371000 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))) <= 500),
r(x, y) AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT id, tipo, lat, lon, (SELECT min(y) FROM r WHERE r.x = p.id) AS "cluster" FROM p"""


@query("g01_geo_clusters", CLUSTERS)
def _(t):
    return geo.geo_clusters(_points(t), "id", "tipo", "lat", "lon", 500.0)


@query("g02_emit_decision", """
SELECT user_id, n, mais_antigo, CASE WHEN n >= 60 THEN 'count' WHEN date_sub('minute', mais_antigo, TIMESTAMP '2024-01-03 00:00:00') >= 1440 THEN 'age' ELSE 'wait' END AS motivo,
NOT (n < 60 AND date_sub('minute', mais_antigo, TIMESTAMP '2024-01-03 00:00:00') < 1440) AS enviar FROM (SELECT user_id, count(*) AS n, min(ts) AS mais_antigo FROM events GROUP BY 1)""")
def _(t):
    g = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("mais_antigo"))
    return geo.emit_decision(g, F.lit(dt.datetime(2024, 1, 3)).cast("timestamp_ntz"), 60, 1440)


@query("g03_pending_alerts", "SELECT count(*) AS total, count(*) FILTER (value > 20 AND ts >= TIMESTAMP '2024-01-10' AND event_type IN ('click', 'view')) AS elegiveis FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE event_id % 3 = 0)")
def _(t):
    ok = (F.col("value") > 20) & (F.col("ts") >= "2024-01-10") & F.col("event_type").isin("click", "view")
    return campaign.pending(t.events, t.events.where("event_id % 3 = 0"), "event_id", ok)


@query("g04_throttle", """
SELECT count(*) FILTER (md5(event_type) = md5('nada')) AS iguais, count(*) AS hoje, max(ts) AS ultimo, CASE WHEN count(*) FILTER (md5(event_type) = md5('nada')) > 0 THEN 'duplicate' WHEN count(*) >= 100000000 THEN 'cap'
WHEN date_sub('minute', max(ts), TIMESTAMP '2024-01-20 23:59:59') < 120 THEN 'gap' ELSE 'send' END AS decisao FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-20'""")
def _(t):
    log = t.events.withColumn("h", F.md5("event_type"))
    now = F.lit(dt.datetime(2024, 1, 20, 23, 59, 59)).cast("timestamp_ntz")
    return campaign.throttle(log, "h", "ts", F.md5(F.lit("nada")), now, 100_000_000, 120)


@query("g05_forecast_tables", """
WITH o AS (SELECT o_orderkey AS k, o_orderpriority AS p, o_orderdate AS d FROM orders), l AS (SELECT *, lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS n FROM lineitem JOIN o ON k = l_orderkey), r AS (
SELECT k, 'sinotico' AS tabela, p AS chave, NULL AS valor, NULL AS quando, d, p FROM o WHERE k IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT k, 'periodo', n, l_returnflag, CAST(l_shipdate AS DATE), d, p FROM l
UNION ALL SELECT k, 'zona', n, CAST(CAST(l_partkey + 0.5 AS DOUBLE) AS VARCHAR), CAST(d AS DATE), d, p FROM l
UNION ALL SELECT k, 'mare', l_linestatus, CAST(CAST(l_linenumber + 0.5 AS DOUBLE) AS VARCHAR), CASE l_linenumber % 4 WHEN 3 THEN NULL ELSE CAST(l_shipdate AS DATE) END, d, p FROM l)
SELECT tabela, md5(CAST(strftime(d, '%Y-%m-%dT%H:%M:%S') || '|' || p AS VARCHAR)) AS id_execucao, chave, valor, CAST(quando AS VARCHAR) AS quando, count(*) AS n FROM r GROUP BY ALL""")
def _(t):
    """A forecast document made of each order and its lines, written as lines of XML and read back as four tables.

    The XML is compressed and goes once it is parsed; the shuffle takes the lines' values, not their elements. Tables are counted one after
    the other, so that one shuffle's files are there at a time, and by the bytes of the ids instead of their digits.
    """
    at = scratch_path(t.spark, "forecast")

    def opened(tag: str, **attributes) -> Column:
        """The beginning of an element; an attribute without a value is left out."""
        return F.concat(F.lit(f"<{tag}"), *[F.coalesce(F.concat(F.lit(f' {a}="'), v, F.lit('"')), F.lit("")) for a, v in attributes.items()])

    def elements(tag: str, attributes: Callable[[Column], dict[str, Column]]) -> Column:
        return F.array_join(F.transform("lines", lambda x: F.concat(opened(tag, **attributes(x)), F.lit("/>"))), "")

    def day(x: Column) -> Column:
        return F.date_format(x.l_shipdate, "yyyy-MM-dd")

    def n(x: Column) -> Column:
        return F.lpad(x.l_linenumber.cast("string"), 2, "0")

    def form(x: Column) -> Column:
        kind = x.l_linenumber % 4
        return F.when(kind == 0, F.concat(day(x), F.lit("T00:00:00"))).when(kind == 1, F.concat(day(x), F.lit(" 00:00:00"))).when(kind == 2, F.date_format(x.l_shipdate, "dd/MM/yyyy 00:00:00")).otherwise("logo")

    half = F.lit(".5")
    previsao = elements("previsao", lambda x: {"datePeriodo": day(x), "periodo": n(x), "ceu": x.l_returnflag})
    zona = elements("Zona", lambda x: {"zona": n(x), "maxima": F.concat(x.l_partkey.cast("string"), half)})
    mare = elements("tabua", lambda x: {"elevacao": x.l_linestatus, "date": form(x), "altura": F.concat(x.l_linenumber.cast("string"), half)})
    line = F.struct("l_linenumber", F.to_date("l_shipdate").alias("l_shipdate"), "l_returnflag", "l_partkey", "l_linestatus")
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(line).alias("lines"))
    head = F.concat(opened("previsoes", Createdate=F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")), F.lit(">"), opened("quadroSinotico", sinotico=F.col("o_orderpriority")), F.lit("/>"))
    made = t.orders.join(lines, "o_orderkey").select(F.concat(head, previsao, F.lit("<Temperatura>"), zona, F.lit("</Temperatura><TabuasMares>"), mare, F.lit("</TabuasMares></previsoes>")))
    with shuffles_removed(t.spark):
        made.write.text(at, compression="gzip")
    docs = t.spark.read.text(at).select(F.from_xml("value", forecast.DOCUMENT).alias("d")).select("d.*")  # a file of many roots is no XML file
    tables = forecast.forecast_tables(docs, NOW, F.md5(F.concat("_Createdate", F.lit("|"), "quadroSinotico._sinotico")))
    discard(t.spark, at)  # the parsed documents are stored
    shown = {"sinotico": ("sinotico", None, None), "periodo": ("periodo", "ceu", "data_periodo"), "zona": ("zona", "temp_maxima", "data_temperatura"), "mare": ("elevacao", "altura", "to_date(data_hora)")}
    keys = ["id", "chave", "valor", "quando"]
    each = []
    for k, (chave, valor, quando) in shown.items():
        rows = tables[k].selectExpr("unhex(id_execucao) AS id", f"CAST({chave} AS STRING) AS chave", f"CAST({valor or 'NULL'} AS STRING) AS valor", f"{quando or 'CAST(NULL AS DATE)'} AS quando")
        counted = cut(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
        each.append(counted.selectExpr(f"'{k}' AS tabela", "lower(hex(id)) AS id_execucao", "chave", "valor", "CAST(quando AS STRING) AS quando", "n"))
    return functools.reduce(DataFrame.unionAll, each)


@query("g06_split_feed", "SELECT event_id, 'chuva' AS feed, value FROM events WHERE value IS NOT NULL UNION ALL SELECT event_id, 'rio', try_cast(json_extract_string(props, '$.k') AS DOUBLE) FROM events WHERE try_cast(json_extract_string(props, '$.k') AS DOUBLE) IS NOT NULL")
def _(t):
    level = F.get_json_object("props", "$.k").try_cast("double")
    return t.events.select("event_id", F.inline(F.array(F.struct(F.lit("chuva").alias("feed"), F.col("value").alias("value")), F.struct(F.lit("rio").alias("feed"), level.alias("value"))))).where("value IS NOT NULL")


@query("g07_campaign_audience", """
WITH gasto AS (SELECT o_custkey, round(sum(v), 2) AS total, max(d) AS ultimo FROM (SELECT o_custkey, o_orderkey, sum(l_extendedprice) AS v, max(o_orderdate) AS d FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2) GROUP BY 1),
alvo AS (SELECT c_custkey, c_name, total, ultimo FROM customer JOIN gasto ON o_custkey = c_custkey WHERE c_acctbal > 0 AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '1998-05-01')),
r AS (SELECT *, row_number() OVER (ORDER BY md5(c_custkey || 'iptu'), c_custkey) AS rank FROM alvo)
SELECT c_custkey, upper(c_name[1]) || lower(c_name[2:]) AS nome, '55219' || lpad(CAST(c_custkey AS VARCHAR), 8, '8') AS fone, total, ultimo, rank, CAST(ceil((sqrt(22500 + 200 * rank) - 150) / 100) AS BIGINT) AS grupo FROM r ORDER BY rank LIMIT 300""")
def _(t):
    """Suppress recent buyers, add spending, choose a phone, deal experiment groups, take the first 300 (the campaign's size)."""
    recent = t.orders.where("o_orderdate >= '1998-05-01'").withColumnRenamed("o_custkey", "c_custkey")
    per_order = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey", "o_orderkey").agg(F.sum("l_extendedprice").alias("v"), F.max("o_orderdate").alias("d"))
    spent = per_order.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.round(F.sum("v"), 2).alias("total"), F.max("d").alias("ultimo"))
    people = joins.suppress(t.customer.where("c_acctbal > 0"), recent, ["c_custkey"]).join(spent, "c_custkey")
    phone = first_valid(F.lit("x"), F.concat(F.lit("219"), F.lpad(F.col("c_custkey").cast("string"), 8, "8")))
    named = people.select("c_custkey", short_name(F.col("c_name")).alias("nome"), phone.alias("fone"), "total", "ultimo")
    return escalating_groups(seeded_order(named, "c_custkey", "iptu")).drop("alvo").orderBy("rank").limit(300)


def _debtors(t):
    """Customers with their orders as slips, the lines of these as instalments, and their orders as certificates of debt, all nested."""
    due = F.date_add(F.last_day(F.to_date("l_shipdate")), 1)
    quota = F.struct(
        F.col("l_linenumber").alias("n"), due.alias("vencimento"), F.col("l_extendedprice").alias("valor"), (F.col("l_returnflag") == "R").alias("paga"),
        F.when(F.col("l_quantity") == 1, "Encaminhada para Protesto").otherwise("").alias("observacoes"),
        F.when(F.col("l_partkey") % 10 != 0, F.concat(F.lit("b"), F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))).alias("barras"), F.concat(F.lit("p"), F.col("l_suppkey").cast("string")).alias("pix"),
    )
    quotas = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(quota)).alias("cotas"))
    o = t.orders.join(quotas, "o_orderkey", "left").withColumn("dia", F.to_date("o_orderdate"))
    slip = F.struct(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 50 != 0, F.col("dia")).alias("criacao"), "cotas")
    states = F.when(F.col("o_orderstatus") == "F", "Paga").when(F.col("o_orderkey") % 3 == 0, "Cobrança").otherwise("Inscrita")
    debt = F.struct(F.col("o_orderkey").alias("id"), F.col("dia").alias("geracao"), states.alias("situacao"), (F.floor("o_totalprice") / 100).cast("decimal(12,2)").alias("saldo"))
    late = F.sum(F.when(F.col("o_orderkey") % 5 == 0, 1).otherwise(0))
    return o.groupBy(F.col("o_custkey").cast("string").alias("cpf")).agg(F.array_sort(F.collect_list(slip)).alias("guias"), F.array_sort(F.collect_list(debt)).alias("cdas"), F.when(late > 3, late).when(late < 2, 0).alias("vencidas"))


def _registry(t):
    phone = F.struct(F.struct((F.col("c_custkey") % 13 == 0).alias("indicador_optout"), F.when(F.col("c_custkey") % 17 != 1, F.col("c_custkey") % 19 == 0).alias("indicador_quarentena")).alias("principal"))
    return t.customer.select(F.col("c_custkey").cast("string").alias("cpf"), F.when(F.col("c_custkey") % 4 == 0, "").when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("ana "), "c_name")).alias("nome_social"), F.col("c_name").alias("nome"), phone.alias("telefone_rmi"))


_STATE = "CASE WHEN o_orderstatus = 'F' THEN 'Paga' WHEN o_orderkey % 3 = 0 THEN 'Cobrança' ELSE 'Inscrita' END"


@query("g07_due_reminders", f"""
WITH envios AS (SELECT o_custkey AS k, 'f' || (o_custkey % 1000) AS telefone, max(CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) END) AS cobranca FROM orders WHERE o_orderkey % 7 <> 3 AND (o_orderkey % 11 <> 5 OR o_orderdate >= TIMESTAMP '1995-01-01') GROUP BY ALL),
cotas AS (SELECT o_custkey AS k, o_orderkey AS guia, CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_orderdate AS DATE) END AS criacao, CAST(last_day(l_shipdate) + INTERVAL 1 DAY AS DATE) AS vencimento, l_extendedprice AS valor, l_linenumber,
    CASE WHEN l_partkey % 10 <> 0 THEN 'b' || l_partkey || '-' || l_linenumber END AS barras, 'p' || l_suppkey AS pix FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R' AND l_quantity <> 1),
tudo AS (SELECT e.*, c.* EXCLUDE (k), d.o_orderkey AS cda FROM envios e JOIN cotas c USING (k) JOIN orders d ON d.o_custkey = k AND {_STATE.replace('o_order', 'd.o_order')} <> 'Paga' WHERE (criacao IS NULL OR criacao >= cobranca) AND barras IS NOT NULL),
postas AS (SELECT *, row_number() OVER (PARTITION BY k, telefone, cda ORDER BY criacao DESC NULLS LAST, vencimento, guia, valor, barras, pix) AS rn FROM tudo)
SELECT DISTINCT telefone, CAST(k AS VARCHAR) AS SubscriberKey, CASE k % 4 WHEN 1 THEN 'Ana ' ELSE '' END || upper(c_name[1]) || lower(c_name[2:]) AS nome_sobrenome, vencimento AS data_vencimento, guia AS numero_guia, 'R$ ' || replace(printf('%.2f', valor), '.', ',') AS valor_guia, barras AS cod_boleto, pix AS cod_pix
FROM postas JOIN customer ON c_custkey = k WHERE rn = 1 AND vencimento = DATE '1998-08-01' AND k % 13 <> 0 AND k % 17 <> 1 AND k % 19 <> 0""")
def _(t):
    """People reached by a charge, whose next open instalment falls due in two days; two histories of sends, nested debts, consent."""
    o = t.orders.where("o_orderkey % 7 <> 3").selectExpr("CAST(o_custkey AS STRING) AS cpf", "concat('f', o_custkey % 1000) AS telefone", "CASE WHEN o_orderkey % 2 = 0 THEN 'cobranca' ELSE 'lembrete' END AS modelo", "to_date(o_orderdate) AS data", "o_orderkey % 11 = 5 AS ruim")
    sends = o.where("data >= '1995-01-01'").select("cpf", "telefone", "modelo", "data", F.lit(False).alias("indicador_quarentena"))
    legacy = o.where("data < '1995-01-01'").select("cpf", "telefone", "modelo", "data", F.when(F.col("ruim"), F.col("data")).alias("data_falha"))
    reached = campaign.charged(sends, legacy, "cobranca", "lembrete")
    return campaign.due_reminders(_debtors(t), reached, _registry(t), dt.date(1998, 7, 30), 2, "Encaminhada para Protesto", ["Paga", "Parcelamento Irregular"])


@query("g07_debt_charges", f"""
WITH dividas AS (SELECT o_custkey AS k, count(*) FILTER (s <> 'Paga') AS n, sum(saldo) FILTER (s <> 'Paga') AS soma, max(dia) FILTER (s <> 'Paga') AS ultima, sum(CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END) AS atraso
    FROM (SELECT *, {_STATE} AS s, CAST(floor(o_totalprice) / 100 AS DECIMAL(12,2)) AS saldo, CAST(o_orderdate AS DATE) AS dia FROM orders) GROUP BY 1),
alvo AS (SELECT c_custkey AS k, c_name, CAST(1998 - (1930 + c_custkey % 60) AS INTEGER) AS idade, n, soma, ultima FROM customer JOIN dividas ON k = c_custkey
    WHERE c_custkey % 5 <> 4 AND (atraso > 3 OR atraso BETWEEN 2 AND 3) AND n > 0 AND 1998 - (1930 + c_custkey % 60) <= 60 AND soma <= 6000 AND ultima >= DATE '1996-01-30' AND c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 95)),
r AS (SELECT *, row_number() OVER (ORDER BY md5(k || 'divida'), CAST(k AS VARCHAR)) AS o FROM alvo)
SELECT CAST(k AS VARCHAR) AS cpf, 'f' || (k % 1000) AS telefone, upper(c_name[1]) || lower(c_name[2:]) AS nome_sobrenome, idade, n AS n_cdas_ativas, CAST(soma AS DOUBLE) AS soma_divida_total, ultima AS dt_ultima_cda, o AS ordem_sorteio,
CAST(ceil((sqrt(22500 + 200 * o) - 150) / 100) AS BIGINT) AS grupo_escalonado, 100 * (CAST(ceil((sqrt(22500 + 200 * o) - 150) / 100) AS BIGINT) + 1) AS tamanho_alvo_grupo FROM r ORDER BY o LIMIT 300""")
def _(t):
    """People who owe little, pay nothing now and were not charged lately, in a seeded order; the campaign takes the first 300."""
    ways = F.when(F.col("c_custkey") % 5 == 4, "NÃO ENVIAR").when(F.col("c_custkey") % 5 == 0, "TESTAR").otherwise("ENVIAR")
    born = F.make_date((1930 + F.col("c_custkey") % 60).cast("int"), F.lit(6), F.lit(15))
    people = t.customer.select(F.col("c_custkey").cast("string").alias("cpf"), F.col("c_name").alias("nome"), born.alias("nascimento"), F.concat(F.lit("f"), (F.col("c_custkey") % 1000).cast("string")).alias("telefone"), ways.alias("estrategia"))
    sent = t.events.where("event_type = 'purchase' AND value > 95").select(F.col("user_id").cast("string").alias("cpf"))
    return campaign.debt_charges(_debtors(t), people, sent, dt.date(1998, 7, 30), ["Inscrita", "Cobrança"], 6000, 60, 30, "divida", 300)


_DISPATCH = """
b AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE CAST(c_custkey % 700 AS VARCHAR) END AS fone FROM customer),
p AS (SELECT * FROM b WHERE trim(fone) <> '' AND fone NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier) AND fone NOT IN (SELECT CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'purchase'))"""


def _people(t):
    return t.customer.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 11 == 0, "").otherwise((F.col("c_custkey") % 700).cast("string")).alias("fone"))


@query("g08_prepare_dispatch", f"WITH {_DISPATCH} SELECT id, fone FROM p QUALIFY row_number() OVER (PARTITION BY fone ORDER BY id) = 1")
def _(t):
    failed = t.supplier.select(F.col("s_suppkey").cast("string").alias("fone"))
    sent = t.events.where("event_type = 'purchase'").select(F.col("user_id").cast("string").alias("fone"))
    return campaign.prepare_dispatch(_people(t), "id", "fone", [F.col("id")], failed, sent)


@query("g09_retry_round", """
WITH b AS (SELECT o_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS outros FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
SELECT o_orderkey, outros[2] AS fone FROM b WHERE o_orderkey % 3 = 0 AND outros[2] IS NOT NULL""")
def _(t):
    b = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("outros"))
    base = b.join(t.orders.select("o_orderkey"), "o_orderkey").withColumn("fone", F.lit(None).cast("long"))
    return campaign.retry_round(base, t.orders.where("o_orderkey % 3 = 0"), "o_orderkey", "outros", "fone", 2).select("o_orderkey", "fone")


@query("g10_failed_phones", "SELECT user_id FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) WHERE value < 30 UNION SELECT user_id FROM events WHERE value > 99")
def _(t):
    e = t.events.select("user_id", "event_id", "ts", "value")
    return campaign.failed_phones(e, "user_id", "ts", F.col("value") < 30, e.where("value > 99"), ["event_id"])


@query("g11_reachable", """
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM (SELECT user_id, max(value) AS m, bool_or(value < 1) AS q FROM events GROUP BY 1) WHERE m < 99 OR q)""")
def _(t):
    phones = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.when(F.max("value") < 99, "RUIM").otherwise("BOA").alias("q"), F.collect_list(F.struct((F.col("value") < 1).alias("indicador_quarentena"))).alias("c"))
    return campaign.reachable(t.customer.select("c_custkey"), phones, "c_custkey", "c", "q")


@query("g12_campaign_succeeded", "SELECT count(*) AS envios, count(*) FILTER (value > 50) AS entregas, count(*) FILTER (value > 50) > 0 AS sucesso FROM events WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-15'")
def _(t):
    return campaign.campaign_succeeded(t.events, F.col("event_type") == "click", F.col("ts") >= "2024-01-15", F.col("value") > 50)


@query("g13_normalize_messages", """
SELECT conv_id, turn, CAST(0 AS INTEGER) AS part, CASE role WHEN 'user' THEN 'user' ELSE 'tool_call' END AS kind, CASE role WHEN 'user' THEN 'oi' ELSE '{}' END AS content, CASE WHEN role <> 'user' THEN 'c' || turn END AS call_id, CASE WHEN role <> 'user' THEN 'busca' END AS tool FROM conversations
UNION ALL SELECT conv_id, turn, 1, 'assistant', 'resposta', NULL, NULL FROM conversations WHERE role <> 'user'""")
def _(t):
    call = F.struct(F.concat(F.lit("c"), F.col("turn").cast("string")).alias("id"), F.lit("busca").alias("name"), F.lit("{}").alias("args"))
    user = F.struct(F.lit("human").alias("type"), F.lit("oi").alias("content"), F.filter(F.array(call), lambda x: F.lit(False)).alias("tool_calls"))
    ai = F.struct(F.lit("ai").alias("type"), F.lit("resposta").alias("content"), F.array(call).alias("tool_calls"))
    doc = F.to_json(F.struct(F.when(F.col("role") == "user", user).otherwise(ai).alias("kwargs")))
    return messages.normalize_messages(t.conversations.withColumn("doc", doc), ["conv_id", "turn"], "doc")


_KEY = "lower(regexp_replace(p_type || ' ' || p_name, '[^a-zA-Z0-9 ]', '', 'g'))"


@query("g14_pending_addresses", f"SELECT DISTINCT {_KEY} AS chave FROM part WHERE {_KEY} NOT IN (SELECT {_KEY} FROM part WHERE p_size < 10)")
def _(t):
    keyed = t.part.select("p_size", address_key(F.col("p_type"), F.col("p_name")).alias("chave"))
    return joins.unknown_keys(keyed, keyed.where("p_size < 10"), "chave")


@query("g15_cascade_repeated_keys", """
WITH a AS (SELECT l_partkey, min(l_returnflag) AS v FROM lineitem WHERE l_quantity > 49 GROUP BY 1), b AS (SELECT l_partkey, min(l_linestatus) AS v FROM lineitem WHERE l_quantity < 5 GROUP BY 1)
SELECT p_partkey, coalesce(a.v, b.v) AS lugar, CASE WHEN a.v IS NOT NULL THEN 'a' WHEN b.v IS NOT NULL THEN 'b' END AS fonte FROM part LEFT JOIN a ON a.l_partkey = p_partkey LEFT JOIN b ON b.l_partkey = p_partkey""")
def _(t):
    """Lookups with many rows of a key: a part stays one row."""
    a = t.lineitem.where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"), F.col("l_returnflag").alias("lugar"))
    b = t.lineitem.where("l_quantity < 5").select(F.col("l_partkey").alias("p_partkey"), F.col("l_linestatus").alias("lugar"))
    return campaign.cascade(t.part.select("p_partkey"), "p_partkey", [("a", a), ("b", b)], "lugar")


@query("g15_cascade", "SELECT p_partkey, coalesce(s_name, n_name) AS lugar, CASE WHEN s_name IS NOT NULL THEN 'a' WHEN n_name IS NOT NULL THEN 'b' END AS fonte FROM part LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON s_suppkey = p_partkey LEFT JOIN nation ON n_nationkey = p_partkey")
def _(t):
    a = t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("p_partkey"), F.col("s_name").alias("lugar"))
    b = t.nation.select(F.col("n_nationkey").cast("long").alias("p_partkey"), F.col("n_name").alias("lugar"))
    return campaign.cascade(t.part.select("p_partkey"), "p_partkey", [("a", a), ("b", b)], "lugar")


@query("g17_enrich_tickets", """
WITH u AS (SELECT l_orderkey, l_partkey AS responsavel FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC) = 1),
d AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey) = 1)
SELECT o_orderkey, responsavel, EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o_orderkey AND l_returnflag = 'R') AS devolvido FROM d LEFT JOIN u ON l_orderkey = o_orderkey""")
def _(t):
    owner = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max_by("l_partkey", F.struct("l_linenumber", "l_partkey")).alias("responsavel"))
    one = dedupe_equivalents(t.orders.withColumn("dia", F.to_date("o_orderdate")), "o_custkey", "dia", ["o_orderkey"])
    r = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.with_exists(one.select("o_orderkey").join(owner, "o_orderkey", "left"), r, ["o_orderkey"], "devolvido")


@query("g18_quality_changes", "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'média' ELSE 'baixa' END AS rotulo, '- ' || CASE o_orderstatus WHEN 'O' THEN 'média' ELSE 'baixa' END || ': ' || o_orderpriority AS linha FROM orders WHERE o_orderstatus IN ('O', 'P')")
def _(t):
    o = t.orders.withColumn("nivel", F.when(F.col("o_orderstatus") == "O", "YELLOW").when(F.col("o_orderstatus") == "P", "RED").otherwise("GREEN"))
    return messages.quality_changes(o, "nivel", {"YELLOW": "média", "RED": "baixa"}, "o_orderpriority").select("o_orderkey", "rotulo", "linha")


@query("g19_pending_media", "SELECT p_partkey, s_name AS dono FROM part LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON s_suppkey = p_partkey % 100 WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 47)")
def _(t):
    owner = latest_by(t.supplier.where("s_acctbal > 0"), ["s_suppkey"], "s_acctbal").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("dono"))
    todo = t.part.join(t.lineitem.where("l_quantity > 47").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_anti")
    return todo.withColumn("k", F.col("p_partkey") % 100).join(owner, "k", "left").select("p_partkey", "dono")


@query("g20_audio_messages", "SELECT conv_id, CAST(turn AS VARCHAR) AS id, 'f' || turn AS file FROM conversations WHERE turn % 2 = 1")
def _(t):
    kind = F.when(F.col("turn") % 2 == 1, "audio/ogg").otherwise("image/png")
    msg = F.struct(F.col("turn").cast("string").alias("id"), F.struct(F.concat(F.lit("f"), F.col("turn").cast("string")).alias("file"), kind.alias("contentType")).alias("media"))
    docs = t.conversations.groupBy("conv_id").agg(F.to_json(F.struct(F.collect_list(msg).alias("messages"))).alias("doc"))
    return messages.audio_messages(docs, ["conv_id"], "doc")


@query("g21_alert_aggregation", f"""
WITH c AS ({CLUSTERS}) SELECT tipo, "cluster", count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids, round(avg(lat), 6) AS lat, CASE WHEN count(*) >= 5 THEN 'count' ELSE 'age' END AS motivo FROM c GROUP BY 1, 2""")
def _(t):
    """Cluster reports, sum each cluster up, decide whether it is sent."""
    placed = geo.geo_clusters(_points(t), "id", "tipo", "lat", "lon", 500.0)
    first = placed.withColumn("ts", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")).withColumn("texto", F.lit("x"))
    groups = summarize_group(first, ["tipo", "cluster"], "ts", "id", "texto", F.lit(1), "lat", "lon")
    sent = geo.emit_decision(groups, F.lit(NOW).cast("timestamp_ntz"))
    return sent.select("tipo", "cluster", "n", F.array_join("ids", ",").alias("ids"), "lat", "motivo")
