"""Queries of the scalar functions (F)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from urbana.functions import contact as ct
from urbana.functions import dates as ds
from urbana.functions import geo, text as tx
from urbana.functions.markup import chat_markup
from urbana.operators import clean
from urbana.operators.joins import unnest
from urbana.queries.base import query


def _phone(t):
    """Customers with made digits: valid mobiles, landlines, 55-prefixed, short and placeholder numbers by key."""
    k = F.col("c_custkey")
    area, eight = F.lit("21"), F.lpad((k * 7919 % 100000000).cast("string"), 8, "0")
    raw = F.when(k % 5 == 0, F.concat(area, F.lit("9"), eight)).when(k % 5 == 1, F.concat(F.lit("+55 (21) 9"), eight)).when(k % 5 == 2, F.concat(area, eight)).when(k % 5 == 3, F.lit("21999999999")).otherwise(F.substring(eight, 1, 6))
    return t.customer.select("c_custkey", raw.alias("fone"))


PHONES = """(SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '219' || o WHEN 1 THEN '+55 (21) 9' || o WHEN 2 THEN '21' || o WHEN 3 THEN '21999999999' ELSE substr(o, 1, 6) END AS fone
FROM (SELECT c_custkey, lpad(CAST(c_custkey * 7919 % 100000000 AS VARCHAR), 8, '0') AS o FROM customer))"""
NATIONAL = f"(SELECT c_custkey, fone, CASE WHEN d LIKE '55%' AND length(d) IN (12, 13) THEN substr(d, 3, 11) ELSE d END AS n FROM (SELECT *, regexp_replace(regexp_replace(fone, '[^0-9]', '', 'g'), '^0+', '') AS d FROM {PHONES}))"


@query("f01_pad_id", "SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS cpf FROM customer")
def _(t):
    return t.customer.select("c_custkey", tx.pad_id(F.col("c_custkey")).alias("cpf"))


INIT = "array_to_string(list_transform(string_split({0}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"


@query("f02_short_name", f"SELECT p_partkey, {INIT.format('n')} AS nome, {INIT.format('p')} || ' ' AS primeiro FROM (SELECT p_partkey, string_split(p_name, ' ')[1] AS p, CASE WHEN len(string_split(p_name, ' ')) > 1 THEN string_split(p_name, ' ')[1] || ' ' || string_split(p_name, ' ')[-1] ELSE p_name END AS n FROM part)")
def _(t):
    return t.part.select("p_partkey", tx.short_name(F.col("p_name")).alias("nome"), tx.short_name(F.col("p_name"), last=False).alias("primeiro"))


@query("f03_social_or_legal", "SELECT c_custkey, coalesce(nullif(CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN c_mktsegment END, ''), c_name) AS nome FROM customer")
def _(t):
    s = F.when(F.col("c_custkey") % 3 == 0, "").when(F.col("c_custkey") % 3 == 1, F.col("c_mktsegment"))
    return t.customer.select("c_custkey", tx.social_or_legal(s, F.col("c_name")).alias("nome"))


@query("f04_digits", "SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS d FROM customer")
def _(t):
    return t.customer.select("c_custkey", tx.digits(F.col("c_name")).alias("d"))


@query("f05_format_phone", f"SELECT c_custkey, CASE WHEN regexp_matches(n, '^[1-9][1-9](9[0-9]{{8}}|[2-5][0-9]{{7}})$') THEN '55' || n END AS fone, CASE WHEN regexp_matches(n, '^[1-9][1-9]9[0-9]{{8}}$') THEN '55' || n END AS celular FROM {NATIONAL}")
def _(t):
    return _phone(t).select("c_custkey", ct.format_phone(F.col("fone")).alias("fone"), ct.format_cellphone(F.col("fone")).alias("celular"))


@query("f06_first_valid", f"SELECT c_custkey, coalesce(CASE WHEN regexp_matches(n, '^[1-9][1-9]9[0-9]{{8}}$') THEN '55' || n END, '5521988887777') AS fone FROM {NATIONAL}")
def _(t):
    return _phone(t).select("c_custkey", ct.first_valid(F.col("fone"), F.lit("x"), F.lit("(21) 98888-7777")).alias("fone"))


@query("f07_ninth_digit", "SELECT c_custkey, CASE WHEN length(x) = 12 THEN substr(x, 1, 4) || '9' || substr(x, 5, 8) ELSE x END AS fone FROM (SELECT c_custkey, '5521' || lpad(CAST(c_custkey AS VARCHAR), CASE WHEN c_custkey % 2 = 0 THEN 8 ELSE 9 END, '9') AS x FROM customer)")
def _(t):
    x = F.concat(F.lit("5521"), F.when(F.col("c_custkey") % 2 == 0, F.lpad(F.col("c_custkey").cast("string"), 8, "9")).otherwise(F.lpad(F.col("c_custkey").cast("string"), 9, "9")))
    return t.customer.select("c_custkey", ct.add_ninth_digit(x).alias("fone"))


@query("f08_both_spellings", """
SELECT c_custkey, unnest(CASE WHEN length(x) = 12 THEN [substr(x, 1, 4) || '9' || substr(x, 5, 8), x] WHEN length(x) = 13 AND x[5] = '9' THEN [x, substr(x, 1, 4) || substr(x, 6, 8)] ELSE [x] END) AS fone
FROM (SELECT c_custkey, '5521' || lpad(CAST(c_custkey AS VARCHAR), CASE WHEN c_custkey % 2 = 0 THEN 8 ELSE 9 END, '9') AS x FROM customer)""")
def _(t):
    x = F.concat(F.lit("5521"), F.when(F.col("c_custkey") % 2 == 0, F.lpad(F.col("c_custkey").cast("string"), 8, "9")).otherwise(F.lpad(F.col("c_custkey").cast("string"), 9, "9")))
    return unnest(t.customer.select("c_custkey", ct.both_spellings(x).alias("a")), "a", "fone")


@query("f09_mobiles", f"SELECT c_custkey, CASE WHEN regexp_matches(d, '^[0-9]{{2}}9[0-9]{{8}}$') AND d <> '21999999999' THEN d ELSE '' END AS lista FROM (SELECT c_custkey, regexp_replace(fone, '[^0-9]', '', 'g') AS d FROM {PHONES})")
def _(t):
    return _phone(t).select("c_custkey", F.array_join(ct.mobiles(F.col("fone"), F.lit("123"), F.col("fone")), ";").alias("lista"))


@query("f10_int_text", "SELECT o_orderkey, CAST(CAST(o_orderkey AS BIGINT) AS VARCHAR) AS a, NULL AS b FROM orders")
def _(t):
    return t.orders.select("o_orderkey", ct.int_text(F.concat(F.col("o_orderkey").cast("string"), F.lit(".0"))).alias("a"), ct.int_text(F.col("o_orderstatus")).alias("b"))


@query("f11_attachment_links", """
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'http://a/' || p_partkey || ';http://b/' || p_size WHEN 1 THEN 'http://d/' || p_partkey ELSE '' END AS links FROM part""")
def _(t):
    """Two links in a text, or else the direct one, or none."""
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    both = F.concat(F.lit("texto ANEXOS: http://a/"), key, F.when(F.col("p_size") % 2 == 0, "||").otherwise(", nada "), F.lit("http://b/"), size, F.lit(" >> resto http://c"))
    s = F.when(F.col("p_partkey") % 3 == 0, both).when(F.col("p_partkey") % 6 == 1, "sem links http://c")
    direct = F.when(F.col("p_partkey") % 3 == 1, F.concat(F.lit(" http://d/"), key)).when(F.col("p_partkey") % 6 == 2, "nada")
    return t.part.select("p_partkey", tx.attachment_links(s, direct).alias("links"))


@query("f12_unaccent", "SELECT doc_id, strip_accents(regexp_replace(text, '[^a-zA-Z ñéèêáíóúüöäçñÉÈÊÁÍÓÚÜÖÄÇÑ]', '', 'g')) AS t FROM documents")
def _(t):
    return t.documents.select("doc_id", tx.unaccent(F.regexp_replace("text", "[^a-zA-Z ñéèêáíóúüöäçñÉÈÊÁÍÓÚÜÖÄÇÑ]", "")).alias("t"))


@query("f13_address_key", "SELECT p_partkey, lower(regexp_replace(p_type || ' ' || p_name || CASE WHEN p_size % 2 = 0 THEN ' ' || p_size ELSE '' END, '[^a-zA-Z0-9 ]', '', 'g')) AS chave FROM part")
def _(t):
    return t.part.select("p_partkey", tx.address_key(F.col("p_type"), F.col("p_name"), F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string"))).alias("chave"))


@query("f14_currency", "SELECT p_partkey, 'R$ ' || replace(printf('%.2f', p_retailprice), '.', ',') AS valor FROM part")
def _(t):
    return t.part.select("p_partkey", tx.brl(F.col("p_retailprice")).alias("valor"))


@query("f15_one_line", r"SELECT doc_id, regexp_replace(text, '[\r\n]', '', 'g') AS t FROM documents")
def _(t):
    return t.documents.select("doc_id", tx.one_line(F.col("text")).alias("t"))


@query("f16_strip_marks", "SELECT page_id, translate(url, '-./() ,+;', '') AS t FROM pages")
def _(t):
    return t.pages.select("page_id", tx.strip_marks(F.col("url")).alias("t"))


@query("f17_leading_number", "SELECT p_partkey, CAST(p_size AS DOUBLE) AS a, NULL AS b FROM part")
def _(t):
    return t.part.select("p_partkey", tx.leading_number(F.concat(F.col("p_size").cast("string"), F.lit("ºC"))).alias("a"), tx.leading_number(F.lit("NIL")).alias("b"))


@query("f18_chat_markup", r"""
SELECT conv_id, turn, '*' || role || E'*\n\n*' || turn || '* http://x/' || turn || ' `**' || role || E'**`\n* feito[1]\n\n```papel' || repeat(' ', greatest(length(role) - 5, 0)) || E' | n\n' || role || repeat(' ', greatest(5 - length(role), 0)) || ' | ' || turn || E'```\n\n---\n_Notas:_\n[1] ' || role AS t
FROM conversations""")
def _(t):
    """A message around each turn with a heading, bold, a link, code, a task, a table and a footnote."""
    body = "# {role}\n**{turn}** [aqui](http://x/{turn}) `**{role}**`\n* [x] feito[^n][^nada]\n|papel|n|\n|--|--|\n|{role}|{turn}|\n[^n]: {role}\n"
    return t.conversations.select("conv_id", "turn", chat_markup(tx.fill(body, role=F.col("role"), turn=F.col("turn"))).alias("t"))


@query("f19_template_fill", "SELECT c_custkey, 'Oi ' || c_name || ', saldo ' || coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, '') || '!' AS msg FROM customer")
def _(t):
    return t.customer.select("c_custkey", tx.fill("Oi {nome}, saldo {s}!", nome=F.col("c_name"), s=F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))).alias("msg"))


@query("f20_calendar_years", "SELECT o_orderkey, CAST(2024 - year(o_orderdate) AS INTEGER) AS anos FROM orders")
def _(t):
    return t.orders.select("o_orderkey", ds.calendar_years(F.col("o_orderdate"), F.lit(dt.date(2024, 1, 1))).alias("anos"))


@query("f21_business_offset", """
SELECT o_orderkey, CAST(d + CASE isodow(d) WHEN 4 THEN 4 WHEN 5 THEN 4 WHEN 6 THEN 3 ELSE 2 END AS DATE) AS dia, CAST(d + CASE isodow(d) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS DATE) AS util,
CAST(len(list_filter(generate_series(d, d + 10, INTERVAL 1 DAY), lambda x: isodow(x) < 6)) AS INTEGER) AS dias FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def _(t):
    d = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", ds.business_offset(d).alias("dia"), ds.weekend_shift(d).alias("util"), ds.business_days(d, F.date_add(d, 10)).alias("dias"))


@query("f22_floors", "SELECT event_id, CAST(date_trunc('month', ts) AS DATE) AS mes, CAST(date_trunc('week', ts) AS DATE) AS semana, CAST(CAST(ts AS DATE) + INTERVAL 30 MONTH AS DATE) AS mais FROM events")
def _(t):
    return t.events.select("event_id", ds.month_floor(F.col("ts")).alias("mes"), ds.week_start(F.col("ts")).alias("semana"), F.add_months(F.to_date("ts"), 30).alias("mais"))


@query("f23_to_local", "SELECT event_id, CAST(ts - INTERVAL 3 HOUR AS DATE) AS data, strftime(ts - INTERVAL 3 HOUR, '%H:%M:%S') AS hora FROM events")
def _(t):
    local = ds.to_local(F.col("ts"))
    return t.events.select("event_id", F.to_date(local).alias("data"), F.date_format(local, "HH:mm:ss").alias("hora"))


@query("f24_parse_any", "SELECT event_id, CASE WHEN event_id % 3 < 2 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS t FROM events")
def _(t):
    s = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "dd/MM/yyyy")).when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd")).otherwise("ontem")
    return t.events.select("event_id", ds.parse_any(s, "dd/MM/yyyy", "yyyy-MM-dd").cast("timestamp_ntz").alias("t"))


@query("f25_safe_cast", "SELECT p_partkey, try_cast(substr(p_name, 1, 1) AS INTEGER) AS a, try_cast(p_size AS INTEGER) AS b, string_split(p_name, ' ')[3] AS c FROM part")
def _(t):
    return t.part.select("p_partkey", F.substring("p_name", 1, 1).try_cast("int").alias("a"), F.col("p_size").try_cast("int").alias("b"), F.get(F.split("p_name", " "), F.lit(2)).alias("c"))


@query("f26_format_date", "SELECT event_id, strftime(ts, '%d/%m/%Y') AS d, strftime(ts, '%H:%M') AS h FROM events")
def _(t):
    return t.events.select("event_id", F.date_format("ts", "dd/MM/yyyy").alias("d"), F.date_format("ts", "HH:mm").alias("h"))


@query("f27_whole_hours", "SELECT event_id, date_sub('hour', TIMESTAMP '2024-01-15 12:00:00', ts) AS horas FROM events")
def _(t):
    return t.events.select("event_id", ds.whole_hours(F.lit(dt.datetime(2024, 1, 15, 12)).cast("timestamp_ntz"), F.col("ts")).alias("horas"))


@query("f28_alternates", "SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN '' ELSE array_to_string(list_filter([p_brand, p_type, 'x'], lambda v: v <> 'x'), ',') END AS outros FROM part")
def _(t):
    arr = F.array("p_brand", F.lit(None).cast("string"), "p_type", F.lit("x"))
    return t.part.select("p_partkey", F.array_join(ct.alternates(arr, F.when(F.col("p_size") % 4 != 0, "x")), ",").alias("outros"))


@query("f29_documents", """SELECT c_custkey, '{"nome":"' || c_name || '","vars":{"s":' || CASE WHEN c_custkey % 2 = 0 THEN '"' || c_mktsegment || '"' ELSE 'null' END || '}}' AS doc, c_name AS nome FROM customer""")
def _(t):
    d = F.to_json(F.struct(F.col("c_name").alias("nome"), F.struct(F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("s")).alias("vars")), {"ignoreNullFields": "false"})
    return t.customer.select("c_custkey", d.alias("doc")).withColumn("nome", F.from_json("doc", "nome STRING, vars STRUCT<s: STRING>")["nome"])


@query("f30_json_complex", """SELECT p_partkey, '{"b":"' || p_brand || '","s":' || p_size || '}' AS x, '["' || p_type || '"]' AS y FROM part""")
def _(t):
    return clean.json_complex(t.part.select("p_partkey", F.struct(F.col("p_brand").alias("b"), F.col("p_size").alias("s")).alias("x"), F.array("p_type").alias("y")))


@query("f31_row_hash", """SELECT p_partkey, md5('{"p_brand":"' || p_brand || '","p_partkey":' || p_partkey || ',"p_size":' || p_size || '}') AS h FROM part""")
def _(t):
    p = t.part.select("p_size", "p_partkey", "p_brand")
    return p.select("p_partkey", clean.row_hash(p).alias("h"))


@query("f32_text_hash", "SELECT doc_id, sha256(text) AS h FROM documents")
def _(t):
    return t.documents.select("doc_id", tx.text_hash(F.col("text")).alias("h"))


@query("f33_group_id", "SELECT user_id, md5(string_agg(event_id, ',' ORDER BY event_id)) AS grupo FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy("user_id").agg(F.md5(F.array_join(F.sort_array(F.collect_list("event_id")).cast("array<string>"), ",")).alias("grupo"))


@query("f35_utm_to_degrees")
def _(t):
    x, y = F.lit(600000.0) + F.col("c_custkey") * 20, F.lit(7440000.0) + F.col("c_custkey") * 15
    lat, lon = geo.utm_to_degrees(x, y)
    return t.customer.select("c_custkey", lat.alias("lat"), lon.alias("lon"))


@query("f36_area_code", """
WITH p AS (SELECT c_custkey, CAST(floor(round((-22.9 - (c_custkey % 97) * 0.001 + 90) * 8000, 6)) AS BIGINT) AS a, CAST(floor(round((-43.2 - (c_custkey % 89) * 0.001 + 180) * 8000, 6)) AS BIGINT) AS o FROM customer),
d AS (SELECT c_custkey, list_transform(range(4, -1, -1), lambda i: substr('23456789CFGHJMPQRVWX', CAST(a // CAST(20 ** i AS BIGINT) % 20 + 1 AS INTEGER), 1) || substr('23456789CFGHJMPQRVWX', CAST(o // CAST(20 ** i AS BIGINT) % 20 + 1 AS INTEGER), 1)) AS l FROM p)
SELECT c_custkey, array_to_string(l[1:4], '') || '+' || l[5] AS codigo FROM d""")
def _(t):
    lat, lon = F.lit(-22.9) - (F.col("c_custkey") % 97) * 0.001, F.lit(-43.2) - (F.col("c_custkey") % 89) * 0.001
    return t.customer.select("c_custkey", geo.area_code(lat, lon).alias("codigo"))


@query("f37_plausible", "SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def _(t):
    return t.customer.where(geo.plausible(F.col("c_acctbal").cast("string"), F.lit("-43.2"))).select("c_custkey")


@query("f38_haversine", """
SELECT c_custkey, round(2 * 6371000 * asin(sqrt(pow(sin(radians(b - a) / 2), 2) + cos(radians(a)) * cos(radians(b)) * pow(sin(radians(0.01) / 2), 2))), 3) AS m
FROM (SELECT c_custkey, -22.9 - (c_custkey % 97) * 0.001 AS a, -22.95 AS b FROM customer)""")
def _(t):
    return t.customer.select("c_custkey", F.round(geo.haversine_m(F.lit(-22.9) - (F.col("c_custkey") % 97) * 0.001, F.lit(-43.2), F.lit(-22.95), F.lit(-43.19)), 3).alias("m"))


@query("f39_recode_capped", "SELECT event_id, left(CASE event_type WHEN 'click' THEN 'clique longo' ELSE event_type END, 6) AS t FROM events")
def _(t):
    return t.events.select("event_id", tx.recode_capped(F.col("event_type"), {"click": "clique longo"}, 6).alias("t"))


@query("f40_year_suffix", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(year(o_orderdate) AS INTEGER) END AS ano FROM orders")
def _(t):
    n = F.concat(F.lit("fluxo_"), F.date_format("o_orderdate", "yyyy"), F.when(F.col("o_orderkey") % 2 == 0, "").otherwise("x"))
    return t.orders.select("o_orderkey", tx.year_suffix(n).alias("ano"))


@query("f41_lines_to_json", """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '{"a": 1}' ELSE '{"nome":"' || c_name || '","segmento":"' || c_mktsegment || ' fim"}' END AS j FROM customer""")
def _(t):
    s = F.when(F.col("c_custkey") % 2 == 0, '{"a": 1}').otherwise(F.concat(F.lit("nome: "), F.col("c_name"), F.lit("\nsegmento: "), F.col("c_mktsegment"), F.lit("\nfim")))
    return t.customer.select("c_custkey", tx.lines_to_json(s).alias("j"))


@query("f42_pick_identifier", "SELECT p_partkey AS id FROM part")
def _(t):
    return t.part.select(F.col(clean.pick_identifier(t.part, ["cpf", "P_PARTKEY", "p_name"])).alias("id"))


@query("f43_path_token", "SELECT page_id, regexp_replace(url, '[^a-zA-Z0-9_-]', '_', 'g') AS t FROM pages")
def _(t):
    return t.pages.select("page_id", tx.path_token(F.col("url")).alias("t"))


@query("f44_display_phone", "SELECT c_custkey, CASE WHEN length(x) = 10 THEN '(' || x[1:2] || ') ' || x[3:6] || '-' || x[7:10] WHEN length(x) = 11 THEN '(' || x[1:2] || ') ' || x[3:7] || '-' || x[8:11] ELSE x END AS f FROM (SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), CAST(9 + c_custkey % 3 AS INTEGER), '2') AS x FROM customer)")
def _(t):
    k = F.col("c_custkey")
    x = F.when(k % 3 == 0, F.lpad(k.cast("string"), 9, "2")).when(k % 3 == 1, F.lpad(k.cast("string"), 10, "2")).otherwise(F.lpad(k.cast("string"), 11, "2"))
    return t.customer.select("c_custkey", ct.display_phone(x).alias("f"))


@query("f45_minute_of", "SELECT event_id, strftime(ts, '%H:%M') AS m FROM events")
def _(t):
    return t.events.select("event_id", F.date_format("ts", "HH:mm").alias("m"))


@query("f50_sql_functions", r"""
WITH n AS (SELECT c_custkey, '0' || '21' || CASE c_custkey % 3 WHEN 0 THEN '9' WHEN 1 THEN '' ELSE '7' END || lpad(CAST(c_custkey AS VARCHAR), 8, '8') AS nacional FROM customer),
d AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '+55 (' || nacional[2:3] || ') ' || nacional[4:] ELSE nacional END AS escrito, nacional[2:] AS n FROM n)
SELECT c_custkey, CASE WHEN regexp_matches(n, '^[1-9][1-9]9[0-9]{8}$') THEN '55' || n END AS celular, CASE WHEN regexp_matches(n, '^[1-9][1-9](9[0-9]{8}|[2-5][0-9]{7})$') THEN '55' || n END AS fone,
'55219' || lpad(CAST(c_custkey AS VARCHAR), 8, '9') AS nono, upper(c_name[1]) || lower(c_name[2:]) || ' Silva' AS nome, CAST(24 AS INTEGER) AS anos,
round(2 * 6371000 * asin(sqrt(pow(sin(radians(0.01) / 2), 2) + cos(radians(-22.9)) * cos(radians(-22.89)) * pow(sin(radians(0.001 * (c_custkey % 10)) / 2), 2))), 3) AS metros
FROM d JOIN customer USING (c_custkey)""")
def _(t):
    """Every scalar SQL function over the customers, some numbers with 55, brackets or a leading zero."""
    ct.register(t.spark)
    n = t.customer.selectExpr("*", "concat('0', '21', CASE c_custkey % 3 WHEN 0 THEN '9' WHEN 1 THEN '' ELSE '7' END, lpad(CAST(c_custkey AS STRING), 8, '8')) AS nacional")
    n = n.selectExpr("*", "CASE WHEN c_custkey % 2 = 0 THEN concat('+55 (', substring(nacional, 2, 2), ') ', substring(nacional, 4)) ELSE nacional END AS escrito")
    return n.selectExpr(
        "c_custkey", "cellphone(escrito) AS celular", "phone(escrito) AS fone", "ninth_digit('5521' || lpad(CAST(c_custkey AS STRING), 8, '9')) AS nono", "short_name(c_name || ' da Silva') AS nome",
        "calendar_years(DATE'2000-05-01', DATE'2024-01-01') AS anos", "round(haversine_m(-22.9, -43.2, -22.89, -43.2 + 0.001 * (c_custkey % 10)), 3) AS metros",
    )


@query("f51_business_days", """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a FROM orders WHERE o_orderkey % 7 = 0)
SELECT o_orderkey, dia, CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY dia) AS INTEGER) AS n FROM (SELECT o_orderkey, unnest(generate_series(a, a + 9, INTERVAL 1 DAY))::DATE AS dia FROM o)
WHERE isodow(dia) < 6 AND NOT (month(dia) = 1 AND day(dia) = 1 OR month(dia) = 12 AND day(dia) = 25)""")
def _(t):
    """The business days of the ten days from each order on, by a table function joined laterally; two holidays a year."""
    ct.register(t.spark)
    t.orders.where("o_orderkey % 7 = 0").select("o_orderkey", F.to_date("o_orderdate").alias("a")).createOrReplaceTempView("f51_orders")
    years = "transform(sequence(1990, 2030), y -> array(make_date(y, 1, 1), make_date(y, 12, 25)))"
    return t.spark.sql(f"SELECT o_orderkey, dia, n FROM f51_orders, LATERAL business_days(a, date_add(a, 9), flatten({years}))")
