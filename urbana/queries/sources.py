"""Queries of scans, sources and sinks (S): each writes what it reads to the shared folder, in the format named."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from urbana.functions.dates import date_from_name
from urbana.operators import clean
from urbana.operators.incremental import publish, rolling_upsert
from urbana.queries.base import query
from urbana.session import scratch_path
from urbana.sources import dialects, io

RUN = dt.datetime(2024, 2, 1, 12, 0, 0)


@query("s01_window_predicates", "SELECT date_trunc('month', o_orderdate) AS mes, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01' GROUP BY 1")
def _(t):
    preds = io.predicates("o_orderdate", "month", "1995-01-01", "previous_day", dt.date(1996, 1, 1))
    which = F.coalesce(*[F.when(F.expr(p), i) for i, p in enumerate(preds)])
    x = t.orders.withColumn("w", which).where("w IS NOT NULL").groupBy("w").agg(F.min(F.date_trunc("month", "o_orderdate")).cast("timestamp_ntz").alias("mes"), F.count(F.lit(1)).alias("n"))
    return x.drop("w")


@query("s02_dialect_predicates", """
WITH d(dialeto, antes, depois) AS (VALUES ('derby', 'DATE(' || chr(39), chr(39) || ')'), ('mysql', 'DATE ' || chr(39), chr(39)), ('oracle', 'DATE ' || chr(39), chr(39)), ('sqlserver', 'CONVERT(DATE, ' || chr(39), chr(39) || ', 23)')),
m AS (SELECT date_trunc('month', o_orderdate) AS mes, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1995-03-15' AND o_orderdate < TIMESTAMP '1996-01-01' GROUP BY 1)
SELECT dialeto, '(o_orderdate >= ' || antes || strftime(mes, '%Y-%m-%d') || depois || ' AND o_orderdate < ' || antes || strftime(mes + INTERVAL 1 MONTH, '%Y-%m-%d') || depois || ') AND o_orderdate >= ' || antes || '1995-03-15' || depois AS predicado, n FROM d, m""")
def _(t):
    """The predicate of each month from a lower bound on, for four databases, with the orders that it takes here."""
    texts = {name: io.predicates("o_orderdate", "month", "1995-01-01", "previous_day", dt.date(1996, 1, 1), name, "1995-03-15") for name in ("derby", "mysql", "oracle", "sqlserver", "spark")}
    which = F.coalesce(*[F.when(F.expr(p), i) for i, p in enumerate(texts.pop("spark"))])
    every = F.array(*[F.struct(F.lit(name).alias("dialeto"), F.array(*map(F.lit, preds)).alias("p")) for name, preds in texts.items()])
    months = t.orders.withColumn("w", which).where("w IS NOT NULL").groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return months.withColumn("d", F.explode(every)).select("d.dialeto", F.get("d.p", F.col("w")).alias("predicado"), "n")


@query("s03_lower_bound", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'")
def _(t):
    return t.orders.where(dialects.lower_bound("o_orderdate", "1998-01-01 00:00:00", "spark", strict=True)).select("o_orderkey", "o_orderdate")


@query("s04_loaded_at", "SELECT n_nationkey, TIMESTAMP '2024-02-01 12:00:00' AS loaded_at FROM nation")
def _(t):
    return io.with_loaded_at(t.nation.select("n_nationkey"), RUN).withColumn("loaded_at", F.col("loaded_at").cast("timestamp_ntz"))


@query("s05_text_csv", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_mktsegment END AS seg FROM customer")
def _(t):
    at = scratch_path(t.spark, "csv")
    t.customer.select("c_custkey", "c_name", F.when(F.col("c_custkey") % 2 == 0, "").otherwise(F.col("c_mktsegment")).alias("seg")).write.option("header", True).option("emptyValue", "").csv(at)
    return io.read_text_csv(t.spark, at)


@query("s06_records_to_json", """SELECT o_orderkey, '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS content FROM orders""")
def _(t):
    return clean.records_to_json(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey")


@query("s07_xml_rows", "SELECT s_suppkey AS id, s_name AS nome, CAST(s_nationkey AS BIGINT) AS pais FROM supplier")
def _(t):
    at = scratch_path(t.spark, "xml")
    t.supplier.select(F.col("s_suppkey").alias("_id"), F.col("s_name").alias("nome"), F.col("s_nationkey").alias("_pais")).write.format("xml").option("rootTag", "estacoes").option("rowTag", "estacao").save(at)
    return io.read_xml_rows(t.spark, at, "estacao", "_id BIGINT, nome STRING, _pais BIGINT").select(F.col("_id").alias("id"), "nome", F.col("_pais").alias("pais"))


@query("s08_placemarks", """SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'R' || n_regionkey ELSE 'sub' END AS folder, n_name AS name, '-43.' || n_nationkey || ',-22.9' AS coordinates, '{"k":"' || n_nationkey || '"}' AS attributes FROM nation""")
def _(t):
    mark = F.format_string("<Placemark><name>%s</name><Point><coordinates>-43.%d,-22.9</coordinates></Point><ExtendedData><Data name=\"k\"><value>%d</value></Data></ExtendedData></Placemark>", "n_name", "n_nationkey", "n_nationkey")
    even, odd = (F.array_join(F.collect_list(F.when(F.col("n_nationkey") % 2 == k, mark)), "") for k in (0, 1))
    docs = t.nation.groupBy("n_regionkey").agg(even.alias("a"), odd.alias("b"))
    kml = F.concat(F.lit("<kml><Document><name>d</name><Folder><name>R"), F.col("n_regionkey").cast("string"), F.lit("</name>"), F.col("a"), F.lit("<Folder><name>sub</name>"), F.col("b"), F.lit("</Folder></Folder></Document></kml>"))
    return io.placemarks(docs.select(kml.alias("kml")), "kml")


@query("s09_html_rows", "SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, regexp_extract_all(html, '<li>(.*?)</li>', 1)[i] AS value FROM pages, unnest(range(1, len(regexp_extract_all(html, '<li>(.*?)</li>', 1)) + 1)) AS u(i)")
def _(t):
    return io.html_rows(t.pages, "html", "<li>(.*?)</li>", ["page_id"])


@query("s10_table_family", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS o_orderstatus FROM orders")
def _(t):
    at = scratch_path(t.spark, "family")
    t.orders.where("o_orderkey % 2 = 0").select("o_orderkey").write.parquet(f"{at}/fluxo_a")
    t.orders.where("o_orderkey % 2 = 1").select("o_orderkey", "o_orderstatus").write.parquet(f"{at}/fluxo_b")
    return io.read_family(t.spark, f"{at}/fluxo_*").select("o_orderkey", "o_orderstatus")


def registry_lines(t, version: str):
    """Customers as fixed-width lines: name 1-18, key 19-26, balance in cents 27-37, record code 38-39, date 40-47, segment 48."""
    c = t.customer
    cents = F.lpad(F.abs(F.round(F.col("c_acctbal") * 100)).cast("bigint").cast("string"), 11, "0")
    day = F.when(F.col("c_custkey") % 5 == 0, " " * 8).otherwise(F.date_format(F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("c_custkey").cast("int") % 300), "ddMMyyyy"))
    code = F.when(F.col("c_custkey") % 2 == 0, "01").otherwise("02")
    text = F.concat(F.rpad("c_name", 18, " "), F.lpad(F.col("c_custkey").cast("string"), 8, " "), cents, code, day, F.substring("c_mktsegment", 1, 1))
    head = c.limit(1).select(F.rpad(F.concat(F.rpad(F.lit(" "), 37, " "), F.lit("00"), F.rpad(F.lit(" "), 30, " "), F.rpad(F.lit(version), 5, " "), F.rpad(F.lit(" "), 8, " "), F.lit("15032024")), 100, " ").alias("text"))
    return c.select(text.alias("text")).unionByName(head)


@query("s11_fixed_width", "SELECT count(*) + 1 AS linhas, CAST(48 AS INTEGER) AS menor FROM customer")
def _(t):
    at = scratch_path(t.spark, "fixed")
    registry_lines(t, "7").write.text(at)
    return io.read_fixed_width(t.spark, at).agg(F.count(F.lit(1)).alias("linhas"), F.min(F.length("text")).alias("menor"))


@query("s12_header_info", "SELECT '7' AS versao_layout, DATE '2024-03-15' AS data_extracao FROM (SELECT count(*) AS n FROM customer) WHERE n > 0")
def _(t):
    return io.header_info(registry_lines(t, "7"))


@query("s13_date_from_name", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(ts AS DATE) WHEN 1 THEN CAST(ts AS DATE) WHEN 2 THEN CAST(date_trunc('month', ts) AS DATE) END AS d FROM events")
def _(t):
    k = F.col("event_id") % 4
    n = F.when(k == 0, F.concat(F.lit("CAD.A"), F.date_format("ts", "yyMMdd"), F.lit(".txt"))).when(k == 1, F.concat(F.lit("base_"), F.date_format("ts", "yyyyMMdd"), F.lit(".txt"))).when(k == 2, F.concat(F.lit("base_"), F.date_format("ts", "yyyyMM"), F.lit(".txt"))).otherwise("sem_data.txt")
    return t.events.select("event_id", date_from_name(n).alias("d"))


@query("s14_pending_partitions", "SELECT DISTINCT date_trunc('month', o_orderdate) AS m FROM orders WHERE date_trunc('month', o_orderdate) NOT IN (SELECT date_trunc('month', l_shipdate) FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01')")
def _(t):
    m = lambda c: F.date_trunc("month", c).cast("timestamp_ntz").alias("m")
    return io.pending_partitions(t.orders.select(m("o_orderdate")), t.lineitem.where("l_shipdate < '1996-01-01'").select(m("l_shipdate")), "m")


@query("s15_write_partitioned", "SELECT CAST(year(ts) AS INTEGER) AS ano_particao, CAST(month(ts) AS INTEGER) AS mes_particao, CAST(ts AS DATE) AS data_particao, count(*) AS n FROM events GROUP BY ALL")
def _(t):
    at = scratch_path(t.spark, "partitions")
    io.write_partitioned(t.events, at, "ts")
    return t.spark.read.parquet(at).groupBy("ano_particao", "mes_particao", "data_particao").agg(F.count(F.lit(1)).alias("n"))


@query("s16_bad_dates_dropped", "SELECT event_id, CAST(ts AS DATE) AS data_particao FROM events WHERE event_id % 3 <> 0")
def _(t):
    e = t.events.select("event_id", F.when(F.col("event_id") % 3 == 0, "31/02").otherwise(F.col("ts").cast("string")).alias("d"))
    return io.with_partitions(e, "d", "date", "drop").select("event_id", "data_particao")


@query("s17_append_overwrite", "SELECT 2 * count(*) AS depois_de_somar, count(*) AS depois_de_trocar FROM nation")
def _(t):
    at = scratch_path(t.spark, "modes")
    t.nation.write.mode("append").parquet(f"{at}/a")
    t.nation.write.mode("append").parquet(f"{at}/a")
    t.nation.write.mode("overwrite").parquet(f"{at}/b")
    t.nation.write.mode("overwrite").parquet(f"{at}/b")
    n = lambda p, c: t.spark.read.parquet(f"{at}/{p}").agg(F.count(F.lit(1)).alias(c))
    return n("a", "depois_de_somar").crossJoin(F.broadcast(n("b", "depois_de_trocar")))  # one row each


@query("s18_replace_partitions", "SELECT CAST(ts AS DATE) AS data_particao, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-05' THEN 2 ELSE 1 END AS ciclo, count(*) AS n FROM events GROUP BY ALL")
def _(t):
    at = scratch_path(t.spark, "snapshot")
    day = t.events.withColumn("data_particao", F.to_date("ts"))
    day.withColumn("ciclo", F.lit(1)).write.partitionBy("data_particao").parquet(at)
    io.replace_partitions(day.where("data_particao = DATE '2024-01-05'").withColumn("ciclo", F.lit(2)), at, ["data_particao"])
    return t.spark.read.parquet(at).groupBy("data_particao", "ciclo").agg(F.count(F.lit(1)).alias("n"))


@query("s20_export_delimited", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, 'pt_BR' AS \"LOCALE\" FROM customer")
def _(t):
    at = scratch_path(t.spark, "export")
    io.export_delimited(t.customer, ["c_custkey", "c_name"], {"LOCALE": "pt_BR"}, path=at)
    return io.read_text_csv(t.spark, at, ";")


@query("s21_audit_log", """SELECT o_orderkey, '{"o_orderstatus":"' || o_orderstatus || '","nada":null}' AS dados, TIMESTAMP '2024-02-01 12:00:00' AS run_ts, 'iptu' AS campanha FROM orders""")
def _(t):
    o = t.orders.select("o_orderkey", "o_orderstatus", F.lit(None).cast("string").alias("nada"))
    return io.audit_log(o, ["o_orderkey"], RUN, "iptu").withColumn("run_ts", F.col("run_ts").cast("timestamp_ntz"))


@query("s22_rolling_upsert", """
WITH alvo AS (SELECT event_id AS id, ts, 'velho' AS v FROM events WHERE event_id % 2 = 0 AND ts >= TIMESTAMP '2024-01-20'), novo AS (SELECT event_id AS id, ts, 'novo' AS v FROM events WHERE event_id % 3 = 0 AND ts >= TIMESTAMP '2024-01-25')
SELECT * FROM alvo WHERE id NOT IN (SELECT id FROM novo) UNION ALL SELECT * FROM novo""")
def _(t):
    e = t.events.select(F.col("event_id").alias("id"), "ts")
    new = e.where("id % 3 = 0 AND ts >= '2024-01-25'").withColumn("v", F.lit("novo"))
    target = e.where("id % 2 = 0").withColumn("v", F.lit("velho")).withColumn("ts", F.col("ts"))
    return rolling_upsert(target, new, ["id"], "ts", dt.datetime(2024, 1, 31), 11 * 24)


@query("s23_publish", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'velho' ELSE 'novo' END AS v FROM orders WHERE o_orderkey % 2 = 0")
def _(t):
    new, old = (t.orders.where(f"o_orderkey % {k} = 0").select("o_orderkey", F.lit(v).alias("v")) for k, v in ((2, "novo"), (4, "velho")))
    return publish(new, old, "o_orderkey", "incremental")


@query("s24_media_catalog", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'pdf' ELSE 'other' END AS tipo, sha1(CASE WHEN doc_id % 2 = 0 THEN '%PDF' ELSE '' END || text) AS sha1, CAST(octet_length(encode(CASE WHEN doc_id % 2 = 0 THEN '%PDF' ELSE '' END || text)) AS INTEGER) AS bytes FROM documents WHERE sha1(CASE WHEN doc_id % 2 = 0 THEN '%PDF' ELSE '' END || text) NOT IN (SELECT sha1(text) FROM documents WHERE doc_id % 5 = 0)")
def _(t):
    body = F.concat(F.when(F.col("doc_id") % 2 == 0, "%PDF").otherwise(""), F.col("text"))
    media = t.documents.select("doc_id", F.concat(F.lit("data:x;base64,"), F.base64(body.cast("binary"))).alias("b64"))
    known = t.documents.where("doc_id % 5 = 0").select(F.sha1(F.col("text").cast("binary")).alias("sha1"))
    return io.media_catalog(media, "b64", known).select("doc_id", "tipo", "sha1", "bytes")


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
COLUMNS = f"""(SELECT DISTINCT table_name AS tabela, column_name AS coluna, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE data_type END AS tipo,
column_index FROM duckdb_columns() WHERE table_name IN {TABLES})"""


MEASURED = " UNION ALL ".join(f"SELECT '{n}' AS tabela, coluna, cheios, (SELECT count(*) FROM {n}) AS linhas FROM (UNPIVOT (SELECT count(COLUMNS('(.*)')) AS '\\1' FROM {n}) ON COLUMNS(*) INTO NAME coluna VALUE cheios)" for n in TABLES)


@query("s25_catalog", f"""WITH m AS ({MEASURED}), c AS (SELECT tabela, coluna, tipo, CAST(row_number() OVER (PARTITION BY tabela ORDER BY column_index) - 1 AS INTEGER) AS posicao, '' AS descricao FROM {COLUMNS})
SELECT c.*, linhas, 1 - cheios / linhas AS parte_nula FROM c JOIN m USING (tabela, coluna)""")
def _(t):
    """All columns of all tables with their rows and shares of nulls."""
    return io.measured_catalog({n: getattr(t, n) for n in TABLES})


@query("s25_catalog_documents", f"""SELECT 'base' AS conjunto, tabela, '{{' || string_agg('"' || coluna || '":{{"description":"","type":"' || tipo || '"}}', ',' ORDER BY coluna) || '}}' AS colunas FROM {COLUMNS} GROUP BY tabela""")
def _(t):
    documents = io.catalog_documents(io.catalog({n: getattr(t, n) for n in TABLES}), "base")
    return documents.select("conjunto", F.inline("tabelas")).withColumnsRenamed({"name": "tabela", "schema": "colunas"})


@query("s26_empty_guard", "SELECT 0 AS n FROM (SELECT count(*) AS n FROM orders WHERE o_orderkey < 0) WHERE n = 0")
def _(t):
    at = scratch_path(t.spark, "empty")
    io.write_partitioned(t.orders.where("o_orderkey < 0"), at, "o_orderdate")
    schema = io.with_partitions(t.orders, "o_orderdate").schema
    return t.spark.read.schema(schema).parquet(at).agg(F.count(F.lit(1)).cast("int").alias("n"))
