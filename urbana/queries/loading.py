"""Queries of incremental loading (M) and of versioned layouts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from urbana.operators import incremental as inc
from urbana.operators import select
from urbana.plans import layout
from urbana.queries.base import query
from urbana.queries.sources import registry_lines
from urbana.session import scratch_path


UPSERTED = """
WITH alvo AS (SELECT CASE WHEN c_custkey % 100 <> 1 THEN c_custkey END AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 2 = 0 OR c_custkey = 1), novo AS (SELECT nullif(c_custkey, 1) AS k, 'novo' AS v FROM customer WHERE c_custkey % 3 = 0 OR c_custkey = 1)
SELECT * FROM alvo a WHERE NOT EXISTS (SELECT 1 FROM novo n WHERE n.k IS NOT DISTINCT FROM a.k) UNION ALL SELECT * FROM novo"""


@query("m01_upsert", UPSERTED)
def _(t):
    target, source = _upsert_sides(t)
    return inc.upsert(target, source, ["k"])


def _upsert_sides(t):
    target = t.customer.where("c_custkey % 2 = 0 OR c_custkey = 1").select(F.when(F.col("c_custkey") % 100 != 1, F.col("c_custkey")).alias("k"), F.col("c_mktsegment").alias("v"))
    source = t.customer.where("c_custkey % 3 = 0 OR c_custkey = 1").select(F.nullif(F.col("c_custkey"), F.lit(1)).alias("k"), F.lit("novo").alias("v"))
    return target, source


@query("s19_stage_and_upsert", UPSERTED)
def _(t):
    """A staging table loaded twice, then merged twice into a stored table: the second time changes nothing."""
    target, source = _upsert_sides(t)
    at, staging = scratch_path(t.spark, "stored"), scratch_path(t.spark, "staging")
    inc.store(target, at, ["k"], 16)
    inc.stage(target, staging)
    staged = inc.stage(source, staging)
    for _ in range(2):
        inc.upsert_stored(t.spark, at, staged, ["k"], 16)
    return t.spark.read.parquet(at).select("k", "v")


@query("m02_delete_where", "SELECT event_id FROM events WHERE NOT (event_type LIKE 'c%' AND ts < TIMESTAMP '2024-01-15')")
def _(t):
    return inc.delete_where(t.events, F.col("event_type").startswith("c") & (F.col("ts") < "2024-01-15")).select("event_id")


@query("m03_high_water", "SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')")
def _(t):
    mark = inc.high_water(t.events.where("ts < '2024-01-20'"), "ts")
    return inc.after_mark(t.events.select("event_id", "ts"), mark, "ts")


@query("m03_high_water_per_group", "SELECT event_type, max(ts) AS marca FROM events GROUP BY 1")
def _(t):
    return inc.high_water(t.events, "ts", ["event_type"])


@query("m04_append_assignment", """
WITH h AS (SELECT c_custkey, CAST(0 AS BIGINT) AS grupo FROM customer WHERE c_custkey % 10 = 0), r AS (SELECT c_custkey, row_number() OVER (ORDER BY md5(c_custkey || 'm4'), c_custkey) AS rank FROM customer)
SELECT * FROM h UNION ALL SELECT c_custkey, CAST(ceil((sqrt(22500 + 200 * rank) - 150) / 100) AS BIGINT) FROM r WHERE c_custkey % 10 <> 0""")
def _(t):
    history = t.customer.where("c_custkey % 10 = 0").select("c_custkey", F.lit(0).cast("long").alias("grupo"))
    assigned = select.escalating_groups(select.seeded_order(t.customer.select("c_custkey"), "c_custkey", "m4"))
    return inc.append_assignment(history, assigned, "c_custkey")


LAYOUT = [
    {"version": "7", "reg": r, "posicao": p, "tamanho": n, "column": c} | more
    for r in ("01", "02")
    for p, n, c, more in (
        (1, 18, "nome", {}), (19, 8, "id", {"bigquery_type": "INT64"}), (27, 11, "saldo", {"bigquery_type": "FLOAT64", "ajuste_decimal": 2}),
        (40, 8, "data", {"bigquery_type": "DATE", "date_format": "ddMMyyyy"}), (48, 1, "segmento", {"dicionario_atributos": {"A": "auto", "B": "obra"}}),
    )
] + [{"version": "8", "reg": "01", "posicao": 1, "tamanho": 18, "column": "nome"}, {"version": "8", "reg": "01", "posicao": 19, "tamanho": 8, "column": "id", "bigquery_type": "INT64"}]

DECODED = """SELECT c_name AS nome, c_custkey AS id, round(abs(round(c_acctbal * 100)) / 100, 2) AS saldo, CASE WHEN c_custkey % 5 <> 0 THEN CAST(DATE '2020-01-01' + CAST(c_custkey % 300 AS INTEGER) AS DATE) END AS data,
c_mktsegment[1] AS segmento, CASE c_mktsegment[1] WHEN 'A' THEN 'auto' WHEN 'B' THEN 'obra' END AS segmento_descricao, '7' AS versao_layout_particao FROM customer"""


@query("f34_decode_field", f"SELECT nome, id, saldo, data, segmento, segmento_descricao, versao_layout_particao FROM ({DECODED}) WHERE id % 2 = 0")
def _(t):
    return layout.decode(registry_lines(t, "7"), LAYOUT, "7")["01"].withColumn("saldo", F.round("saldo", 2))


@query("g16_decode_all_records", f"SELECT CASE WHEN id % 2 = 0 THEN '01' ELSE '02' END AS reg, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids, count(data) AS datas, count(segmento_descricao) AS rotulos FROM ({DECODED}) GROUP BY 1")
def _(t):
    parts = layout.decode(registry_lines(t, "7"), LAYOUT, "7")
    each = [d.agg(F.lit(r).alias("reg"), F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"), F.count("data").alias("datas"), F.count("segmento_descricao").alias("rotulos")) for r, d in parts.items()]
    return layout.union_versions(each)


LAYOUT_TABLE = "version string, reg string, posicao int, tamanho int, column string, bigquery_type string, date_format string, ajuste_decimal int, dicionario_atributos map<string, string>"


def _layout_table(t):
    """Six records of two versions as a table: version 8 moves the segment, has a nation, and lacks the balance of the later records."""
    rows = []
    for reg in (f"0{i}" for i in range(1, 7)):
        for v, at in (("7", 48), ("8", 50)):
            rows += [(v, reg, 1, 18, "nome", None, None, None, None), (v, reg, 19, 8, "id", "INT64", None, None, None), (v, reg, 40, 8, "data", "DATE", "ddMMyyyy", None, None), (v, reg, at, 1, "segmento", None, None, None, {"A": "auto", "B": "obra"})]
            if v == "8":
                rows.append((v, reg, 48, 2, "nacao", "INT64", None, None, None))
            if v == "7" or reg < "04":
                rows.append((v, reg, 27, 11, "saldo", "FLOAT64", None, 2, None))
    return t.spark.createDataFrame(rows, LAYOUT_TABLE)


def _lines_of_versions(t):
    """Customers as lines of six records; a version is what the header of its file says."""
    cents = F.lpad(F.abs(F.round(F.col("c_acctbal") * 100)).cast("bigint").cast("string"), 11, "0")
    day = F.when(F.col("c_custkey") % 5 == 0, " " * 8).otherwise(F.date_format(F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("c_custkey").cast("int") % 300), "ddMMyyyy"))
    version = F.when(F.col("c_custkey") % 4 < 2, "7").otherwise("8")
    nation = F.when(version == "8", F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).otherwise("")
    text = F.concat(F.rpad("c_name", 18, " "), F.lpad(F.col("c_custkey").cast("string"), 8, " "), cents, F.lpad((F.col("c_custkey") % 6 + 1).cast("string"), 2, "0"), day, nation, F.substring("c_mktsegment", 1, 1))
    return t.customer.select(text.alias("text"), version.alias("versao"))


_BOTH = """SELECT '0' || (c_custkey % 6 + 1) AS reg, CASE WHEN c_custkey % 4 < 2 THEN '7' ELSE '8' END AS versao, c_name AS nome, c_custkey AS id,
CASE WHEN c_custkey % 5 <> 0 THEN CAST(DATE '2020-01-01' + CAST(c_custkey % 300 AS INTEGER) AS DATE) END AS data, c_mktsegment[1] AS segmento, CASE c_mktsegment[1] WHEN 'A' THEN 'auto' WHEN 'B' THEN 'obra' END AS segmento_descricao,
CASE WHEN c_custkey % 4 >= 2 THEN c_nationkey END AS nacao, CASE WHEN c_custkey % 4 < 2 OR c_custkey % 6 < 3 THEN abs(round(c_acctbal * 100)) / 100 END AS saldo FROM customer"""


@query("g16_compiled_layout", f"SELECT reg, versao, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids, count(data) AS datas, max(data) AS ultima, count(segmento_descricao) AS rotulos, CAST(sum(nacao) AS BIGINT) AS nacoes, round(sum(saldo), 2) AS saldo FROM ({_BOTH}) GROUP BY 1, 2")
def _(t):
    """All records of both versions by expressions compiled from a layout table, in one scan."""
    d = layout.decode_all(_lines_of_versions(t), _layout_table(t))
    field = lambda n: F.coalesce(*[F.col(f"r_0{i}.{n}") for i in range(1, 7)])
    return d.groupBy("reg", "versao").agg(
        F.count(F.lit(1)).alias("n"), F.sum(field("id")).alias("ids"), F.count(field("data")).alias("datas"), F.max(field("data")).alias("ultima"), F.count(field("segmento_descricao")).alias("rotulos"),
        F.sum(field("nacao")).alias("nacoes"), F.round(F.sum(field("saldo")), 2).alias("saldo"),
    )


@query("g16_records_by_code", f"SELECT reg, nome, id, data, segmento, segmento_descricao, nacao, round(saldo, 2) AS saldo, versao AS versao_layout_particao FROM ({_BOTH}) WHERE reg IN ('02', '05')")
def _(t):
    """Written by code in one pass; two of the records read back."""
    at = scratch_path(t.spark, "records")
    layout.write_records(layout.decode_all(_lines_of_versions(t), _layout_table(t)), at)
    return layout.union_versions([layout.read_record(t.spark, at, r).withColumn("reg", F.lit(r)).withColumn("saldo", F.round("saldo", 2)) for r in ("02", "05")])


@query("g16_layout_check", """
WITH l AS (SELECT v || '/0' || r AS k FROM unnest(['7', '8']) AS a(v), unnest(range(1, 7)) AS b(r)),
f AS (SELECT DISTINCT CASE WHEN c_custkey % 4 < 2 THEN '7' ELSE '8' END || '/0' || (c_custkey % 6 + 1) AS k FROM customer WHERE c_custkey % 6 <> 3)
SELECT coalesce(l.k, f.k) AS chave, CASE WHEN l.k IS NULL THEN 'right' ELSE 'left' END AS side FROM l FULL JOIN f ON l.k = f.k WHERE l.k IS NULL OR f.k IS NULL""")
def _(t):
    """Records that only the layout table or only the lines have."""
    return layout.unmatched(_lines_of_versions(t).where("substring(text, 38, 2) <> '04'"), _layout_table(t))


@query("u05_union_versions", f"SELECT * FROM ({DECODED}) WHERE id % 2 = 0 UNION ALL SELECT nome, id, NULL, NULL, NULL, NULL, '8' FROM ({DECODED}) WHERE id % 2 = 0")
def _(t):
    v7, v8 = (layout.decode(registry_lines(t, v), LAYOUT, v)["01"] for v in ("7", "8"))
    return layout.union_versions([v7.withColumn("saldo", F.round("saldo", 2)), v8])
