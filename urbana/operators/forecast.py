"""Forecast documents as tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbana.session import cut

# The attributes and elements of a forecast document.
DOCUMENT = (
    "_Createdate STRING, previsao ARRAY<STRUCT<_datePeriodo: STRING, _periodo: STRING, _ceu: STRING, _precipitacao: STRING, _dirVento: STRING, _velVento: STRING, _temperatura: STRING>>, "
    "quadroSinotico STRUCT<_sinotico: STRING, _VALUE: STRING>, Temperatura STRUCT<_data: STRING, Zona: ARRAY<STRUCT<_zona: STRING, _minima: STRING, _maxima: STRING>>>, "
    "TabuasMares STRUCT<tabua: ARRAY<STRUCT<_elevacao: STRING, _date: STRING, _altura: STRING>>>"
)
# with what each form holds for certain: other texts are not tried, as a failed parse costs many times one that succeeds
TIDE_TIMES = {"yyyy-MM-dd'T'HH:mm:ss": "%-%-%t%", "yyyy-MM-dd HH:mm:ss": "%-%-% %", "dd/MM/yyyy HH:mm:ss": "%/%/% %"}


def forecast_tables(docs: DataFrame, run: dt.datetime, run_id: Column | None = None) -> dict[str, DataFrame]:
    """``periodo``, ``zona``, ``mare`` and ``sinotico`` of forecast documents; a document's rows share one run id.

    The id is a hash of the document and the run unless given. A missing or unreadable creation time is the run's, a tide time
    of no known form is null, a missing synopsis is an empty text, and absent sections give no rows. Documents are parsed once: what is
    read from them is stored in the shared folder, and each table is made of that.
    """
    now = F.lit(run).cast("timestamp_ntz")
    made = F.coalesce(F.try_to_timestamp("_Createdate").cast("timestamp_ntz"), now)
    ident = F.md5(F.to_json(F.struct(*docs.columns, now.alias("run")))) if run_id is None else run_id
    d = cut(docs.select(*docs.columns, ident.alias("id_execucao"), now.cast("date").alias("data_execucao"), F.date_format(now, "HH:mm:ss").alias("hora_execucao"), made.alias("data_alertario")))
    run_columns = ["id_execucao", "data_execucao", "hora_execucao", "data_alertario"]

    def rows(section: str, *cols: Column) -> DataFrame:
        each = d.select(*run_columns, F.coalesce("Temperatura._data", F.date_format("data_alertario", "yyyy-MM-dd")).alias("__day"), F.explode(section).alias("x"))
        return each.select(*run_columns, *cols, F.col("data_execucao").alias("data_particao"))

    def x(*names: str) -> list[Column]:
        return [F.col(f"x._{a}").alias(b) for a, b in (n.split(":") for n in names)]

    def number(a: str, b: str) -> Column:
        return F.col(f"x._{a}").try_cast("double").alias(b)

    when = F.coalesce(*[F.when(F.lower("x._date").like(has), F.try_to_timestamp("x._date", F.lit(f))) for f, has in TIDE_TIMES.items()]).cast("timestamp_ntz").alias("data_hora")
    words = F.coalesce(F.nullif("quadroSinotico._sinotico", F.lit("")), "quadroSinotico._VALUE", F.lit("")).alias("sinotico")
    return {
        "periodo": rows("previsao", F.to_date("x._datePeriodo", "yyyy-MM-dd").alias("data_periodo"), *x("periodo:periodo", "ceu:ceu", "precipitacao:precipitacao", "dirVento:dir_vento", "velVento:vel_vento", "temperatura:temperatura")),
        "zona": rows("Temperatura.Zona", *x("zona:zona"), number("minima", "temp_minima"), number("maxima", "temp_maxima"), F.col("__day").alias("data_temperatura")),
        "mare": rows("TabuasMares.tabua", when, *x("elevacao:elevacao"), number("altura", "altura")),
        "sinotico": d.select(*run_columns, words, F.col("data_execucao").alias("data_particao")),
    }
