"""Reading and writing: databases by windows, text, XML, HTML, fixed width, partitioned folders."""

from __future__ import annotations

import calendar
import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbana.sources import dialects

# --- databases ---------------------------------------------------------------------------------------


def resolve(word: str, today: dt.date) -> dt.date:
    """A date from an ISO text or a keyword such as ``current_month`` or ``previous_day``."""
    which, _, unit = word.partition("_")
    if which not in ("current", "previous"):
        return dt.date.fromisoformat(word)
    first = {"day": today, "month": today.replace(day=1), "year": today.replace(month=1, day=1)}[unit]
    if which == "current":
        return first
    before = first - dt.timedelta(days=1)
    return {"day": before, "month": before.replace(day=1), "year": before.replace(month=1, day=1)}[unit]


def windows(freq: str, start: dt.date, end: dt.date) -> list[tuple[dt.date, dt.date]]:
    """Half-open day, month or year windows that cover start to end, both included."""
    out, at = [], {"day": start, "month": start.replace(day=1), "year": start.replace(month=1, day=1)}[freq]
    while at <= end:
        days = {"day": 1, "month": calendar.monthrange(at.year, at.month)[1], "year": 366 if calendar.isleap(at.year) else 365}[freq]
        out.append((at, at + dt.timedelta(days=days)))
        at = out[-1][1]
    return out


def predicates(column: str, freq: str, start: str, end: str, today: dt.date, dialect: str = "spark", lower_bound: str | None = None, timed: bool = False) -> list[str]:
    """One SQL predicate for each window, in the words of a database. With a lower bound, windows that end before it are left out and the others keep to it.
    ``timed``: bounds are times of day, for databases that compare a column of times with nothing else."""
    spans = windows(freq, resolve(start, today), resolve(end, today))
    if timed:
        spans = [(dt.datetime.combine(a, dt.time()), dt.datetime.combine(b, dt.time())) for a, b in spans]
    if lower_bound is None:
        return [dialects.window(column, a, b, dialect) for a, b in spans]
    bound = dialects.lower_bound(column, lower_bound, dialect)
    return [f"({dialects.window(column, a, b, dialect)}) AND {bound}" for a, b in spans if b.isoformat() > lower_bound[:10]]


def read_windowed(spark: SparkSession, url: str, query: str, column: str, freq: str, start: str, end: str, today: dt.date | None = None, lower_bound: str | None = None, properties: dict | None = None, timed: bool = False) -> DataFrame:
    """A query of a database, one partition and one predicate for each window, in the dialect of the url; an empty result where the bound is after all windows."""
    preds = predicates(column, freq, start, end, today or dt.datetime.now(dt.timezone.utc).date(), dialects.dialect(url), lower_bound, timed)
    return spark.read.jdbc(url, f"({query}) q", predicates=preds or ["1 = 0"], properties={"fetchsize": "50000"} | (properties or {}))


def with_loaded_at(df: DataFrame, ts: dt.datetime) -> DataFrame:
    """One load time for the run."""
    return df.withColumn("loaded_at", F.lit(ts))


# --- text formats ------------------------------------------------------------------------------------


def read_text_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All columns as text; empty fields stay empty texts."""
    return spark.read.csv(path, header=True, inferSchema=False, sep=sep, emptyValue="").na.fill("")


def read_xml_rows(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str) -> DataFrame:
    """XML elements as rows; attributes are fields with a leading ``_``."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def folder_depth(text: Column) -> Column:
    """How deep the folders of a KML text lie in each other."""
    tags = F.regexp_extract_all(text, F.lit(r"<(/?)Folder(?:\s[^>]*[^/>]|\s)?>"), F.lit(1))
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(at: Column, closing: Column) -> Column:
        now = F.when(closing == "/", at["now"] - 1).otherwise(at["now"] + 1)
        return F.struct(now.alias("now"), F.greatest(at["most"], now).alias("most"))

    return F.aggregate(tags, zero, step, lambda at: at["most"])


def placemarks(df: DataFrame, text: str) -> DataFrame:
    """Placemarks of KML texts: ``(folder, name, coordinates, attributes)``; ``folder`` is the nearest one.

    The schema follows the deepest folder that occurs, so none is lost. Null texts have no placemarks.
    """
    depth = max(1, df.agg(F.max(folder_depth(F.col(text)))).first()[0] or 0)
    mark = "Placemark ARRAY<STRUCT<name STRING, Point: STRUCT<coordinates STRING>, ExtendedData: STRUCT<Data: ARRAY<STRUCT<_name STRING, value STRING>>>>>"
    node = f"STRUCT<name STRING, {mark}>"
    for _ in range(depth - 1):
        node = f"STRUCT<name STRING, {mark}, Folder ARRAY<{node}>>"
    schema = f"Document STRUCT<name STRING, {mark}, Folder ARRAY<{node}>>"
    level = df.select(F.from_xml(F.col(text), F.lit(schema))["Document"].alias("n"))
    found = []
    for k in range(depth + 1):
        found.append(level.select(F.col("n.name").alias("folder"), F.explode("n.Placemark").alias("p")))
        if k < depth:
            level = level.select(F.explode("n.Folder").alias("n"))
    every = functools.reduce(DataFrame.union, found)
    pairs = F.map_from_entries(F.transform("p.ExtendedData.Data", lambda d: F.struct(d["_name"], d["value"])))
    return every.select("folder", F.col("p.name").alias("name"), F.trim("p.Point.coordinates").alias("coordinates"), F.to_json(pairs).alias("attributes"))


def html_rows(df: DataFrame, html: str, pattern: str, keep: list[str]) -> DataFrame:
    """The first group of every match of a pattern, with its place from 0."""
    return df.select(*keep, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1))).alias("pos", "value"))


def decimal_point(c: Column) -> Column:
    """A number with a decimal comma."""
    return F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def read_family(spark: SparkSession, glob: str) -> DataFrame:
    """Tables of one name pattern as one; columns that some lack are null."""
    return spark.read.option("mergeSchema", "true").parquet(glob)


def read_fixed_width(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a fixed-width file in ``text``; large files are split by Spark."""
    return spark.read.text(path).withColumnRenamed("value", "text")


def header_info(df: DataFrame, text: str = "text") -> DataFrame:
    """Layout version (characters 70 to 74) and extraction date (83 to 90) of header lines (record code 00)."""
    head = df.where(F.substring(text, 38, 2) == "00")
    return head.select(F.trim(F.substring(text, 70, 5)).alias("versao_layout"), F.try_to_date(F.substring(text, 83, 8), "ddMMyyyy").alias("data_extracao"))


def pending_partitions(raw: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    return raw.select(key).distinct().join(loaded.select(key).distinct(), key, "left_anti")


# --- writing -----------------------------------------------------------------------------------------


def with_partitions(df: DataFrame, date_col: str, layout: str = "ymd", on_bad_date: str = "fail") -> DataFrame:
    """Folder columns from a date: ``ymd`` (year, month, date), ``date`` alone, or ``padded`` (year, 2-digit month and day)."""
    day = F.to_date(F.try_to_timestamp(F.col(date_col).cast("string")))
    if on_bad_date == "drop":
        df = df.where(day.isNotNull())
    else:
        day = F.when(day.isNull(), F.raise_error(F.concat(F.lit("bad partition date: "), F.coalesce(F.col(date_col).cast("string"), F.lit("null")))).cast("date")).otherwise(day)
    if layout == "date":
        return df.withColumn("data_particao", day)
    if layout == "padded":
        return df.withColumn("ano", F.date_format(day, "yyyy")).withColumn("mes", F.date_format(day, "MM")).withColumn("dia", F.date_format(day, "dd"))
    return df.withColumn("ano_particao", F.year(day)).withColumn("mes_particao", F.month(day)).withColumn("data_particao", day)


PARTITIONS = {"ymd": ["ano_particao", "mes_particao", "data_particao"], "date": ["data_particao"], "padded": ["ano", "mes", "dia"]}


def write_partitioned(df: DataFrame, path: str, date_col: str, layout: str = "ymd", mode: str = "append", on_bad_date: str = "fail") -> None:
    """Parquet in date folders. An empty frame writes no folder."""
    with_partitions(df, date_col, layout, on_bad_date).write.mode(mode).partitionBy(*PARTITIONS[layout]).parquet(path)


def replace_partitions(df: DataFrame, path: str, cols: list[str]) -> None:
    """Overwrite only the folders that the frame has rows for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)


def export_delimited(df: DataFrame, columns: list[str], constants: dict[str, str] | None = None, sep: str = ";", path: str | None = None) -> DataFrame:
    """Chosen columns and constants as text; written as a delimited file if a path is given."""
    out = df.select(*[F.col(c).cast("string").alias(c) for c in columns], *[F.lit(v).alias(k) for k, v in (constants or {}).items()])
    if path:
        out.write.mode("overwrite").option("sep", sep).option("header", True).csv(path)
    return out


def audit_log(df: DataFrame, fixed: list[str], run_ts: dt.datetime, campaign: str) -> DataFrame:
    """Fixed columns, and all others as one JSON text with its nulls."""
    others = [c for c in df.columns if c not in fixed]
    return df.select(*fixed, F.to_json(F.struct(*others), {"ignoreNullFields": "false"}).alias("dados"), F.lit(run_ts).alias("run_ts"), F.lit(campaign).alias("campanha"))


def media_catalog(df: DataFrame, col: str, existing: DataFrame | None = None) -> DataFrame:
    """Base64 media: type by its first bytes, address by SHA-1, size; known addresses and undecodable texts are left out."""
    raw = F.try_to_binary(F.regexp_replace(F.col(col), r"^data:[^,]*,", ""), F.lit("base64"))
    head = F.hex(F.substring(raw, 1, 8))
    kind = F.when(head.startswith("FFD8FF"), "jpeg").when(head.startswith("89504E47"), "png").when(head.startswith("47494638"), "gif").when(head.startswith("25504446"), "pdf").otherwise("other")
    out = df.withColumn("content", raw).where("content IS NOT NULL").withColumn("tipo", kind).withColumn("sha1", F.sha1("content")).withColumn("bytes", F.octet_length("content"))
    return out.join(existing.select("sha1"), "sha1", "left_anti") if existing is not None else out


def catalog(tables: dict[str, DataFrame]) -> DataFrame:
    """``(tabela, coluna, tipo, posicao, descricao)`` of several tables, from their schemas alone; a column's comment describes it."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(t, f.name, f.dataType.simpleString(), i, f.metadata.get("comment", "")) for t, df in tables.items() for i, f in enumerate(df.schema)]
    return spark.createDataFrame(rows, "tabela string, coluna string, tipo string, posicao int, descricao string")


def measured_catalog(tables: dict[str, DataFrame]) -> DataFrame:
    """``catalog`` with the rows of each table and, of each column, the share of nulls (null for a table without rows): one aggregate for each table."""
    counts = []
    for name, df in tables.items():
        columns = df.columns
        one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)])
        each = F.explode(F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(f"c{i}").alias("cheios")) for i, c in enumerate(columns)])).alias("c")
        counts.append(one.select(F.lit(name).alias("tabela"), F.col("n").alias("linhas"), each).select("tabela", "c.coluna", "linhas", (1 - F.try_divide("c.cheios", F.col("linhas"))).alias("parte_nula")))
    return catalog(tables).join(functools.reduce(DataFrame.unionByName, counts), ["tabela", "coluna"])


def catalog_documents(columns: DataFrame, dataset: str) -> DataFrame:
    """A data set's tables, each with its columns as a map from name to ``{description, type}``: ``(conjunto, tabelas)``, one row.

    Quotes around a description go; a missing one is an empty text.
    """
    told = F.regexp_replace(F.coalesce("descricao", F.lit("")), '^"|"$', "")
    entry = F.struct("coluna", F.struct(told.alias("description"), F.col("tipo").alias("type")).alias("como"))
    tables = columns.groupBy("tabela").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("schema"))
    listed = F.array_sort(F.collect_list(F.struct(F.col("tabela").alias("name"), F.to_json("schema").alias("schema"))))
    return tables.agg(listed.alias("tabelas")).select(F.lit(dataset).alias("conjunto"), "tabelas")
