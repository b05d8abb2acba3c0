"""Fixed-width records decoded by their layout."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbana.operators.joins import compare_keys
from urbana.operators.select import version_matrix


def decode_field(row: dict, text: str = "text") -> list[Column]:
    """The column of a layout row, and its label column where the row has a dictionary.

    Blank is null. ``bigquery_type``: STRING, INT64, DATE (by ``date_format``), FLOAT64 (divided by 10 ** ``ajuste_decimal``).
    """
    raw = F.substring(text, row["posicao"], row["tamanho"])
    value = F.when(~raw.rlike(r"^\s*$"), F.trim(raw))
    kind = row.get("bigquery_type") or "STRING"
    out = {"STRING": lambda: value, "INT64": lambda: value.try_cast("bigint"), "DATE": lambda: F.try_to_date(value, row["date_format"]), "FLOAT64": lambda: value.try_cast("double") / 10 ** (row.get("ajuste_decimal") or 0)}[kind]()
    columns = [out.alias(row["column"])]
    if codes := row.get("dicionario_atributos"):
        label = F.lit(None).cast("string")
        for code, name in codes.items():
            label = F.when(value == code, name).otherwise(label)
        columns.append(label.alias(f"{row['column']}_descricao"))
    return columns


def decode(df: DataFrame, layout: list[dict], version: str, text: str = "text") -> dict[str, DataFrame]:
    """For each record code (characters 38 and 39) of a version its lines as typed columns."""
    by_code: dict[str, list[dict]] = {}
    for row in layout:
        if row["version"] == version:
            by_code.setdefault(row["reg"], []).append(row)
    return {reg: df.where(F.substring(text, 38, 2) == reg).select(*[c for r in rows for c in decode_field(r, text)], F.lit(version).alias("versao_layout_particao")) for reg, rows in by_code.items()}


def union_versions(dfs: list[DataFrame]) -> DataFrame:
    """Versions of one record as one table, absent columns null."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


# --- layouts compiled from a table -------------------------------------------------------------------

LARGEST = 100_000  # rows of a layout table


def compiled(layout: DataFrame, text: str = "text", version: str = "versao") -> dict[str, Column]:
    """For each record code of a layout table its record as one struct column, of lines of all versions.

    ``layout(version, reg, posicao, tamanho, column, ...)`` has a row for each field (see ``decode_field``), at most ``LARGEST`` in all, which are collected to build
    the expressions. A field that a version lacks is null in its lines; one whose type differs between versions is text.
    """
    rows = [r.asDict() for r in layout.limit(LARGEST + 1).collect()]
    if len(rows) > LARGEST:
        raise ValueError(f"a layout table of over {LARGEST} rows")
    made: dict[str, dict[str, list[tuple[str, str, Column]]]] = {}
    for row in sorted(rows, key=lambda r: (r["reg"], r["version"], r["posicao"])):
        names = [row["column"], f"{row['column']}_descricao"]
        kinds = [row.get("bigquery_type") or "STRING", "STRING"]
        for name, kind, column in zip(names, kinds, decode_field(row, text), strict=False):
            made.setdefault(row["reg"], {}).setdefault(name, []).append((row["version"], kind, column))
    records = {}
    for reg, fields in made.items():
        columns = []
        for name, versions in fields.items():
            mixed = len({kind for _, kind, _ in versions}) > 1
            value = F.lit(None)
            for v, _, column in versions:
                value = F.when(F.col(version) == v, column.cast("string") if mixed else column).otherwise(value)
            columns.append(value.alias(name))
        known = F.col(version).isin(sorted({v for f in fields.values() for v, _, _ in f}))
        records[reg] = F.when((F.substring(text, 38, 2) == reg) & known, F.struct(*columns, F.col(version).alias("versao_layout_particao")))
    return records


def decode_all(lines: DataFrame, layout: DataFrame, text: str = "text", version: str = "versao") -> DataFrame:
    """``(reg, versao, r_<code>, ...)``: every line once, as the struct of its record; the others are null. One scan, whatever the number of records and versions."""
    records = compiled(layout, text, version)
    return lines.select(F.substring(text, 38, 2).alias("reg"), F.col(version).alias("versao"), *[c.alias(f"r_{reg}") for reg, c in records.items()])


def write_records(decoded: DataFrame, folder: str) -> None:
    """Decoded lines, in a folder for each record code: one pass over the lines."""
    decoded.write.mode("overwrite").partitionBy("reg").parquet(folder)


def read_record(spark: SparkSession, folder: str, reg: str) -> DataFrame:
    """One record of a folder as a table; nothing of the others is read."""
    return spark.read.option("inferSchema", "false").parquet(folder).where(F.col("reg").cast("string").isin(reg, str(int(reg)) if reg.isdigit() else reg)).where(F.col(f"r_{reg}").isNotNull()).select(f"r_{reg}.*")


def unmatched(lines: DataFrame, layout: DataFrame, text: str = "text", version: str = "versao") -> DataFrame:
    """``(chave, side)``: records and versions that only the layout (``left``) or only the lines (``right``) have."""
    key = lambda reg, v: F.concat_ws("/", v, reg).alias("chave")
    return compare_keys(layout.select(key(F.col("reg"), F.col("version"))), lines.select(key(F.substring(text, 38, 2), F.col(version))), "chave")


def field_presence(layout: DataFrame) -> DataFrame:
    """For every version and field of a record, whether it is there, and whether it is in the version before and after."""
    return version_matrix(layout.select("reg", "version", "column"), "reg", "version", "column")
