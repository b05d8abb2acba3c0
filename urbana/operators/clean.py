"""Conforming, cleaning and checking tables."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbana.functions.text import MARKED, PLAIN


def conform(df: DataFrame, schema: T.StructType, rename: dict[str, str] | None = None) -> DataFrame:
    """The columns of a target schema: renamed, cast with nulls for what does not fit, missing ones null, in order."""
    df = df.withColumnsRenamed(rename or {})
    return df.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def null_if_in(df: DataFrame, values: list, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.when(~F.col(c).isin(values), F.col(c)) for c in cols})


def to_number(df: DataFrame, cols: list[str]) -> DataFrame:
    """Numbers where the text is one, else null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def nonnegative(df: DataFrame, cols: list[str]) -> DataFrame:
    """What is no number, null or negative becomes 0."""
    return df.withColumns({c: F.greatest(F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)), F.lit(0.0)) for c in cols})


def within_limit(df: DataFrame, col: str, most: float, keep_null: bool = True) -> DataFrame:
    ok = F.col(col) <= most
    return df.where(F.col(col).isNull() | ok if keep_null else ok)


def drop_all_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(how="all", subset=cols)


def run_window(df: DataFrame, col: str, start: dt.date | None = None, end: dt.date | None = None, today: dt.date | None = None) -> DataFrame:
    """Rows of a date range, both ends included; without one, those of today."""
    today = today or dt.datetime.now(dt.timezone.utc).date()
    lo, hi = start or today, end or start and today or today
    return df.where((F.col(col) >= F.lit(lo)) & (F.col(col) < F.lit(hi + dt.timedelta(days=1))))


def recent_or_undated(df: DataFrame, col: str, days: int, today: dt.date) -> DataFrame:
    """Rows of the last days or without a date; ``data_particao`` is their date, else the run's."""
    day = F.to_date(F.col(col))
    return df.where(day.isNull() | (day >= F.date_sub(F.lit(today), days))).withColumn("data_particao", F.coalesce(day, F.lit(today)))


def since(df: DataFrame, ts: str, partition: str, bound: dt.date) -> DataFrame:
    """A time bound, said also of the date folder, so that folders are pruned."""
    return df.where((F.col(ts) >= F.lit(bound)) & (F.col(partition) >= F.lit(bound)))


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Structs at any depth as columns named by their path."""

    def leaves(fields, path):
        for f in fields:
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType.fields, [*path, f.name])
            else:
                yield F.col(".".join(f"`{p}`" for p in [*path, f.name])).alias(sep.join([*path, f.name]))

    return df.select(*leaves(df.schema.fields, []))


def coalesce_structs(a: str, b: str, field: str) -> Column:
    """A field of one struct, else of the other."""
    return F.coalesce(F.col(f"{a}.{field}"), F.col(f"{b}.{field}"))


def normalize_keys(c: Column, mapping: dict[str, str]) -> Column:
    """Map keys in lower case, some renamed."""
    low = F.transform_keys(c, lambda k, v: F.lower(k))
    if not mapping:
        return low
    names = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.transform_keys(low, lambda k, v: F.coalesce(names[k], k))


def by_role(df: DataFrame, roles: dict[str, list[str]]) -> DataFrame:
    """For each role the first of its candidate columns that is there, named by the role."""
    chosen = {r: next((c for c in cs if c in df.columns), None) for r, cs in roles.items()}
    return df.select(*[F.col(c).alias(r) for r, c in chosen.items() if c])


def validate(df: DataFrame, rules: dict[str, Column], required: list[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(good rows, bad rows with their ``errors``, one row of counts). Raises if a required column is not there."""
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    errors = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]), lambda x: x.isNotNull())
    marked = df.withColumn("errors", errors)
    stats = marked.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.size("errors") == 0).alias("valid"), F.count_if(F.size("errors") > 0).alias("invalid")
    ).withColumn("success_rate", F.when(F.col("total") > 0, F.round(F.col("valid") / F.col("total"), 6)).otherwise(0.0))
    return marked.where(F.size("errors") == 0).drop("errors"), marked.where(F.size("errors") > 0), stats


def assert_error_rate(stats: DataFrame, most: float = 0.05) -> None:
    """Raises if the share of bad rows in the one row of counts is over the limit."""
    r = stats.first()
    if r["total"] and r["invalid"] / r["total"] > most:
        raise ValueError(f"{r['invalid']} of {r['total']} rows are bad; the limit is {most:.0%}")


def gate(control: DataFrame, condition: Column) -> bool:
    """Whether a control table has a row that allows the run."""
    return bool(control.where(condition).limit(1).count())


def gated(df: DataFrame, open_: bool) -> DataFrame:
    """The frame, or its empty likeness, which is planned without any scan."""
    return df if open_ else df.where(F.lit(False))


def snake(name: str) -> str:
    plain = name.translate(str.maketrans(MARKED, PLAIN)).lower()
    return re.sub(r"_+", "_", re.sub(r"[^a-z0-9]", "_", plain)).strip("_")


def snake_names(df: DataFrame) -> DataFrame:
    """Column names without accents, in lower case, with single underscores; repeats are numbered."""
    names: list[str] = []
    for c in df.columns:
        n, base, k = snake(c), snake(c), 2
        while n in names:
            n, k = f"{base}_{k}", k + 1
        names.append(n)
    return df.toDF(*names)


def pick_identifier(df: DataFrame, names: list[str]) -> str | None:
    """The first preferred column that is there, whatever its case."""
    there = {c.lower(): c for c in df.columns}
    return next((there[n.lower()] for n in names if n.lower() in there), None)


def json_complex(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text."""
    deep = (T.ArrayType, T.MapType, T.StructType)
    return df.withColumns({f.name: F.to_json(f.name) for f in df.schema if isinstance(f.dataType, deep)})


def row_hash(df: DataFrame, cols: list[str] | None = None) -> Column:
    """md5 of a row as JSON with sorted keys, nulls included."""
    return F.md5(F.to_json(F.struct(*sorted(cols or df.columns)), {"ignoreNullFields": "false"}))


def records_to_json(df: DataFrame, key: str | None = None) -> DataFrame:
    """Each row as JSON text in ``content``, beside an optional key."""
    body = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("content")
    return df.select(*([key] if key else []), body)
