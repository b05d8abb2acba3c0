"""Phone numbers as column expressions.

A number is formatted as ``55`` + two-digit area + subscriber number. A mobile has nine subscriber digits that start
with 9; a landline has eight. The area is 11 to 99. Anything else is null.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from urbana.functions.text import digits

PLACEHOLDER = "21999999999"
# Patterns of national numbers, for the column functions and the SQL functions alike.
MOBILE = "^[1-9][1-9]9[0-9]{8}$"
ANY = "^[1-9][1-9](9[0-9]{8}|[2-5][0-9]{7})$"


def _national(c: Column) -> Column:
    d = F.regexp_replace(digits(c), r"^0+", "")
    return F.when(d.startswith("55") & F.length(d).isin(12, 13), F.substring(d, 3, 11)).otherwise(d)


def format_cellphone(c: Column) -> Column:
    """``55`` + area + nine digits for a valid mobile, else null."""
    n = _national(c)
    return F.when(n.rlike(MOBILE), F.concat(F.lit("55"), n))


def format_phone(c: Column) -> Column:
    """A valid mobile or landline with ``55``, else null."""
    n = _national(c)
    return F.when(n.rlike(ANY), F.concat(F.lit("55"), n))


def first_valid(*cs: Column) -> Column:
    """The first candidate that is a valid mobile, formatted."""
    return F.coalesce(*[format_cellphone(c) for c in cs])


def add_ninth_digit(c: Column) -> Column:
    """12-character numbers get a 9 after the fourth; others stay."""
    return F.when(F.length(c) == 12, F.concat(F.substring(c, 1, 4), F.lit("9"), F.substring(c, 5, 8))).otherwise(c)


def both_spellings(c: Column) -> Column:
    """A number with and without the ninth digit, each once."""
    without = F.when((F.length(c) == 13) & (F.substring(c, 5, 1) == "9"), F.concat(F.substring(c, 1, 4), F.substring(c, 6, 8))).otherwise(c)
    return F.array_distinct(F.array(add_ninth_digit(c), without))


def mobiles(*cs: Column) -> Column:
    """The different 11-digit mobiles among several texts, in order; the placeholder is none."""
    return F.array_distinct(F.filter(F.transform(F.array(*cs), digits), lambda x: x.rlike(r"^[0-9]{2}9[0-9]{8}$") & (x != PLACEHOLDER)))


def int_text(c: Column) -> Column:
    """A number written as a float, as digits."""
    return c.try_cast("double").try_cast("bigint").cast("string")


def display_phone(c: Column) -> Column:
    """``(21) 2345-6789`` or ``(21) 92345-6789`` by length, else as it is."""
    area = F.concat(F.lit("("), F.substring(c, 1, 2), F.lit(") "))
    ten = F.concat(area, F.substring(c, 3, 4), F.lit("-"), F.substring(c, 7, 4))
    eleven = F.concat(area, F.substring(c, 3, 5), F.lit("-"), F.substring(c, 8, 4))
    return F.when(F.length(c) == 10, ten).when(F.length(c) == 11, eleven).otherwise(c)


def alternates(phones: Column, chosen: Column) -> Column:
    """The other phones without nulls; a null choice empties the array."""
    return F.filter(phones, lambda x: F.coalesce(x.isNotNull() & (x != chosen), F.lit(False)))


def register(spark: SparkSession) -> None:
    """SQL functions that Catalyst inlines: the column functions of these modules, and business days as a table."""
    national = "WHEN startswith({0}, '55') AND length({0}) IN (12, 13) THEN substring({0}, 3, 11) ELSE {0} END".format("regexp_replace(regexp_replace(x, '[^0-9]', ''), '^0+', '')")
    for text in (
        f"national_number(x STRING) RETURNS STRING RETURN CASE {national}",
        f"cellphone(x STRING) RETURNS STRING RETURN CASE WHEN national_number(x) RLIKE '{MOBILE}' THEN '55' || national_number(x) END",
        f"phone(x STRING) RETURNS STRING RETURN CASE WHEN national_number(x) RLIKE '{ANY}' THEN '55' || national_number(x) END",
        "short_name(x STRING) RETURNS STRING RETURN initcap(CASE WHEN size(split(x, ' ')) > 1 THEN concat(get(split(x, ' '), 0), ' ', element_at(split(x, ' '), -1)) ELSE x END)",
        "ninth_digit(x STRING) RETURNS STRING RETURN CASE WHEN length(x) = 12 THEN substring(x, 1, 4) || '9' || substring(x, 5, 8) ELSE x END",
        "calendar_years(a DATE, b DATE) RETURNS INT RETURN year(b) - year(a)",
        "haversine_m(la DOUBLE, lo DOUBLE, lb DOUBLE, lp DOUBLE) RETURNS DOUBLE RETURN 2 * 6371000 * asin(sqrt(pow(sin(radians(lb - la) / 2), 2) + cos(radians(la)) * cos(radians(lb)) * pow(sin(radians(lp - lo) / 2), 2)))",
        "business_days(a DATE, b DATE, holidays ARRAY<DATE>) RETURNS TABLE (dia DATE, n INT) RETURN "
        "SELECT CAST(d AS DATE) AS dia, CAST(row_number() OVER (ORDER BY d) AS INT) AS n FROM (SELECT explode(CASE WHEN a <= b THEN sequence(a, b) END) AS d) WHERE weekday(d) < 5 AND NOT array_contains(holidays, d)",
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {text}")
