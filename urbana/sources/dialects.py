"""Dates and times as literals of the databases that extracts read, and the predicates made of them."""

from __future__ import annotations

import datetime as dt
import re

#: Literals of a day and of a time, by the name in a JDBC url; ``spark`` is for predicates over DataFrames.
LITERALS = {
    "sqlserver": ("CONVERT(DATE, '{}', 23)", "CONVERT(DATETIME2, '{}', 120)"),
    "oracle": ("DATE '{}'", "TIMESTAMP '{}'"),
    "mysql": ("DATE '{}'", "TIMESTAMP '{}'"),
    "postgresql": ("DATE '{}'", "TIMESTAMP '{}'"),
    "derby": ("DATE('{}')", "TIMESTAMP('{}')"),
    "spark": ("DATE '{}'", "TIMESTAMP_NTZ '{}'"),
}


def dialect(url: str) -> str:
    """The database of a JDBC url."""
    found = re.match(r"jdbc:([a-z0-9]+):", url)
    if not found or found[1] not in LITERALS:
        raise ValueError(f"no date literals known for {url.split('//')[0]}")
    return found[1]


def literal(value: dt.date | dt.datetime | str, of: str) -> str:
    """A day or a time as a literal; an ISO text is a day if it has no time of day. Anything else is an error, so no text gets into a query."""
    if isinstance(value, str):
        value = dt.date.fromisoformat(value) if len(value) <= 10 else dt.datetime.fromisoformat(value)
    timed = isinstance(value, dt.datetime)
    return LITERALS[of][timed].format(value.strftime("%Y-%m-%d %H:%M:%S") if timed else value.isoformat())


def window(column: str, start: dt.date, end: dt.date, of: str) -> str:
    """The rows from a day to before another."""
    return f"{column} >= {literal(start, of)} AND {column} < {literal(end, of)}"


def lower_bound(column: str, value: dt.date | dt.datetime | str, of: str, strict: bool = False) -> str:
    """The rows from a day or time on, or (``strict``) after it."""
    return f"{column} {'>' if strict else '>='} {literal(value, of)}"
