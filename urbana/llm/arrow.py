"""Small helpers for Arrow-batched stages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


ROWS = 1000  # rows a worker turns into Python objects at once


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``ROWS`` rows."""
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS)


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    return [b"" if x is None else x for x in col.to_pylist()]


def with_columns(df: DataFrame, column: str, added: str, compute: Callable[[list[bytes]], list[pa.Array]], keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) and the columns of the DDL ``added``, computed batch by batch from one string column.

    A column of ``df`` with an added name is replaced.
    """
    new = T.StructType.fromDDL(added)
    kept = [c for c in (df.columns if keep is None else keep) if c not in new.names]
    out = T.StructType([*df.select(*[f"`{c}`" for c in kept]).schema.fields, *new.fields])
    source = df.select(*[f"`{c}`" for c in dict.fromkeys([*kept, column])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = compute(texts(b, column))
            old = [b.column(b.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*old, *got], names=[*kept, *new.names])

    return source.mapInArrow(run, out)
