"""Lines that repeat across documents are dropped everywhere but in the smallest document that holds them.

Lines are exploded to 128-bit hashes of their keys (bounds of ASCII white space stripped, A-Z lower-cased); a
grouped minimum and maximum of the document id finds the keys of several documents without collecting
a group; the keys to drop go back to their documents, which are put together by position.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbana.llm.arrow import slices, texts
from urbana.session import cut

MIN_CHARS = 10
SPACE = b" \t\n\x0b\x0c\r"
HOT_KEYS = 4096
LAST = 2**63 - 1  # rows without an id count as one document after all others


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The hash of a line's key, None if the key has under ``min_chars`` code points."""
    key = line.strip(SPACE).lower()
    if len(key) < min_chars or not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(docs: DataFrame, id_col: str, text: str, min_chars: int) -> DataFrame:
    """``(doc, mark, key)`` for each distinct long key of each row; ``mark`` is a hash of the row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            ids, marks, keys = [], [], []
            for i, m, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts(b, "text"), strict=True):
                own = {line_key(x, min_chars) for x in t.split(b"\n")} - {None}
                ids += [i] * len(own)
                marks += [m] * len(own)
                keys += own
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(keys, pa.binary())], names=["doc", "mark", "key"])

    source = docs.select(_doc(id_col).alias("doc"), F.xxhash64(F.col(text)).alias("mark"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc bigint, mark bigint, key binary")


def _doc(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = 2, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with ``text`` replaced by its kept lines, and ``n_lines`` (before) and ``n_dropped``.

    A key of at least ``min_chars`` code points found in at least ``min_docs`` documents loses its lines in all
    documents but the smallest; there all its lines stay. Null and empty texts are one empty line (the text
    becomes empty). Rows with the same id are one document; rows without an id are one document that comes
    last. Each row is put together on its own, by id and text, however many rows share its id. Other columns pass through (those named
    ``n_lines`` and ``n_dropped`` are replaced). Lines of any length are read whole. An empty table gives an empty result.
    """
    keys = cut(line_keys(docs, id_col, text, min_chars))
    counted = (keys if min_docs == 2 else keys.select("doc", "key").distinct()).groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n"))
    shared = cut(counted.where("first < last" if min_docs == 2 else F.col("n") >= min_docs).select("key", "first", "n"))
    total = shared.agg(F.sum("n")).first()[0] or 0
    # Of all rows with a shared key at most HOT_KEYS keys can hold more than 1 / HOT_KEYS each: these few are broadcast,
    # and their rows don't meet in one task. The others join by key.
    hot = F.broadcast(shared.where(F.col("n") > total / HOT_KEYS).select("key", F.col("first").alias("hot_first")))
    marked = keys.join(hot, "key", "left").withColumn("cold", F.when(F.col("hot_first").isNull(), F.col("key")).otherwise(F.concat("key", F.col("mark").cast("string").cast("binary"))))
    cold = shared.where(F.col("n") <= total / HOT_KEYS).select(F.col("key").alias("cold"), "first")
    lost = (
        marked.join(cold, "cold", "left")
        .where(F.col("doc") > F.coalesce("hot_first", "first"))
        .groupBy(F.col("doc").alias("__doc"), F.col("mark").alias("__mark"))
        .agg(F.collect_set("key").alias("__lost"))  # keys of one row
    )
    named = docs.withColumn("__id", _doc(id_col)).withColumn("__of", F.xxhash64(F.col(text)))
    joined = named.join(lost, (F.col("__id") == F.col("__doc")) & (F.col("__of") == F.col("__mark")), "left")
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    out = T.StructType([docs.schema[c] for c in kept]).add("n_lines", "long").add("n_dropped", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            whole, counts, drops = [], [], []
            for t, gone in zip(texts(b, text), b.column(b.schema.get_field_index("__lost")).to_pylist(), strict=True):
                lines = t.split(b"\n")
                gone = set(gone or ())
                stay = [x for x in lines if line_key(x, min_chars) not in gone] if gone else lines
                whole.append(b"\n".join(stay))
                counts.append(len(lines))
                drops.append(len(lines) - len(stay))
            new = {text: pa.array(whole, pa.binary()).cast(pa.string())}
            cols = [new.get(c, b.column(b.schema.get_field_index(c))) for c in kept]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64()), pa.array(drops, pa.int64())], names=out.names)

    return joined.select(*[f"`{c}`" for c in kept], "__lost").mapInArrow(run, out)
