"""How filters interact: every order of them, by recursion over mask cells.

A text fails some of five filters; the set of those is its mask. Documents are counted once, by part and mask (32 masks at
most). A recursive query then extends prefixes of filter orders by the letters not yet used. Each level joins the prefix with
the masks, carries the bits of the filters applied so far, and marks for each mask what the step does to it. These marks
number 325 prefixes times 32 masks whatever the input, so they are broadcast to the cells, and sums by part and prefix are
what each order shows at each of its steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbana.llm.arrow import slices, texts
from urbana.session import cut

LETTERS = "ABCDE"
COPY = 16  # the bit of E
NOT_CAPITAL = bytes(x for x in range(256) if not 65 <= x <= 90)
CONTINUED = bytes(range(0x80, 0xC0))
SYMBOLS = b"#$%&*|"


def mask(text: bytes) -> int:
    """Bits of the filters A to D that a text fails: A 1, B 2, C 4, D 8."""
    words = text.split()
    n = len(words)
    points = len(text.translate(None, CONTINUED))
    return (n < 50) | (100 * len(set(words)) < 65 * n) << 1 | (100 * len(text.translate(None, NOT_CAPITAL)) > 5 * points) << 2 | (len(text) != len(text.translate(None, SYMBOLS))) << 3


def with_masks(docs: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``(doc_id, part, mask, same)``: one row per row of ``docs``; ``same`` is a 128-bit hash of the text, ``mask`` holds A to D.

    Null texts are empty, null parts the empty string. Texts are read whole; a task holds one text's words at a time.
    """
    kind = docs.select(F.col(id_col).alias("doc_id")).schema["doc_id"].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = texts(b, "text")
            masks, same = pa.array([mask(t) for t in rows], pa.int32()), pa.array([xxhash.xxh3_128_digest(t) for t in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), masks, same], names=["doc_id", "part", "mask", "same"])

    return source.mapInArrow(run, f"doc_id {kind}, part string, mask int, same binary")


def cells(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by part and mask, E included, from ``masks(doc_id, part, mask, same)``.

    A text fails E where a smaller id has the same text anywhere. Rows of a text and part are first summed, apart for their smallest
    id; only the sums of a text meet, so its copies may hold any share of all rows. A document is good (toxic) if any label of
    its id says so. Rows without an id fail E where their text has an id, and have no labels.
    """
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.expr("CAST(quality <=> 1 AS INT)")).alias("good"), F.max(F.expr("CAST(toxic <=> 1 AS INT)")).alias("toxic"))
    zero = F.lit(0)
    known = masks.where("doc_id IS NOT NULL").join(marks, "doc_id", "left")
    marked = known.unionByName(masks.where("doc_id IS NULL").withColumns({"good": F.lit(None).cast("int"), "toxic": F.lit(None).cast("int")}))
    counts = [F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("good", zero)).alias("good"), F.sum(F.coalesce("toxic", zero)).alias("toxic")]
    by_id = marked.groupBy("same", "part", "mask", "doc_id").agg(*counts)
    ranked = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    first = F.min(F.struct(ranked.alias("low"), "n", "good", "toxic")).alias("first")
    sums = cut(by_id.groupBy("same", "part", "mask").agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"), first))
    lowest = sums.groupBy("same").agg(F.min("first.low").alias("lowest"), F.count(F.lit(1)).alias("parts"))
    alone = F.col("parts") == 1
    # A text in one part, or whose row has its smallest id, needs no more than its own row; the others join a row per text.
    of = sums.join(lowest, "same").withColumn("here", alone | (F.col("first.low") == F.col("lowest")))
    kept = of.where("here").select("part", "mask", F.col("first.n").alias("n"), F.col("first.good").alias("good"), F.col("first.toxic").alias("toxic"))
    own = {c: F.col(c) - F.when(F.col("here"), F.col(f"first.{c}")).otherwise(0) for c in ("n", "good", "toxic")}
    copies = of.select("part", (F.col("mask") + COPY).alias("mask"), *[own[c].alias(c) for c in own]).where("n > 0")
    return kept.unionByName(copies).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


#: ``gone`` and the other marks say what the last letter of a prefix does to the documents of a mask.
STEPS_SQL = """
WITH RECURSIVE letters AS (SELECT letter, CAST(shiftleft(1, place) AS INT) AS bit FROM (SELECT posexplode(split('A,B,C,D,E', ',')) AS (place, letter))),
    masks AS (SELECT CAST(id AS INT) AS mask FROM range(32)),
    steps (prefix, applied, step, mask, letter, stays, gone, redundant, alone) AS (
        SELECT CAST('' AS STRING), 0, 0, mask, CAST('' AS STRING), true, false, false, false FROM masks
        UNION ALL
        SELECT concat(s.prefix, l.letter), s.applied | l.bit, s.step + 1, s.mask, l.letter,
            s.mask & (s.applied | l.bit) = 0,
            s.mask & s.applied = 0 AND s.mask & l.bit <> 0,
            s.mask & s.applied <> 0 AND s.mask & l.bit <> 0,
            s.mask = l.bit
        FROM steps s JOIN letters l ON s.applied & l.bit = 0)
SELECT * FROM steps WHERE step > 0
"""


def audit(counted: DataFrame) -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)`` of ``counted`` cells.

    One row for each part, order of the five letters and step, zeros included. ``shapley`` is what a step's filter removes, summed
    over all orders. Without cells there are no parts and no rows.
    """
    spark = counted.sparkSession
    written = cut(spark.sql(STEPS_SQL))  # 325 prefixes of 32 masks
    steps = F.broadcast(written)

    def share(of: str, mark: str):
        return F.sum(F.when(F.col(mark), F.col(of)).otherwise(0))

    by_prefix = counted.join(steps, "mask").groupBy("part", "prefix", "step", "letter").agg(
        share("n", "stays").alias("kept"), share("n", "gone").alias("removed"), share("n", "redundant").alias("redundant"), share("n", "alone").alias("unique_fails"),
        share("good", "gone").alias("good_lost"), share("toxic", "gone").alias("toxic_lost"),
    )
    # A prefix of k letters is the beginning of (5 - k)! orders.
    over_orders = F.sum(F.col("removed") * F.factorial(F.lit(len(LETTERS)) - F.col("step"))).alias("shapley")
    by_prefix = cut(by_prefix)
    values = by_prefix.groupBy("part", "letter").agg(over_orders)
    orders = written.where(f"step = {len(LETTERS)} AND mask = 0").select(F.col("prefix").alias("filter_order"), F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step"))
    orders = F.broadcast(orders.withColumn("prefix", F.expr("left(filter_order, step)")))  # 600 rows
    got = by_prefix.join(values, ["part", "letter"]).drop("step").join(orders, "prefix")
    return got.select("part", "filter_order", F.col("step").cast("int").alias("step"), *[F.col(c).cast("long").alias(c) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")])
