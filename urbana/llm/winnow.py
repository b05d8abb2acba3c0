"""Document fingerprints by winnowing, in column expressions alone.

Every ``k``-gram of bytes (UTF-8) is hashed; of each window of ``w`` neighbouring k-grams the smallest hash is chosen, the
rightmost of equal ones, and the choices are kept with their positions. Two texts that share ``w + k - 1`` bytes in
a row share a choice, in any script. A text of fewer bytes than that is one window, one of fewer than ``k`` one gram.

The hash of a gram is its CRC-32, the remainder of a polynomial over two values, which is what a rolling hash would carry on.
Column expressions carry no state along an array, so each gram is evaluated from its ``k`` bytes; a recurrence by
doubling (grams of 2, 4 and 8 from overlapping smaller ones) gives a polynomial hash too and took four times as long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbana.operators.select import global_rank
from urbana.session import cut

GRAM = 8
WINDOW = 32  # a product of WAYS
WAYS = (4, 4, 2)
POSITION_BITS = 31
POSITIONS = (1 << POSITION_BITS) - 1
BUCKET_ROWS = 512


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def packed_grams(raw: Column, gram: int = GRAM) -> Column:
    """For each k-gram of a binary its hash, above the position counted backwards: the least is the least hash, of equals the rightmost."""

    def grams(x: Column) -> Column:
        every = F.sequence(F.lit(1), F.greatest(F.length(x) - (gram - 1), F.lit(1)))
        hashed = F.transform(every, lambda i: F.shiftleft(F.crc32(F.substring(x, i, F.lit(gram))), POSITION_BITS).bitwiseOR(F.lit(POSITIONS) - i))
        return F.when(F.length(x) > 0, hashed).otherwise(F.array().cast("array<bigint>"))

    return _let(raw, grams)


def minima(grams: Column, ways: tuple[int, ...] = WAYS) -> Column:
    """The least of each window. Windows grow level by level: the least of ``n`` windows that follow each other is that of a longer one.
    Grams that fill no window, or just one, are one window."""

    def longer(n: int, reach: int):
        return lambda a: F.transform(F.slice(a, 1, F.size(a) - reach * (n - 1)), lambda x, i: F.least(x, *[F.get(a, i + reach * j) for j in range(1, n)]))

    def every(own: Column) -> Column:
        found, reach = own, 1
        for n in ways:
            found, reach = _let(found, longer(n, reach)), reach * n
        return F.when(F.size(own) > reach, found).when(F.size(own) > 0, F.array(F.array_min(own))).otherwise(own)

    return _let(grams, every)


def fingerprint(text: Column) -> Column:
    """The chosen grams of a text, ``hash << 31 | (2**31 - 1 - position)`` in the order of their windows; empty for no text."""
    return chosen(F.coalesce(text, F.lit("")).cast("binary"))


def chosen(raw: Column) -> Column:
    return F.array_distinct(minima(packed_grams(raw)))


def edited_fingerprint(own: Column, changed: Column, head: Column) -> Column:
    """``fingerprint(changed)`` of a text that begins with the first ``head`` bytes of one whose fingerprint is ``own``.

    The windows that lie in the head chose the same grams there; only those that reach beyond it are looked at.
    """

    def joined(v: Column) -> Column:
        rest = F.transform(chosen(v["tail"]), lambda x: x - v["start"])
        return F.array_distinct(F.concat(F.filter(v["own"], lambda x: F.lit(POSITIONS) - x.bitwiseAND(F.lit(POSITIONS)) <= v["sure"]), rest))

    # The last position that a window of the head can be the first to choose; then the bytes before the first window that may differ.
    bounds = F.struct((head - (GRAM + WINDOW - 2)).alias("sure"), F.greatest(head - (GRAM + 2 * WINDOW - 3), F.lit(0)).alias("start"))
    tail = lambda v: F.substring(changed.cast("binary"), v["start"] + 1, F.octet_length(changed))
    return _let(bounds, lambda v: _let(F.struct(own.alias("own"), v["sure"].alias("sure"), v["start"].alias("start"), tail(v).alias("tail")), joined))


def hashes(chosen: Column) -> Column:
    return F.array_distinct(F.transform(chosen, lambda x: F.shiftright(x, POSITION_BITS)))


def positions(chosen: Column) -> Column:
    """The number of the byte that each chosen gram starts at, from 1."""
    return F.transform(chosen, lambda x: F.lit(POSITIONS) - x.bitwiseAND(F.lit(POSITIONS)))


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes among all hashes of two fingerprints; 1 for two empty ones."""

    def share(pair: Column) -> Column:
        common = F.size(F.array_intersect(pair["a"], pair["b"]))
        every = F.size(pair["a"]) + F.size(pair["b"]) - common
        return F.when(every > 0, common / every).otherwise(F.lit(1.0))

    return _let(F.struct(hashes(a).alias("a"), hashes(b).alias("b")), share)


def label(chosen: Column) -> Column:
    """A fingerprint as 32 hex digits."""
    return F.lower(F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), chosen)), 16, "0") for seed in (1, 2)]))


def with_next(docs: DataFrame, carried: dict[str, Column], id_col: str = "doc_id", text: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(doc_id, text, *carried, next_text, next_*)``: each row beside the next by id; after the last comes the first.

    Null ids come first, null texts are empty, equal ids are ordered by a hash of the text; rows equal in both are one document that
    comes out as often as it went in, beside the next different one (or itself, if there is no other). Narrow rows (id and hash) are
    numbered; texts then go to buckets of as many neighbouring numbers, whatever the ids are, the first of each bucket also to the one
    before. ``carried`` columns are computed once for each row. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(-(2**63)))).withColumn("mark", F.xxhash64("text"))
    ranked = cut(global_rank(rows.groupBy("key", "mark").agg(F.count(F.lit(1)).alias("copies")), ["key", "mark"]))
    n, most = ranked.agg(F.count(F.lit(1)), F.max("copies")).first()
    if most and most > 1:
        rows = rows.groupBy("key", "mark").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    at = F.col("rank") - 1
    own = F.struct(F.floor(at / bucket_rows).alias("bucket"), at.alias("place"))
    before = F.when(at == 0, F.lit(n)).otherwise(at)  # the first follows the last
    copy = F.struct(F.floor((before - 1) / bucket_rows).alias("bucket"), before.alias("place"))
    places = F.when(at % bucket_rows == 0, F.array(own, copy)).otherwise(F.array(own))
    spread = rows.join(ranked, ["key", "mark"]).select("doc_id", "text", "copies", F.inline(places)).repartition("bucket")
    made = spread.select("*", *[c.alias(k) for k, c in carried.items()])
    order = Window.partitionBy("bucket").orderBy("place")
    following = made.select("*", *[F.lead(k).over(order).alias(f"next_{k}") for k in ("text", *carried)])
    several = following.where("next_text IS NOT NULL")
    return several.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("bucket", "place", "copies", "copy")


def edited(text: Column, following: Column) -> Column:
    """A text whose last half (rounded down) is replaced by as many characters from the start of another, or all it has."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def compare(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint beside its edited text's and the next document's, with their likeness.

    One row per row of ``docs``; other columns are not read. Null and empty texts have an empty fingerprint, which is wholly like another
    empty one. Texts of any length are fingerprinted whole: a task holds a text, its neighbour, and arrays of 8 bytes for each byte of them. Order and repeated rows as
    in ``with_next``. An empty table gives an empty result.
    """
    pairs = with_next(docs, {"chosen": fingerprint(F.col("text"))}, id_col, text)
    half = F.floor(F.length("text") / 2).cast("int")
    head = F.octet_length(F.substring("text", F.lit(1), F.length("text") - half))
    full = pairs.withColumn("edited", edited(F.col("text"), F.col("next_text"))).withColumn("head", head)
    full = full.withColumn("edited_chosen", edited_fingerprint(F.col("chosen"), F.col("edited"), F.col("head"))).drop("head")
    return full.withColumn("near_edited", likeness(F.col("chosen"), F.col("edited_chosen"))).withColumn("near_next", likeness(F.col("chosen"), F.col("next_chosen")))
