"""Grouped summaries."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pivot_last(df: DataFrame, keys: list[str], kind: str, value: str, kinds: list[str]) -> DataFrame:
    """The last value of each kind in a column of its own."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(kind) == k, F.col(value))).alias(f"ultimo_{k}") for k in kinds])


def furthest_status(df: DataFrame, keys: list[str], status: str, ladder: list[str]) -> DataFrame:
    """The furthest step of a ladder that a key has reached; null if none."""
    step = F.lit(None).cast("int")
    for i, s in enumerate(ladder):
        step = F.when(F.col(status) == s, i).otherwise(step)
    names = F.array(*[F.lit(s) for s in ladder])
    return df.groupBy(*keys).agg(F.max(step).alias("__step")).withColumn("furthest", F.get(names, F.col("__step"))).drop("__step")


def funnel(df: DataFrame, status: str, person: str, stages: list[str]) -> DataFrame:
    """People and messages of each stage, and their share of all people; people are counted exactly."""
    total = df.agg(F.count_distinct(person).alias("__all"))
    per = df.where(F.col(status).isin(stages)).groupBy(status).agg(F.count_distinct(person).alias("pessoas"), F.count(F.lit(1)).alias("mensagens"))
    place = F.array_position(F.array(*[F.lit(s) for s in stages]), F.col(status))
    return per.crossJoin(F.broadcast(total)).withColumn("percentual", F.round(100 * F.col("pessoas") / F.col("__all"), 2)).withColumn("ordem", place).drop("__all")  # the total is one row


def period_stats(df: DataFrame, ts: str, unit: str, session: str, person: str) -> DataFrame:
    """Sessions, people and rows of each week or month."""
    period = F.date_trunc(unit, F.col(ts)).cast("date").alias("periodo")
    return df.groupBy(period).agg(F.count_distinct(session).alias("sessoes"), F.count_distinct(person).alias("pessoas"), F.count(F.lit(1)).alias("linhas"))


def ordered_list(order: list[str], value: str) -> Column:
    """A group's values in order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("__v")))), lambda x: x["__v"])


def first_items(df: DataFrame, keys: list[str], order: list[str], values: list[str], most: int) -> DataFrame:
    """``(keys, itens, n)``: the first ``most`` rows of each group in order, as structs of ``values``, and the number of its rows.

    A limit on a row number is taken before the shuffle too: a task passes on ``most`` rows of a group and one count, and no array holds more.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    head = df.select(*dict.fromkeys([*keys, *order, *values])).withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= most)
    items = head.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("__rn", F.struct(*values).alias("v")))), lambda x: x["v"]).alias("itens"))
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    same = functools.reduce(lambda a, b: a & b, [F.col(f"s.{k}").eqNullSafe(F.col(f"i.{k}")) for k in keys])
    return sizes.alias("s").join(items.alias("i"), same).select(*[F.col(f"s.{k}").alias(k) for k in keys], "itens", "n")


def join_numbered(arr: Column) -> Column:
    """``1. a\\n2. b``."""
    return F.array_join(F.transform(arr, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")


def join_capped(arr: Column, n: int, width: int, sep: str = "; ", total: Column | None = None) -> Column:
    """The first ``n`` items, each cut to a width, and ``+N more``. ``total``: the number of items where the array holds only the first."""
    there = F.size(arr) if total is None else total
    shown = F.array_join(F.transform(F.slice(arr, 1, n), lambda x: F.left(x, F.lit(width))), sep)
    return F.when(there > n, F.concat(shown, F.lit(" +"), (there - n).cast("string"), F.lit(" more"))).otherwise(shown)


def summarize_group(df: DataFrame, keys: list[str], ts: str, id_col: str, text: str, severity: Column, lat: str, lon: str, most: int | None = None) -> DataFrame:
    """Ids and texts in time order, the oldest time, the centre, the worst severity and the count of each group.

    With ``most``, only the first so many ids and texts, followed by ``+N more`` (see ``first_items``); without, a group's ids and texts are one array each.
    """
    measures = [F.min(ts).alias("mais_antigo"), F.round(F.avg(lat), 6).alias("lat"), F.round(F.avg(lon), 6).alias("lon"), F.max(severity).alias("severidade"), F.count(F.lit(1)).alias("n")]
    if most is None:
        return df.groupBy(*keys).agg(ordered_list([ts, id_col], id_col).alias("ids"), join_numbered(ordered_list([ts, id_col], text)).alias("descricoes"), *measures)
    items = first_items(df, keys, [ts, id_col], [id_col, text], most).withColumnRenamed("n", "__n").alias("i")
    sums = df.groupBy(*keys).agg(*measures).alias("s")
    same = functools.reduce(lambda a, b: a & b, [F.col(f"s.{k}").eqNullSafe(F.col(f"i.{k}")) for k in keys])
    more = F.when(F.col("__n") > most, F.concat(F.lit("\n+"), (F.col("__n") - most).cast("string"), F.lit(" more"))).otherwise("")
    ids, texts = F.transform("itens", lambda x: x[id_col]).alias("ids"), F.concat(join_numbered(F.transform("itens", lambda x: x[text])), more).alias("descricoes")
    return sums.join(items, same).select(*[F.col(f"s.{k}").alias(k) for k in keys], ids, texts, "mais_antigo", "lat", "lon", "severidade", F.col("s.n").alias("n"))


def bulletin(df: DataFrame, day: Column, order: list[str], text: str, most: int | None = None) -> DataFrame:
    """A day's texts, one per line; with ``most``, the first so many and how many more there are."""
    if most is None:
        return df.groupBy(day.alias("dia")).agg(F.array_join(ordered_list(order, text), "\n").alias("boletim"))
    items = first_items(df.withColumn("dia", day), ["dia"], order, [text], most)
    more = F.when(F.col("n") > most, F.concat(F.lit("\n+"), (F.col("n") - most).cast("string"), F.lit(" more"))).otherwise("")
    return items.select("dia", F.concat(F.array_join(F.transform("itens", lambda x: x[text]), "\n"), more).alias("boletim"))


def count_children(df: DataFrame, child: DataFrame, key: str, name: str) -> DataFrame:
    """How many rows each key has in a child table, 0 for none; each child apart, so that counts don't multiply."""
    n = child.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return df.join(n, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def usage_stats(df: DataFrame, thread: str, total: str, parts: list[str], step: str, model: str) -> DataFrame:
    """Tokens (the total, or the parts' sum where it is 0 or null), steps and models of each thread."""
    sums = sum((F.coalesce(F.col(p), F.lit(0)) for p in parts), F.lit(0))
    tokens = F.when(F.coalesce(F.col(total), F.lit(0)) == 0, sums).otherwise(F.col(total))
    return df.groupBy(thread).agg(F.sum(tokens).alias("tokens"), F.count_distinct(step).alias("passos"), F.array_join(F.sort_array(F.collect_set(model)), ",").alias("modelos"))


def nest(df: DataFrame, keys: list[str], cols: list[str], name: str = "items") -> DataFrame:
    """A group's rows as an array of structs, sorted."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*cols))).alias(name))


def nest_by(df: DataFrame, keys: list[str], by: str, cols: list[str], name: str = "items") -> DataFrame:
    """A group's rows as a map from one column to a struct of others, in order; of rows with the same name the last in order counts."""
    last = df.groupBy(*keys, by).agg(F.max(F.struct(*cols)).alias("__v"))
    return last.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(by, "__v")))).alias(name))


def run_stats(df: DataFrame, key: str) -> DataFrame:
    """Rows, different keys and null keys of a table."""
    return df.agg(F.count(F.lit(1)).alias("linhas"), F.count_distinct(key).alias("chaves"), F.count_if(F.col(key).isNull()).alias("nulos"))
