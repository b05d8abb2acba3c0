"""URL verdicts: rules by host and path first, then logistic regression on hashed character n-grams.

Everything that touches the pages is column expressions. The model is fitted on a small labelled URL table
by gradient steps, each of which is one grouped aggregate. The default table is made by rule from the word lists
below: hosts of one or two words (unwanted if one of them is a word of unwanted trades) or of made-up names,
under the same domains and paths in either class, so that only the name tells them apart.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbana.session import cut

BUCKETS = 4096
GRAM = 4
STEPS = 16
RATE = 0.6
LABELLED_ROWS = 4096  # rows of the labelled table that are used, by the order of their hash

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Words of the default labelled URLs.
TRADES = ["casino", "poker", "slots", "bets", "jackpot", "pills", "meds", "viagra", "loans", "payday", "xxx", "adult", "porn", "sex", "spam", "ads", "clicks", "track", "farm", "replica", "warez", "torrent"]
LURES = ["free", "cheap", "win", "bonus", "online", "best", "hot", "easy", "fast", "top", "x", "vip", "deals", "prizes", "now"]
TOPICS = ["library", "museum", "news", "school", "council", "weather", "garden", "history", "transport", "health", "science", "music", "city", "river", "forum", "wiki", "bread", "street", "travel", "sport", "theatre", "archive", "market", "island", "bridge", "village"]
# The most frequent pairs of letters, and endings, of English words.
SYLLABLES = ["th", "he", "in", "er", "an", "re", "on", "at", "en", "nd", "ti", "es", "or", "te", "ed", "is", "it", "al", "ar", "st", "to", "nt", "ing", "tion", "ble", "ha", "ou", "ea", "sh", "wh", "ly"]
DOMAINS = ["example.com", "example.org", "example.net"]
PREFIXES = ["", "www.", "m.", "blog."]
LANGUAGES = ["en", "de", "fr", "es"]

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """``df`` with ``host`` and ``path``; both empty for a null url or one without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)"))
    whole = F.coalesce(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))
    return df.withColumn("host", F.translate(whole, UPPER, LOWER)).withColumn("path", path)


def rule_for(rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits ``host`` and ``path`` (of equally long ones the last by text), else null."""
    fits = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        site, _, path = rule.partition("/")
        on = ((F.col("host") == site) | F.col("host").endswith("." + site)) & F.col("path").startswith("/" + path)
        fits = F.when(on, F.lit(rule)).otherwise(fits)
    return fits


def buckets(buckets_: int = BUCKETS, gram: int = GRAM) -> Column:
    """The hashed character n-grams of host and path, without digits (one gram where they are shorter)."""
    text = F.regexp_replace(F.concat(F.lit("^"), F.col("host"), F.col("path"), F.lit("$")), "[0-9]+", "0")
    n = F.greatest(F.length(text) - gram + 1, F.lit(1))
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.pmod(F.xxhash64(F.substring(text, i, F.lit(gram))), F.lit(buckets_)).cast("int"))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The default labelled table ``(url, label)``, about 2,500 rows; 1 is unwanted."""
    each = lambda words: F.explode(F.array(*[F.lit(w) for w in words]))
    one = spark.range(1)

    def pairs(first: list[str], second: list[str], joints: list[str], share: int) -> DataFrame:
        """Hosts of two words, one in ``share`` of all by hash."""
        both = one.select(each(first).alias("a")).select("a", each(second).alias("b")).select("a", "b", each(joints).alias("j")).where("a <> b")
        return both.where(F.pmod(F.xxhash64("a", "b", "j", F.lit("pair")), F.lit(share)) == 0).select(F.concat("a", "j", "b").alias("name"))

    names = one.select(each(SYLLABLES).alias("a")).select("a", each(SYLLABLES).alias("b")).select("a", "b", each(SYLLABLES).alias("c"))
    unwanted = one.select(each(TRADES).alias("name")).unionByName(pairs(TRADES, LURES + TRADES, ["-", ""], 3)).unionByName(pairs(LURES, TRADES, ["-", ""], 3))
    wanted = one.select(each(TOPICS).alias("name")).unionByName(pairs(TOPICS, TOPICS, ["-", ""], 3))
    wanted = wanted.unionByName(names.where(F.pmod(F.xxhash64("a", "b", "c", F.lit("name")), F.lit(40)) == 0).select(F.concat("a", "b", "c").alias("name")))
    every = unwanted.withColumn("label", F.lit(1)).unionByName(wanted.withColumn("label", F.lit(0)))

    def of(values: list[str], salt: int) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(F.xxhash64("name", F.lit(salt)), F.lit(len(values))).cast("int"))

    number = F.pmod(F.xxhash64("name", F.lit(5)), F.lit(1000)).cast("string")
    return every.select(F.concat(of(["http://", "https://"], 1), of(PREFIXES, 2), "name", F.lit("."), of(DOMAINS, 3), F.lit("/"), of(LANGUAGES, 4), F.lit("/"), number, of(["", "/", ".html"], 6)).alias("url"), "label")


def fit(labelled: DataFrame, steps: int = STEPS, rate: float = RATE, buckets_: int = BUCKETS) -> list[float]:
    """Weights of the buckets and, last, the bias. Rows without a label or url are left out; no rows: all 0.

    Full gradient steps, scaled for each bucket by its past slopes; each is one aggregate of ``buckets_ + 1``
    rows over at most ``LABELLED_ROWS`` urls.
    """
    rows = (
        with_parts(labelled.where("url IS NOT NULL AND label IS NOT NULL").select("url", F.col("label").cast("double").alias("label")))
        .orderBy(F.xxhash64("url"), "url", "label").limit(LABELLED_ROWS)
        .select("label", F.array_distinct(buckets(buckets_)).alias("grams"))
    )
    rows = cut(rows)
    weights, past = [0.0] * (buckets_ + 1), [1e-6] * (buckets_ + 1)
    for _ in range(steps):
        error = rows.select("grams", (F.col("label") - probability(F.col("grams"), weights)).alias("e"))
        slopes = error.select(F.explode(F.array_append("grams", buckets_)).alias("bucket"), (F.col("e") / F.when(F.size("grams") > 0, F.sqrt(F.size("grams").cast("double"))).otherwise(1.0)).alias("e"))
        for bucket, slope in slopes.groupBy("bucket").agg(F.sum("e")).collect():  # at most buckets_ + 1 rows
            past[bucket] += slope * slope
            weights[bucket] += rate * slope / math.sqrt(past[bucket])
    return weights


def probability(grams: Column, weights: list[float]) -> Column:
    """Logistic score of an array of distinct buckets."""
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")  # folded to one constant
    total = F.aggregate(grams, F.lit(0.0), lambda s, b: s + F.get(table, b))
    size = F.when(F.size(grams) > 0, F.sqrt(F.size(grams).cast("double"))).otherwise(1.0)
    return 1 / (1 + F.exp(-(total / size + F.lit(weights[-1]))))


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules: list[tuple[str, str]] | None = None, url: str = "url", threshold: float = 0.5) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``score`` and ``verdict`` (allow or block).

    A rule decides where one fits, else the score does. Null, empty and malformed urls have empty parts and
    get the score of an empty url. Repeated rows stay, of equally long rules that fit the last by text holds; columns named like
    the added ones are replaced; an empty table gives an empty result.
    """
    rules = RULES if rules is None else rules
    weights = fit(labelled if labelled is not None else labelled_urls(pages.sparkSession))
    said = F.lit(None).cast("string")
    for verdict, rule in rules:
        said = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(said)
    out = with_parts(pages, url).withColumn("rule", rule_for(rules))
    out = out.withColumn("score", probability(F.array_distinct(buckets()), weights))
    return out.withColumn("verdict", F.coalesce(said, F.when(F.col("score") >= threshold, "block").otherwise("allow")))
