"""Rules for single documents, and verdicts on their hosts.

Each document is held to Gopher-like rules. The share of failing documents of a host is shrunk towards the
corpus with a beta prior, fitted to all hosts by the method of moments. A host whose shrunk share is too
high is not trusted, and loses every document that fails any rule, also the soft ones; other hosts lose the
documents that fail a base rule.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbana.llm.arrow import with_columns
from urbana.session import cut

COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
SYMBOLS = b"#*$%&|<>"
MAX_HOST_RATE = 0.5
MIN_HOST_SPREAD = 1e-6
SALTS = 32  # parts that a host's documents are dealt to for the join with its verdict


def counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text (UTF-8)."""
    words = text.split()
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = Counter(x for x in text.split(b"\n") if not x.isspace() and x)
    repeats = sum(lines.values()) - len(lines)
    grams = list(zip(words, words[1:], words[2:], strict=False))
    covered = 0
    if len(set(grams)) < len(grams):
        found, end = Counter(grams), 0  # end: first position that is not covered yet
        for i, g in enumerate(grams):
            if found[g] > 1:
                covered += i + 3 - max(i, end)
                end = i + 3
    return len(words), chars, symbols, repeats, covered


def with_counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the counts of each whole text, which replace columns of these names. Null and empty texts count 0 everywhere.

    Texts of any length are counted whole, one at a time: a task holds a text, its words and its lines. Repeated rows stay; an empty table gives an empty result.
    """

    def compute(rows: list[bytes]) -> list[pa.Array]:
        got = [counts(t) for t in rows]
        return [pa.array([g[i] for g in got], pa.int64()) for i in range(5)]

    return with_columns(docs, text, COUNTS, compute, keep)


def judge(counted: DataFrame, host: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``counted`` with ``base_failed``, ``soft_failed``, ``host_rate`` (shrunk) and ``kept``, which replace columns of these names.

    Base: under 50 words, or over half of the words in repeated 3-word windows. Soft: a symbol for every
    10 words, or 3 of 10 words' worth of repeated lines, or a mean word under 3 or over 12 characters.
    Rows without a host are one host of their own. Texts are counted once: the counted rows are written and read again. Counts
    per host are partial sums before the shuffle; for the join with the verdicts, which Spark broadcasts if their written size
    allows, each host's documents are dealt to ``SALTS`` parts and its one verdict is repeated. Texts pass through, whatever their length. Repeated rows stay and count each;
    an empty table gives an empty result.
    """
    base = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    soft = F.expr("10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_words OR word_chars < 3 * n_words OR word_chars > 12 * n_words")
    added = ["base_failed", "soft_failed", "host_rate", "kept"]
    marked = cut(counted.select(*[f"`{c}`" for c in counted.columns if c not in added or c == host], F.coalesce(F.col(host).cast("string"), F.lit("")).alias("__host")))
    marked = marked.withColumn("__base", base).withColumn("__soft", soft)
    failed = F.col("__base") | F.col("__soft")
    hosts = marked.groupBy("__host").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.when(failed, 1.0).otherwise(0.0)).alias("f"))
    rate = F.col("f") / F.col("n")
    moments = hosts.agg(F.avg(rate).alias("m"), F.coalesce(F.var_pop(rate), F.lit(0.0)).alias("v"), F.avg(rate * (1 - rate) / F.col("n")).alias("noise"))
    spread = F.greatest(F.col("v") - F.col("noise"), F.lit(MIN_HOST_SPREAD))
    prior = moments.select("m", F.greatest(F.col("m") * (1 - F.col("m")) / spread - 1, F.lit(1.0)).alias("strength"))
    shrunk = (F.col("m") * F.col("strength") + F.col("f")) / (F.col("strength") + F.col("n"))
    salts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)]))
    verdicts = cut(hosts.crossJoin(F.broadcast(prior)).select(F.col("__host").alias("__of"), shrunk.alias("__rate"), salts.alias("__part")))  # the prior is one row
    dealt = marked.withColumn("__salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))  # the rows are written: their numbers are fixed
    out = dealt.join(verdicts, (F.col("__host") == F.col("__of")) & (F.col("__salt") == F.col("__part")))
    kept = ~F.col("__base") & ~(F.col("__soft") & (F.col("__rate") > max_host_rate))
    old = [f"`{c}`" for c in counted.columns if c not in added]
    return out.select(*old, F.col("__base").alias("base_failed"), F.col("__soft").alias("soft_failed"), F.col("__rate").alias("host_rate"), kept.alias("kept"))
