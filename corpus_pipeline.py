"""The corpus pipeline: toxicity, quality rules, line dedup, SimHash near-dedup, best-fit packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbana.llm import line_dedup, packing, quality_rules, simhash, toxicity
from urbana.session import scratch_path, scratch_scope, table

#: Five-word shingles, Jaccard similarity of 0.8 or more, exactly. Candidates: two 256-bit SimHashes of sets with similarity 0.8
#: differ in about 39 bits (standard deviation 5.7); a pair is one at 56 or fewer if one of 24 tables of 20 bits has it within 1 bit.
NEAR = simhash.Linking(bits=256, radius=1, max_distance=56, tables=24, table_bits=20, levels=5, jaccard=0.8)


def apart(stage):
    """A stage that sees the columns of documents it works with, and returns the others, whatever their names, as they came."""
    known = ("doc_id", "text", "lang", "source", "n_chars")

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        other = {c: f"__other_{i}" for i, c in enumerate(docs.columns) if c not in known}
        got = stage(spark, docs.withColumnsRenamed(other), sf_dir)
        return got.select(*[F.col(f"`{other.get(c, c)}`").alias(c) for c in docs.columns])

    run.__doc__, run.__name__ = stage.__doc__, stage.__name__
    return run


@apart
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not score as toxic, scored whole whatever their length. Null and empty texts stay, repeated rows stay or go together; no documents give none."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted = 0")


@apart
def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and their host's verdict keep, counted whole whatever their length. Null, empty and short texts go; rows without a source are one host;
    repeated rows count each; no documents give none."""
    return quality_rules.judge(quality_rules.with_counts(docs)).where("kept")


@apart
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one holds; ``n_chars`` follows. Texts of any length are split whole. No document goes; null texts become empty; rows without
    an id are the last document; no documents give none."""
    return line_dedup.drop_repeated_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


@apart
def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies (and what these connect), compared whole whatever their length. Null and empty texts are one group; of
    repeated rows one stays, and a row without an id only where its group has no other; no documents give none."""
    return simhash.keep_one(docs, NEAR, shingle=5)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document, of any length, goes. A null or empty text is one end mark; repeated rows are packed each; no documents give no pieces."""
    return packing.best_fit(packing.word_lengths(docs, keep=["doc_id"]))


STAGES = [("toxicity", drop_toxic), ("quality rules", drop_low_quality), ("line dedup", drop_lines), ("simhash near-dedup", keep_one), ("best-fit packing", pack)]

ORACLE_SQL = None  # a trained score and seeded packing are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again, and what else the stage wrote goes."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = scratch_path(spark, name.replace(" ", "-"))
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
