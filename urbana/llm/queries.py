"""The queries of the corpus operators, with their SQL twins."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbana.llm import filter_audit, jaccard_join, line_dedup, packing, periodic, pieces, planes, quality_rules, simhash, toxicity, url_filter, weak_quality, winnow
from urbana.llm.arrow import slices, texts
from urbana.session import scratch_path, table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of ``documents``: 3-word shingles, 64 bits, links at 2 or fewer differing bits."""
    got = simhash.components(table(spark, sf_dir, "documents"), simhash.Linking())
    return got.select("doc_id", F.lower(F.hex("simhash")).alias("fingerprint"), "component_id")


def op2_sentencepiece_codec(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """``documents`` encoded with begin and end ids and decoded again; digests of both."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")
    ids = pieces.encode(table(spark, sf_dir, "documents"), path, keep=["doc_id"])
    back = pieces.decode(ids, path)
    return back.select("doc_id", pieces.n_ids().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of ``documents``, learnt from ``labels`` outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=["doc_id"]).select("doc_id", (toxicity.fold() == 2).alias("held_out"), "score", "predicted")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and host verdicts of ``documents``; the host is ``source``."""
    counted = quality_rules.with_counts(table(spark, sf_dir, "documents"), keep=["doc_id", "source"])
    return quality_rules.judge(counted).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_token_binary(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """``documents`` as token ids in plane files, written in id order and read back."""
    folder = scratch_path(spark, "token-planes")
    planes.write(table(spark, sf_dir, "documents"), folder, tokenizer or public_tokenizers.path("byte_bpe_50k.json"), end_id=2)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(x) // 4 for x in raw], pa.int64()), pa.array([zlib.crc32(x) for x in raw], pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return planes.read(spark, folder).mapInArrow(digest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowed fingerprints of ``documents`` and of their edited texts."""
    got = winnow.compare(table(spark, sf_dir, "documents"))
    return got.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        winnow.label(F.col("chosen")).alias("fingerprint"), winnow.label(F.col("edited_chosen")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every url of ``pages``."""
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` packed into sequences of 512 to 4096 words (an end mark counts as one)."""
    return packing.best_fit(packing.word_lengths(table(spark, sf_dir, "documents"), keep=["doc_id"]))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak labels and scores of ``documents``."""
    return weak_quality.classify(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` without the lines that an earlier document holds."""
    got = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of ``documents`` whose sets of five-word shingles are similar by 0.8 or more."""
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op12_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from ``documents`` in each order of them, by ``source``."""
    masks = filter_audit.with_masks(table(spark, sf_dir, "documents"))
    return filter_audit.audit(filter_audit.cells(masks, table(spark, sf_dir, "labels")))


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``: the words of each text joined by a space; those of a tenth of the ids repeat from some word on, as their crc32 says.

    Null texts are empty, and a text without words becomes empty; a row without an id keeps its words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            for i, t in zip(b.column(0).to_pylist(), texts(b, "text"), strict=True):
                words = t.split()
                h = 1 if i is None else zlib.crc32(str(i).encode())
                if h % 10 == 0 and words:
                    g = h // 10
                    a = g % len(words)
                    p = 1 + (len(words) - a) // (3 + g % 8)
                    words = words[:a] + (words[a : a + p] * -(-(len(words) - a) // p))[: len(words) - a]
                out.append(b" ".join(words).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    source = docs.select("doc_id", "text")
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, text string")


def op13_periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in ``documents``, a tenth of them with repeated tails, and the texts without repetitions."""
    got = periodic.with_runs(with_repeated_tails(table(spark, sf_dir, "documents")), keep=["doc_id"])
    # Runs are in the order of ties, so only a greater exponent takes the place of an earlier run.
    best = F.reduce(F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)), lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    named = got.withColumn("best", best)
    return named.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (op1_simhash_near_dedup, op2_sentencepiece_codec, op3_toxicity, op4_quality_rules, op5_token_binary, op6_document_fingerprints, op7_url_filters, op8_best_fit_packing, op9_quality_classifier, op10_line_dedup, op11_ngram_jaccard_join, op12_filter_interaction_audit, op13_periodic_run_detection)
}

_COUNTS = r"""
    docs AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
    split_words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs),
    split_lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs),
    positions AS (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split_words),
    grams AS (SELECT doc_id, i, {'a': words[i], 'b': words[i + 1], 'c': words[i + 2]} AS gram FROM positions),
    repeated AS (SELECT doc_id, gram FROM grams GROUP BY doc_id, gram HAVING count(*) > 1),
    covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams JOIN repeated USING (doc_id, gram)) GROUP BY doc_id),
    counted AS (
        SELECT doc_id, host, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
            CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
            CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
        FROM split_words JOIN split_lines USING (doc_id) LEFT JOIN covered USING (doc_id))
"""

QUALITY_SQL = rf"""
WITH {_COUNTS},
    marked AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_words OR word_chars < 3 * n_words OR word_chars > 12 * n_words AS soft_failed
        FROM counted),
    hosts AS (SELECT host, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (base_failed OR soft_failed) AS DOUBLE) AS f FROM marked GROUP BY host),
    moments AS (SELECT avg(f / n) AS m, coalesce(var_pop(f / n), 0) AS v, avg(f / n * (1 - f / n) / n) AS noise FROM hosts),
    prior AS (SELECT m, greatest(m * (1 - m) / greatest(v - noise, 1e-6) - 1, 1.0) AS strength FROM moments),
    rates AS (SELECT host, (m * strength + f) / (strength + n) AS host_rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT (soft_failed AND host_rate > 0.5) AS kept
FROM marked JOIN rates USING (host)
"""

LINES_SQL = r"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    each AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM cut),
    keyed AS (
        SELECT doc_id, i, lines[i] AS line,
            translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM each),
    shared AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
    marked AS (SELECT doc_id, i, line, first IS NOT NULL AND doc_id > first AS gone FROM keyed LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

JACCARD_SQL = r"""
WITH RECURSIVE docs AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
    grams AS (
        SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
            ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))) END AS grams
        FROM docs),
    named AS (SELECT doc_id, len(grams) AS n, min(doc_id) OVER (PARTITION BY CASE WHEN len(grams) = 0 THEN CAST(doc_id AS VARCHAR) ELSE array_to_string(grams, chr(10)) END) AS rep, grams FROM grams),
    members AS (SELECT doc_id AS rep, n, unnest(grams) AS gram FROM named WHERE doc_id = rep),
    pairs AS (SELECT a.rep AS a, b.rep AS b FROM members a JOIN members b ON a.gram = b.gram AND a.rep < b.rep GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
    reach AS (SELECT rep AS a, rep AS b FROM named GROUP BY rep UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    lowest AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id FROM named JOIN lowest USING (rep)
"""

AUDIT_SQL = r"""
WITH RECURSIVE docs AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
    split_words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM docs),
    marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    failed AS (
        SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
            CAST(len(words) < 50 AS INT) + 2 * CAST(100 * list_unique(words) < 65 * len(words) AS INT)
            + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS INT)
            + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(doc_id > first AS INT) AS mask
        FROM split_words LEFT JOIN marks USING (doc_id)),
    counted AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failed GROUP BY part, mask),
    letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)),
    steps AS (
        SELECT '' AS filter_order, 0 AS applied, 0 AS step, '' AS letter, 0 AS bit
        UNION ALL
        SELECT filter_order || l.letter, applied | l.bit, step + 1, l.letter, l.bit FROM steps JOIN letters l ON applied & l.bit = 0),
    metrics AS (
        SELECT part, filter_order AS prefix, step, letter,
            sum(CASE WHEN mask & applied = 0 THEN n ELSE 0 END) AS kept,
            sum(CASE WHEN mask & applied = bit THEN n ELSE 0 END) AS removed,
            sum(CASE WHEN mask & bit <> 0 AND mask & applied <> bit THEN n ELSE 0 END) AS redundant,
            sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
            sum(CASE WHEN mask & applied = bit THEN good ELSE 0 END) AS good_lost,
            sum(CASE WHEN mask & applied = bit THEN toxic ELSE 0 END) AS toxic_lost
        FROM counted CROSS JOIN steps WHERE step > 0 GROUP BY ALL),
    orders AS (SELECT s.filter_order, CAST(unnest(range(1, 6)) AS INT) AS step FROM steps s WHERE s.step = 5),
    laid AS (SELECT m.*, o.filter_order FROM orders o JOIN metrics m ON m.step = o.step AND m.prefix = left(o.filter_order, o.step))
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
    CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM laid
"""

ORACLES: dict[str, str] = {"op11_ngram_jaccard_join": JACCARD_SQL, "op12_filter_interaction_audit": AUDIT_SQL, "op4_quality_rules": QUALITY_SQL, "op10_line_dedup": LINES_SQL}
