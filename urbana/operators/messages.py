"""Assistant messages as typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MESSAGE = (
    "kwargs STRUCT<type: STRING, id: STRING, content: STRING, tool_calls: ARRAY<STRUCT<id: STRING, name: STRING, args: STRING>>, tool_call_id: STRING, status: STRING, "
    "additional_kwargs: STRUCT<timestamp: STRING, reasoning: STRING>, response_metadata: STRUCT<model_name: STRING, finish_reason: STRING, "
    "usage_metadata: STRUCT<total_token_count: BIGINT, prompt_token_count: BIGINT, candidates_token_count: BIGINT>>>"
)


def normalize_messages(df: DataFrame, keys: list[str], payload: str) -> DataFrame:
    """One row for each part of a JSON message: user, reasoning, tool call, tool return, assistant. Broken JSON gives none."""
    m = F.from_json(payload, MESSAGE)["kwargs"]
    parsed = df.select(*keys, m.alias("m"))

    def part(kind: str, content, call=None, name=None):
        return F.struct(F.lit(kind).alias("kind"), content.cast("string").alias("content"), (F.lit(None) if call is None else call).cast("string").alias("call_id"), (F.lit(None) if name is None else name).cast("string").alias("tool"))

    none = F.filter(F.array(part("", F.lit(""))), lambda x: F.lit(False))
    calls = F.coalesce(F.transform("m.tool_calls", lambda c: part("tool_call", c["args"], c["id"], c["name"])), none)
    reasoning = F.when(F.col("m.additional_kwargs.reasoning").isNotNull(), F.array(part("reasoning", F.col("m.additional_kwargs.reasoning")))).otherwise(none)
    said = F.when(F.coalesce(F.col("m.content"), F.lit("")) != "", F.array(part("assistant", F.col("m.content")))).otherwise(none)
    rows = (
        F.when(F.col("m.type") == "human", F.array(part("user", F.col("m.content"))))
        .when(F.col("m.type") == "tool", F.array(part("tool_return", F.col("m.content"), F.col("m.tool_call_id"))))
        .when(F.col("m.type") == "ai", F.concat(reasoning, calls, said))
        .otherwise(none)
    )
    return parsed.select(*keys, F.posexplode(rows).alias("part", "r")).select(*keys, "part", "r.*")


def audio_messages(df: DataFrame, keys: list[str], payload: str) -> DataFrame:
    """The audio files that a conversation's JSON lists."""
    schema = "messages ARRAY<STRUCT<id: STRING, text: STRING, media: STRUCT<file: STRING, contentType: STRING>>>"
    each = df.select(*keys, F.explode(F.from_json(payload, schema)["messages"]).alias("x"))
    return each.where(F.col("x.media.contentType").startswith("audio")).select(*keys, F.col("x.id").alias("id"), F.col("x.media.file").alias("file"))


def quality_changes(df: DataFrame, level: str, labels: dict[str, str], reason: str) -> DataFrame:
    """Changes to YELLOW or RED with a label and a line of text."""
    names = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    kept = df.where(F.col(level).isin("YELLOW", "RED")).withColumn("rotulo", names[F.col(level)])
    return kept.withColumn("linha", F.concat(F.lit("- "), F.col("rotulo"), F.lit(": "), F.coalesce(reason, F.lit("sem motivo"))))
