"""Conversations with native tool calls made into training rows: splice, repair, gates, flat roles, tokens, length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernix.functions import text as X
from quernix.functions.tokens import DEFAULT_TOKENIZER, with_conversation_tokens
from quernix.operators.gates import first_failure, tool_conversation_checks
from quernix.operators.sequences import splice_format_errors


def build_tool_rows(df: DataFrame, turns: str = "messages", system: str = "", max_tokens: int = 32_768, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """df with turns in flat roles, removed_turns, input_ids, loss_mask, n_tokens and drop_reason, null for rows to keep.

    In order: scolded answers go with their scoldings; of answers a surplus closing tag of reasoning and tool scaffolding
    at the end go; the conversation has to be a native one and free of control literals; it is flattened under the system
    prompt, rendered and encoded; one longer than max_tokens is dropped, never cut. Everything is within the row; only
    rows that pass the gates are encoded. Defined cases: null and empty turns are an empty_conversation without tokens.
    """
    kind = "array<struct<role: string, content: string>>"
    spliced = df.withColumn("__qx_s", F.when(F.col(turns).isNotNull(), splice_format_errors(F.col(turns))))
    repaired = F.transform(
        "__qx_s.messages",
        lambda m: F.struct(m["role"].alias("role"), F.when(m["role"] == "assistant", X.strip_scaffolding(X.repair_stray_think(m["content"]))).otherwise(m["content"]).alias("content")),
    )
    beyond = F.exists("__qx_s.messages", lambda m: (m["role"] == "assistant") & m["content"].isNotNull() & X.repair_stray_think(m["content"]).isNull())
    rows = spliced.withColumn("__qx_r", repaired)
    r = F.col("__qx_r")
    checks = [*tool_conversation_checks(F.col("__qx_s.messages")), ("stray_reasoning_tags", beyond), ("control_literal", F.exists(r, lambda m: X.has_any(F.coalesce(m["content"], F.lit("")), X.CONTROL_LITERALS)))]
    rows = rows.withColumn("drop_reason", first_failure(checks)).withColumn("removed_turns", F.coalesce("__qx_s.removed", F.lit(0)))
    flat = F.when(F.col("drop_reason").isNull(), X.pre_render(r, F.lit(system))).otherwise(F.lit(None).cast(kind))
    told = with_conversation_tokens(rows.withColumn("__flat", flat).drop("__qx_s", "__qx_r"), "__flat", tokenizer, opener=False)
    n = F.size("input_ids").cast("bigint")
    return told.withColumn(turns, F.coalesce("__flat", F.col(turns).cast(kind))).withColumn("n_tokens", n).withColumn("drop_reason", F.coalesce("drop_reason", F.when(n > max_tokens, "too_long"))).drop("__flat")
