"""Row gates that name the first thing wrong with a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_failure(checks: list[tuple[str, Column]]) -> Column:
    """Name of the first check whose condition holds, null if none does; an unknown condition doesn't hold."""
    out = F.lit(None).cast("string")
    for name, failed in reversed(checks):
        out = F.when(F.coalesce(failed, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def gate(df: DataFrame, checks: list[tuple[str, Column]], column: str = "drop_reason") -> DataFrame:
    return df.withColumn(column, first_failure(checks))


def reason_counts(df: DataFrame, column: str = "drop_reason", kept: str = "kept") -> DataFrame:
    """(column, n) over all rows; rows without a reason count under kept. Counted in the plan, so retries don't count twice."""
    return df.groupBy(F.coalesce(column, F.lit(kept)).alias(column)).agg(F.count(F.lit(1)).alias("n"))


def completed(df: DataFrame) -> Column:
    """A finished trajectory that has content and a measured reward."""
    return (F.col("status") == "completed") & F.col("has_trajectory") & ~F.col("has_exception") & F.col("reward").isNotNull() & ~F.isnan("reward")


def trainable(df: DataFrame) -> Column:
    return completed(df) & (F.col("reward") >= 1.0) & F.col("task_present_in_task_dataset")


def conversation_checks(turns: Column) -> list[tuple[str, Column]]:
    """Checks of a conversation of user and assistant turns, in order; of the turns, the first one wrong names the reason."""
    n = F.size(turns)
    roles = F.transform(turns, lambda m: m["role"])
    wrong = F.transform(
        turns,
        lambda m: F.when(m["content"].isNull(), "nonstring_message").when((m["role"] == "user") & (F.regexp_replace(m["content"], r"[\s\x0b\x1c-\x1f\x85\p{Z}]", "") == ""), "empty_user_turn"),
    )
    first = F.get(F.filter(wrong, lambda x: x.isNotNull()), F.lit(0))
    return [
        ("empty_conversation", turns.isNull() | (n == 0)),
        ("unexpected_role", F.exists(roles, lambda r: r.isNull() | ~r.isin("user", "assistant"))),
        ("no_user_prompt", roles[0] != "user"),
        ("nonstring_message", first == "nonstring_message"),
        ("empty_user_turn", first == "empty_user_turn"),
        ("not_assistant_terminated", F.element_at(roles, -1) != "assistant"),
        ("too_short", n < 2),
    ]


def tool_conversation_checks(turns: Column) -> list[tuple[str, Column]]:
    """Checks of a native conversation with a system turn first and exactly one user turn."""
    roles = F.transform(turns, lambda m: m["role"])
    count = lambda role: F.size(F.filter(roles, lambda r: r == role))
    return [
        ("empty_conversation", turns.isNull() | (F.size(turns) == 0)),
        ("unexpected_role", F.exists(roles, lambda r: r.isNull() | ~r.isin("system", "user", "assistant", "tool"))),
        ("no_system_prompt", roles[0] != "system"),
        ("not_one_user_turn", count("user") != 1),
        ("no_assistant_turn", count("assistant") == 0),
        ("empty_assistant_turn", F.exists(turns, lambda m: (m["role"] == "assistant") & (F.trim(F.coalesce(m["content"], F.lit(""))) == ""))),
    ]


def pair_checks(max_len: int, least_shared: int = 16, max_divergence: int = 64, max_ratio: float = 0.0) -> list[tuple[str, Column]]:
    """Checks of a pair on its columns of lengths, in order. max_ratio 0 checks no ratio."""
    checks = [
        ("too_long_chosen", F.col("chosen_n_tokens") > max_len),
        ("too_long_rejected", F.col("rejected_n_tokens") > max_len),
        ("no_trained_tokens", (F.col("chosen_n_trained") == 0) | (F.col("rejected_n_trained") == 0)),
        ("no_common_prefix", F.col("common_prefix_tokens") < least_shared),
        ("prompt_divergence", F.col("prompt_divergence_tokens") > max_divergence),
    ]
    if max_ratio:
        checks.append(("length_ratio", F.col("rejected_n_trained") > max_ratio * F.col("chosen_n_trained")))
    return checks
