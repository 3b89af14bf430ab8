"""Scores of repeated evaluation runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scorable() -> Column:
    """A trial that counts: measured, and not spoilt by infrastructure."""
    return F.col("reward").isNotNull() & F.col("infra_reason").isNull()


def solved() -> Column:
    return scorable() & (F.col("reward") >= 1.0)


def _rate(hit: Column, base: Column) -> Column:
    n = F.sum(base.cast("int"))
    return F.when(n > 0, 100.0 * F.sum((hit & base).cast("int")) / n).otherwise(0.0)


def run_rates(attempts: DataFrame) -> DataFrame:
    """Per benchmark and run: pass rate over scorable trials, and over those that didn't run out of budget."""
    verified = scorable() & F.col("budget_reason").isNull()
    return attempts.groupBy("benchmark", "run").agg(
        F.count(F.lit(1)).alias("trials"),
        F.sum(scorable().cast("int")).alias("scorable"),
        _rate(solved(), scorable()).alias("pass_rate"),
        _rate(solved(), verified).alias("pass_rate_budget_excluded"),
    )


def benchmark_summary(attempts: DataFrame) -> DataFrame:
    """Per benchmark: mean and sample deviation of its runs (0 for one run), and rates of failures."""
    runs = run_rates(attempts).groupBy("benchmark").agg(
        F.count(F.lit(1)).alias("runs"),
        F.avg("pass_rate").alias("pass_rate_mean"),
        F.coalesce(F.stddev_samp("pass_rate"), F.lit(0.0)).alias("pass_rate_std"),
        F.avg("pass_rate_budget_excluded").alias("pass_rate_mean_budget_excluded"),
    )
    failed = attempts.groupBy("benchmark").agg(
        F.count(F.lit(1)).alias("trials_total"),
        F.sum(scorable().cast("int")).alias("trials_scorable"),
        (100.0 * F.count("infra_reason") / F.count(F.lit(1))).alias("infra_failure_rate"),
        (100.0 * F.count("budget_reason") / F.count(F.lit(1))).alias("agent_budget_rate"),
    )
    return runs.join(failed, "benchmark")


def task_summary(attempts: DataFrame) -> DataFrame:
    return attempts.groupBy("benchmark", "task_id").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.sum(solved().cast("int")).alias("solved"),
        F.count("infra_reason").alias("infra"),
        F.count("budget_reason").alias("budget"),
    )


def pass_at_k(attempts: DataFrame) -> DataFrame:
    """Per benchmark: share of tasks solved in any run, and how many never were."""
    per_task = task_summary(attempts)
    return per_task.groupBy("benchmark").agg(
        F.count(F.lit(1)).alias("tasks"), (100.0 * F.avg((F.col("solved") > 0).cast("double"))).alias("pass_at_k"), F.sum((F.col("solved") == 0).cast("int")).alias("never_solved")
    )


def reason_histogram(attempts: DataFrame, column: str) -> DataFrame:
    return attempts.where(F.col(column).isNotNull()).groupBy("benchmark", F.col(column).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def infra(reason: Column) -> Column:
    return F.struct(F.lit(None).cast("double").alias("reward"), F.lit("harness_infra").alias("kind"), reason.alias("reason"))


def budget(reason: Column) -> Column:
    return F.struct(F.lit(0.0).alias("reward"), F.lit("agent_budget").alias("kind"), reason.alias("reason"))


def scored(reward: Column) -> Column:
    return F.struct(reward.cast("double").alias("reward"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("reason"))


def refine(outcome: Column, marker: Column, kind: Column) -> Column:
    """An outcome after its log was read: a score holds, infrastructure is never turned into budget."""
    keep = (outcome["reward"].isNotNull() & outcome["kind"].isNull()) | kind.isNull() | ((outcome["kind"] == "harness_infra") & (kind == "agent_budget"))
    return F.when(keep, outcome).when(kind == "harness_infra", infra(marker)).otherwise(budget(marker))


def result_outcome(payload: Column, kind: Column, marker: Column) -> Column:
    """Outcome of one result document (JSON text, null if unreadable); kind and marker class its exception."""
    exception = F.get_json_object(payload, "$.exception_info")
    reward = F.get_json_object(payload, "$.verifier_result.rewards.reward").try_cast("double")
    failed = exception.isNotNull() & ~exception.isin("", "{}", "[]", "false", "0")
    return (
        F.when(payload.isNull(), infra(F.lit("unreadable result")))
        .when(failed & (kind == "agent_budget"), budget(F.coalesce(marker, F.lit("agent budget exceeded"))))
        .when(failed, infra(F.coalesce(marker, F.lit("harness exception"))))
        .when(reward.isNotNull(), scored(reward))
        .otherwise(infra(F.lit("no verifier reward")))
    )
