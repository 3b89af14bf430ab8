"""Task pool: validated tasks with the pass rate of their group, tiers, and a guard against leaked verifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernix.functions.numeric import tier_of
from quernix.operators.gates import completed
from quernix.functions.text import group_key


def group_stats(trajectories: DataFrame) -> DataFrame:
    """(grp, n_trials, pass_rate) of groups over finished, measured trajectories."""
    clean = trajectories.where(completed(trajectories) & F.col("grp").isNotNull())
    return clean.groupBy("grp").agg(F.count("reward").alias("n_trials"), F.avg(F.when(F.col("reward") >= 1.0, 1.0).otherwise(0.0)).alias("pass_rate"))


def tiered_tasks(tasks: DataFrame, trajectories: DataFrame, least: int = 4) -> DataFrame:
    """tasks with grp, n_trials (0 without any), pass_rate and tier."""
    told = tasks.withColumn("grp", group_key(F.col("task_group_id"))).join(group_stats(trajectories), "grp", "left")
    told = told.withColumn("n_trials", F.coalesce("n_trials", F.lit(0)).cast("bigint"))
    return told.withColumn("tier", tier_of(F.col("n_trials"), F.col("pass_rate"), least))


def task_pool(tasks: DataFrame, trajectories: DataFrame, tier: str = "sweet", per_group: int = 0, max_tasks: int = 0) -> DataFrame:
    """Validated tasks of a tier (all: of any), the first per_group of a group by task_id, max_tasks at most; 0: no cap."""
    told = tiered_tasks(tasks.where("validation_status = 'passed'"), trajectories)
    if tier != "all":
        told = told.where(F.col("tier") == tier)
    if per_group:
        told = told.withColumn("__qx_n", F.row_number().over(Window.partitionBy("grp").orderBy("task_id"))).where(F.col("__qx_n") <= per_group).drop("__qx_n")
    return told.orderBy("task_id").limit(max_tasks) if max_tasks else told


VERIFIER_FILES = ("test_state.py", "test.sh")
TRACKED_FILES = ("instruction.md", "task.toml", "environment/Dockerfile", "solution/solve.sh", "tests/test.sh", "tests/test_state.py")


def leaked_verifiers(files: DataFrame) -> DataFrame:
    """(task_id, rel): the first file, by path, of a build context (environment/) that has the name or the content of
    the task's private verifier. files: (task_id, rel, sha256)."""
    name = F.substring_index("rel", "/", -1)
    context = files.where(F.col("rel").startswith("environment/"))
    private = files.where(F.col("rel").isin(*[f"tests/{x}" for x in VERIFIER_FILES])).select("task_id", "sha256").distinct()
    by_name = context.where(name.isin(*VERIFIER_FILES)).select("task_id", "rel")
    by_content = context.join(private, ["task_id", "sha256"], "left_semi").select("task_id", "rel")
    return by_name.unionByName(by_content).groupBy("task_id").agg(F.min("rel").alias("rel"))


def missing_files(files: DataFrame, required: tuple[str, ...] = TRACKED_FILES) -> DataFrame:
    """(task_id, missing) of tasks that lack tracked files. A task has few files of the required names."""
    have = files.where(F.col("rel").isin(*required)).groupBy("task_id").agg(F.collect_set("rel").alias("have"))
    told = files.select("task_id").distinct().join(have, "task_id", "left")
    missing = F.array_except(F.array(*[F.lit(x) for x in required]), F.coalesce("have", F.array().cast("array<string>")))
    return told.select("task_id", missing.alias("missing")).where(F.size("missing") > 0)
