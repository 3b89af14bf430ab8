"""Preference pairs: candidates of both outcomes, pairs within a prompt, token columns and ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernix.functions import arrays as A
from quernix.functions.text import canonical_prompt
from quernix.functions.tokens import DEFAULT_TOKENIZER, with_conversation_tokens
from quernix.operators.dedup import first_by
from quernix.operators.gates import completed
from quernix.operators.selection import balanced_sides, form_pairs, pair_id
from quernix.runtime import stage


def mixed_groups(clean: DataFrame) -> DataFrame:
    """(grp, n, wins, fails) of groups that have both outcomes."""
    stats = clean.where("grp is not null").groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("reward") >= 1.0).cast("bigint")).alias("wins"))
    return stats.withColumn("fails", F.col("n") - F.col("wins")).where("wins > 0 and fails > 0")


def candidates(trajectories: DataFrame, per_side: int = 14, across: bool = True, seed: int = 1228) -> DataFrame:
    clean = trajectories.where(completed(trajectories)).select("trajectory_id", "grp", "model", "reward")
    pool = clean.join(mixed_groups(clean).select("grp"), "grp", "left_semi").where("model is not null")
    return balanced_sides(pool, "grp", "model", "trajectory_id", F.col("reward") >= 1.0, per_side, seed, across)


def token_rows(messages: DataFrame, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """(trajectory_id, prompt, ids, mask) of conversations, one row an id."""
    one = first_by(messages.where("trajectory_id is not null and size(messages) > 0"), ["trajectory_id"], [F.sha2(F.to_json("messages"), 256)])
    m = F.col("messages")
    told = with_conversation_tokens(one.select("trajectory_id", "messages"), path=tokenizer)
    return told.select("trajectory_id", F.coalesce(m[0]["content"], F.lit("")).alias("prompt"), F.col("input_ids").alias("ids"), F.col("loss_mask").alias("mask"))


def build_pairs(trajectories: DataFrame, messages: DataFrame, per_side: int = 14, cap: int = 4, across: bool = True, key: str = "prompt_sha256") -> DataFrame:
    """Pairs of a solved and an unsolved conversation on the same canonical prompt (key grp: in the same group), with
    lengths and prefixes.

    Only hashes and numbers go through the pairing; token arrays are joined in at the end, once for each side.
    """
    picked = candidates(trajectories, per_side, across)
    tokens = stage(token_rows(messages.join(picked.select("trajectory_id"), "trajectory_id", "left_semi")), "tokens")
    members = picked.join(tokens.select("trajectory_id", F.sha2(canonical_prompt(F.col("prompt")), 256).alias("prompt_sha256")), "trajectory_id")
    members = stage(members, "members")
    paired = form_pairs(members, key, "model", "trajectory_id", "win", cap, across)
    side = members.select("trajectory_id", "grp", "model", F.col("prompt_sha256").alias("sha")).join(tokens.select("trajectory_id", "ids", "mask"), "trajectory_id")
    c = side.select(F.col("trajectory_id").alias("chosen"), F.col("grp").alias("task_group_id"), "sha", F.col("model").alias("chosen_model"), F.col("ids").alias("cids"), F.col("mask").alias("cmask"))
    r = side.select(F.col("trajectory_id").alias("rejected"), F.col("model").alias("rejected_model"), F.col("ids").alias("rids"), F.col("mask").alias("rmask"))
    both = paired.join(c, "chosen").join(r, "rejected")
    shared = A.common_prefix_len(F.col("cids"), F.col("rids"))
    return both.select(
        pair_id(F.col("chosen"), F.col("rejected")).alias("pair_id"), F.col("sha").alias("prompt_sha256"), "task_group_id",
        F.col("chosen").alias("chosen_trajectory_id"), F.col("rejected").alias("rejected_trajectory_id"), "chosen_model", "rejected_model",
        (F.col("chosen_model") == F.col("rejected_model")).alias("same_model"),
        F.col("cids").alias("chosen_input_ids"), F.col("cmask").alias("chosen_loss_mask"), F.col("rids").alias("rejected_input_ids"), F.col("rmask").alias("rejected_loss_mask"),
        F.size("cids").cast("bigint").alias("chosen_n_tokens"), F.size("rids").cast("bigint").alias("rejected_n_tokens"),
        A.total(F.col("cmask")).alias("chosen_n_trained"), A.total(F.col("rmask")).alias("rejected_n_trained"),
        shared.alias("common_prefix_tokens"), A.first_supervised(F.col("cmask")).alias("prompt_tokens"), A.prompt_divergence(F.col("cmask"), shared).alias("prompt_divergence_tokens"),
    )
