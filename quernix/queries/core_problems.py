"""Queries of the core problems: caps per contributor, grouped splits, near-duplicate conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernix.functions.text import group_key, model_key
from quernix.operators.caps import cap_contributors
from quernix.operators.neardup import SignatureJoin, expand_pairs, near_duplicate_classes, near_duplicate_groups
from quernix.operators.splits import assign_splits, tie_entities
from quernix.runtime import stage, table

PER_GROUP_AND_MODEL, PER_GROUP = 5, 20
PROPORTIONS = {"train": 0.8, "validation": 0.1, "test": 0.1}
CONVERSATIONS = SignatureJoin(width=3, similarity=0.6)


def valid_trajectories(spark: SparkSession, sf: str) -> DataFrame:
    """One row per trajectory_id, that of the latest ingested_at; of equal ones the better reward."""
    t = table(spark, sf, "trajectories").where("trajectory_id is not null")
    reward = F.when(F.isnan("reward"), None).otherwise(F.col("reward"))
    newest = t.groupBy("trajectory_id").agg(F.max(F.struct("ingested_at", reward.alias("reward"), "task_group_id", "model_name")).alias("r"))
    return newest.select("trajectory_id", "r.task_group_id", "r.model_name", "r.reward")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    rows = valid_trajectories(spark, sf).where("task_group_id is not null and model_name is not null")
    rows = stage(rows.select("trajectory_id", group_key(F.col("task_group_id")).alias("g"), model_key(F.col("model_name")).alias("m"), "reward"), "valid")
    first = stage(cap_contributors(rows, ["g", "m"], PER_GROUP_AND_MODEL, "reward", "trajectory_id"), "first-cap")
    kept = cap_contributors(first, ["g"], PER_GROUP, "reward", "trajectory_id")
    return rows.select("trajectory_id").join(kept.select("trajectory_id"), "trajectory_id", "left_anti")


P2_FOUND_SQL = r"""
WITH newest AS (
  SELECT trajectory_id, task_group_id, model_name, CASE WHEN isnan(reward) THEN NULL ELSE reward END AS reward
  FROM trajectories WHERE trajectory_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY trajectory_id ORDER BY ingested_at DESC NULLS LAST, CASE WHEN isnan(reward) THEN NULL ELSE reward END DESC NULLS LAST, task_group_id DESC NULLS LAST, model_name DESC NULLS LAST) = 1
), keyed AS (
  SELECT trajectory_id, reward,
    lower(regexp_replace(regexp_replace(task_group_id, '[@#][^@#]*\z', ''), '[^\pL\pN]', '', 'g')) AS g,
    lower(regexp_replace(regexp_replace(model_name, '^.*/', '', 's'), '[^\pL\pN]', '', 'g')) AS m
  FROM newest WHERE task_group_id IS NOT NULL AND model_name IS NOT NULL
), one AS (
  SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY g, m ORDER BY reward DESC NULLS LAST, trajectory_id) <= 5
), two AS (
  SELECT * FROM one QUALIFY row_number() OVER (PARTITION BY g ORDER BY reward DESC NULLS LAST, trajectory_id) <= 20
)
SELECT trajectory_id FROM keyed WHERE trajectory_id NOT IN (SELECT trajectory_id FROM two)
"""


def p2_share(spark: SparkSession, sf: str) -> DataFrame:
    """Rows a model keeps when none may hold more than a twentieth of all rows."""
    rows = valid_trajectories(spark, sf).where("model_name is not null").withColumn("m", model_key(F.col("model_name")))
    kept = cap_contributors(stage(rows, "valid"), ["m"], None, "reward", "trajectory_id", share=0.05)
    return kept.groupBy("m").agg(F.count(F.lit(1)).alias("kept_rows"), F.sum(F.coalesce("reward", F.lit(0.0))).alias("kept_reward"))


P2_SHARE_SQL = r"""
WITH newest AS (
  SELECT trajectory_id, model_name, CASE WHEN isnan(reward) THEN NULL ELSE reward END AS reward FROM trajectories WHERE trajectory_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY trajectory_id ORDER BY ingested_at DESC NULLS LAST, CASE WHEN isnan(reward) THEN NULL ELSE reward END DESC NULLS LAST, task_group_id DESC NULLS LAST, model_name DESC NULLS LAST) = 1
), keyed AS (
  SELECT trajectory_id, reward, lower(regexp_replace(regexp_replace(model_name, '^.*/', '', 's'), '[^\pL\pN]', '', 'g')) AS m
  FROM newest WHERE model_name IS NOT NULL
), kept AS (
  SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY m ORDER BY reward DESC NULLS LAST, trajectory_id) <= (SELECT floor(0.05 * count(*)) FROM keyed)
)
SELECT m, count(*) AS kept_rows, sum(coalesce(reward, 0.0)) AS kept_reward FROM kept GROUP BY m
"""


def _group_entities() -> dict[str, Column]:
    g = F.col("task_group_id")
    return {"written": g, "group": group_key(g)}


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    ties = tie_entities(table(spark, sf, "trajectories"), _group_entities())
    written = ties.where(F.col("node").startswith("written:")).select(F.substring("node", len("written:") + 1, 2**31 - 1).alias("value"), "component")
    a = written.select(F.col("value").alias("task_group_id_a"), "component")
    b = written.select(F.col("value").alias("task_group_id_b"), "component")
    return a.join(b, "component").where("task_group_id_a < task_group_id_b").select("task_group_id_a", "task_group_id_b")


P4_FOUND_SQL = r"""
WITH v AS (
  SELECT DISTINCT task_group_id AS x, lower(regexp_replace(regexp_replace(task_group_id, '[@#][^@#]*\z', ''), '[^\pL\pN]', '', 'g')) AS k
  FROM trajectories WHERE task_group_id IS NOT NULL
)
SELECT a.x AS task_group_id_a, b.x AS task_group_id_b FROM v a JOIN v b ON a.k = b.k AND a.x < b.x
"""


def p4_splits(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "trajectories").select("trajectory_id", "task_group_id")
    return assign_splits(rows, _group_entities(), "trajectory_id", PROPORTIONS, seed="42").select("trajectory_id", "task_group_id", "split")


P4_SPLITS_SQL = r"""
WITH RECURSIVE rows AS (
  SELECT trajectory_id, task_group_id, CASE WHEN task_group_id IS NULL THEN 'record:' || coalesce(trajectory_id, '')
    ELSE 'group:' || lower(regexp_replace(regexp_replace(task_group_id, '[@#][^@#]*\z', ''), '[^\pL\pN]', '', 'g')) END AS c FROM trajectories
), sizes AS (SELECT c, count(*) AS n FROM rows GROUP BY 1
), tot AS (SELECT count(*)::DOUBLE AS t FROM rows
), heavy AS (SELECT c, n, row_number() OVER (ORDER BY n DESC, c) AS k FROM sizes, tot WHERE n > 0.01 * t
), placed(k, c, split, train, validation, test) AS (
  SELECT 0::BIGINT, NULL::VARCHAR, NULL::VARCHAR, 0.8 * t, 0.1 * t, 0.1 * t FROM tot
  UNION ALL
  SELECT k, c, s, train - CASE WHEN s = 'train' THEN n ELSE 0 END, validation - CASE WHEN s = 'validation' THEN n ELSE 0 END, test - CASE WHEN s = 'test' THEN n ELSE 0 END
  FROM (SELECT h.k, h.c, h.n, p.train, p.validation, p.test, CASE WHEN p.validation >= p.train AND p.validation >= p.test THEN 'validation' WHEN p.train >= p.test THEN 'train' ELSE 'test' END AS s FROM placed p JOIN heavy h ON h.k = p.k + 1)
), rest AS (SELECT greatest(0, train) AS a, greatest(0, validation) AS b, greatest(0, test) AS d FROM placed ORDER BY k DESC LIMIT 1
), hashed AS (SELECT r.*, ('0x' || substr(sha256('42:' || r.c), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS h FROM rows r)
SELECT trajectory_id, task_group_id, coalesce(p.split, CASE WHEN h < a / (a + b + d) THEN 'train' WHEN h < a / (a + b + d) + b / (a + b + d) THEN 'validation' ELSE 'test' END) AS split
FROM hashed CROSS JOIN rest LEFT JOIN placed p ON p.c = hashed.c
"""


def _conversations(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    text = F.array_join(F.col("messages.content"), " ")
    return near_duplicate_classes(table(spark, sf, "sft_messages"), "trajectory_id", text, CONVERSATIONS)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    pairs = expand_pairs(*_conversations(spark, sf))
    return pairs.select(F.col("id_a").alias("trajectory_id_a"), F.col("id_b").alias("trajectory_id_b"))


def p5_groups(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicate_groups(*_conversations(spark, sf)).withColumnRenamed("id", "trajectory_id")


QUERIES = {"p2_found": p2_found, "p2_share": p2_share, "p4_found": p4_found, "p4_splits": p4_splits, "p5_found": p5_found, "p5_groups": p5_groups}
SQL = {"p2_found": P2_FOUND_SQL, "p2_share": P2_SHARE_SQL, "p4_found": P4_FOUND_SQL, "p4_splits": P4_SPLITS_SQL}
