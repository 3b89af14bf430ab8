"""Registry of queries and views they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernix.functions.tokens import bpe_sql
from quernix.operators.dedup import first_by
from quernix.queries.core_problems import group_key, model_key
from quernix.runtime import table


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        def keep(f: Callable[[SparkSession, str], DataFrame]):
            self.queries[name] = f
            if sql:
                self.sql[name] = sql
            return f

        return keep


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def r6(c: Column | str) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), 6)


def trajectories(spark: SparkSession, sf: str) -> DataFrame:
    """Valid trajectories: the latest row of each id, unmeasured rewards null, grp and model in one spelling."""
    t = table(spark, sf, "trajectories").where("trajectory_id is not null")
    t = t.withColumn("reward", F.when(~F.isnan("reward"), F.col("reward")))
    newest = first_by(t, ["trajectory_id"], [F.col("ingested_at").desc_nulls_last(), F.col("reward").desc_nulls_last(), F.col("task_group_id").desc_nulls_last(), F.col("model_name").desc_nulls_last()])
    return newest.withColumn("grp", group_key(F.col("task_group_id"))).withColumn("model", model_key(F.col("model_name")))


TRAJ = r"""traj AS (
  SELECT *, lower(regexp_replace(regexp_replace(task_group_id, '[@#][^@#]*\z', ''), '[^\pL\pN]', '', 'g')) AS grp,
    lower(regexp_replace(regexp_replace(model_name, '^.*/', '', 's'), '[^\pL\pN]', '', 'g')) AS model
  FROM (SELECT * REPLACE (CASE WHEN isnan(reward) THEN NULL ELSE reward END AS reward) FROM trajectories WHERE trajectory_id IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY trajectory_id ORDER BY ingested_at DESC NULLS LAST, reward DESC NULLS LAST, task_group_id DESC NULLS LAST, model_name DESC NULLS LAST) = 1
)"""


def _without_copies(t: DataFrame, key: list[str], columns: tuple[Column | str, ...]) -> DataFrame:
    """t without its exact copies. With columns, only these and the key, which tells rows that are no copies apart, are
    read and moved."""
    return t.select(*key, *columns).distinct() if columns else t.distinct()


def tasks(spark: SparkSession, sf: str, *columns: Column | str) -> DataFrame:
    return _without_copies(table(spark, sf, "tasks"), ["task_id"], columns)


TASKS = "task AS (SELECT DISTINCT * FROM tasks)"


def attempts(spark: SparkSession, sf: str, *columns: Column | str) -> DataFrame:
    return _without_copies(table(spark, sf, "attempts"), ["benchmark", "run", "task_id"], columns)


ATTEMPTS = "att AS (SELECT DISTINCT * FROM attempts)"


def sft(spark: SparkSession, sf: str, *columns: Column | str) -> DataFrame:
    return _without_copies(table(spark, sf, "sft_messages"), ["trajectory_id"], columns)


SFT = "sft AS (SELECT DISTINCT * FROM sft_messages)"


#: A conversation m as it is rendered, and the token ids of every conversation by trajectory_id (key), after SFT.
RENDER = """list_aggregate(list_transform(m, lambda x, i: '<|im_start|>' || x.role || chr(10) || CASE WHEN i = len(m) AND x.role = 'assistant' THEN '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) ELSE '' END || coalesce(x.content, '') || '<|im_end|>' || chr(10)), 'string_agg', '')"""
TOKENS = f"talk AS (SELECT trajectory_id AS key, {RENDER} AS text FROM (SELECT trajectory_id, messages AS m FROM sft)), {bpe_sql('talk')}"


def chats(spark: SparkSession, sf: str, *columns: Column | str) -> DataFrame:
    return _without_copies(table(spark, sf, "chat_source"), ["trial_name"], columns)


CHATS = "chat AS (SELECT DISTINCT * FROM chat_source)"
