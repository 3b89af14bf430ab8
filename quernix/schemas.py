"""Schemas of the tables and checks at the edge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_SIMPLE = {"string": T.StringType(), "boolean": T.BooleanType(), "double": T.DoubleType(), "int": T.IntegerType()}


def _columns(text: str) -> T.StructType:
    return T.StructType([T.StructField(name, _SIMPLE[kind]) for name, kind in (x.split() for x in text.split(","))])


MESSAGES = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]))
TRAJECTORIES = _columns(
    "trajectory_id string, task_group_id string, model_name string, status string, has_trajectory boolean, has_exception boolean, reward double, task_present_in_task_dataset boolean, shard string, member_prefix string"
)
TASKS = _columns("task_id string, task_group_id string, validation_status string, instruction string, dockerfile string, task_content_sha256 string, shard string, member_prefix string")
ATTEMPTS = _columns("benchmark string, run int, task_id string, reward double, infra_reason string, budget_reason string, seconds double, returncode int")
PAIR_LOGPS = _columns("pair_id string, split string, chosen_ref_logp double, rejected_ref_logp double, chosen_ref_n int, rejected_ref_n int")
_OBSERVATION = T.StructType([T.StructField("results", T.ArrayType(_columns("content string")))])
TRAJECTORY_RECORD = T.StructType([T.StructField("steps", T.ArrayType(T.StructType([*_columns("source string, message string").fields, T.StructField("observation", _OBSERVATION)])))])


def require_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df if it has all columns of schema with their types; an error naming what is missing or different otherwise."""
    have = {f.name: f.dataType for f in df.schema}
    wrong = [f"{f.name}: {f.dataType.simpleString()} expected, {have[f.name].simpleString() if f.name in have else 'missing'}" for f in schema if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError("; ".join(wrong))
    return df


def require_single_value(df: DataFrame, column: str) -> object:
    """The one value of a column; an error if there are several. Two rows at most come to the driver."""
    got = df.select(column).distinct().limit(2).collect()
    if len(got) > 1:
        raise ValueError(f"{column} has several values")
    return got[0][0] if got else None
