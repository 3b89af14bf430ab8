"""Training conversations: gate, rotation over sources, repair, de-duplication, token counts, holdout."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernix.functions.pyfunctions import canonical_turns, content_hash
from quernix.functions.tokens import DEFAULT_TOKENIZER, with_conversation_tokens
from quernix.operators.dedup import greedy_two_key
from quernix.operators.gates import first_failure, trainable
from quernix.operators.selection import holdout_until, rotate_sources
from quernix.runtime import ship, stage

_ADDED = "n_assistant_turns bigint, n_rewritten_turns bigint, command_signature string, content_hash string, __qx_wrong string"


def _canonical(turns: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(turns)
            flat = col.flatten()
            roles, contents = flat.field("role").to_pylist(), flat.field("content").to_pylist()
            fixed, told, at = [], [], 0
            for n in pc.list_value_length(col).to_pylist():
                if not n:
                    told.append((None, None, None, None if n is None else content_hash([]), None))
                    continue
                rs = roles[at : at + n]
                texts, *counts, wrong = canonical_turns(rs, contents[at : at + n])
                told.append((*counts, content_hash([{"role": r, "content": c} for r, c in zip(rs, texts, strict=True)]), wrong))
                fixed += texts
                at += n
            sizes = pc.fill_null(pc.list_value_length(col), 0).to_numpy()
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            structs = pa.StructArray.from_arrays([flat.field("role"), pa.array(fixed, pa.string())], names=["role", "content"])
            again = pa.ListArray.from_arrays(ends, structs, mask=col.is_null())
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            added = [pa.array([t[k] for t in told], kind) for k, kind in enumerate(kinds)]
            names = b.schema.names
            kept = [again if name == turns else b.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*kept, *added], names=[*names, *(x.split()[0] for x in _ADDED.split(", "))])

    return run


def conversations(df: DataFrame, turns: str = "messages") -> DataFrame:
    """Conversations with agents' answers in canonical form: turns, n_assistant_turns, n_rewritten_turns,
    command_signature, content_hash and drop_reason, beside the other columns of df.

    A conversation is judged where it is, in Arrow batches, without a shuffle. The first turn that can't be used names
    the reason. Defined cases: null and empty turns are kept as they are and are an empty_conversation; of columns with
    the names of new ones those of df are replaced; turns need fields role and content, others are left out.
    """
    ship(df.sparkSession)
    m = F.col(turns)
    roles = F.transform(m, lambda x: x["role"])
    plain = df.drop(*(x.split()[0] for x in _ADDED.split(", ")), "drop_reason")
    plain = plain.withColumn(turns, F.transform(m, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))))
    schema = T.StructType([*plain.schema.fields, *T._parse_datatype_string(_ADDED).fields])
    told = plain.mapInArrow(_canonical(turns), schema)
    reason = first_failure(
        [
            ("empty_conversation", m.isNull() | (F.size(m) == 0)),
            ("unexpected_role", F.exists(roles, lambda r: r.isNull() | ~r.isin("user", "assistant"))),
            ("no_user_prompt", roles[0] != "user"),
        ]
    )
    ends = F.when(F.element_at(F.when(F.size(roles) > 0, roles), -1) != "assistant", "not_assistant_terminated").when(F.size(m) < 2, "too_short")
    return told.withColumn("drop_reason", F.coalesce(reason, F.col("__qx_wrong"), ends)).drop("__qx_wrong")


def build(trajectories: DataFrame, messages: DataFrame, per_group: int = 10, max_tokens: int = 32_768, holdout: int = 256, seed: int = 1228, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """Conversations to train on, with split: selection on metadata first, texts are read for selected rows only."""
    picked = rotate_sources(trajectories.where(trainable(trajectories)).select("trajectory_id", "grp", "model"), "grp", "model", "trajectory_id", per_group, seed)
    rows = messages.join(picked, "trajectory_id").dropDuplicates(["trajectory_id"])
    built = stage(conversations(rows).where("drop_reason is null"), "built")
    kept = greedy_two_key(built, "trajectory_id", "content_hash", ["grp", "command_signature"])
    # the ids aren't needed beyond their number here
    measured = with_conversation_tokens(kept, path=tokenizer).drop("loss_mask")
    sized = measured.withColumn("n_tokens", F.size("input_ids").cast("bigint")).drop("input_ids").where(F.col("n_tokens") <= max_tokens)
    # read three times by the holdout
    return holdout_until(stage(sized, "sized"), "grp", holdout, 0.15, seed)
