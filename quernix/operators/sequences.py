"""Folds over ordered rows: repairs of turns, next-fit groups, stages of logs, assembled sessions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernix.functions import text as X


def repaired_turns(turns: DataFrame, conversation: str, turn: str, role: str, content: str, rewritten: str) -> DataFrame:
    """Content of user turns without a warning preamble where the last assistant turn before was rewritten."""
    before = F.last(F.when(F.col(role) == "assistant", F.col(rewritten)), ignorenulls=True).over(Window.partitionBy(conversation).orderBy(turn).rowsBetween(Window.unboundedPreceding, -1))
    fixed = F.when((F.col(role) == "user") & F.coalesce(before, F.lit(False)), X.strip_warning_preamble(F.col(content))).otherwise(F.col(content))
    return turns.withColumn(content, fixed)


def splice_format_errors(messages: Column) -> Column:
    """(messages, removed): every user turn that scolds for a format goes, with the assistant turn last kept before it.
    An opening turn is never taken for one."""
    kind = "array<struct<role: string, content: string>>"

    def step(acc: Column, m: Column) -> Column:
        out, n = acc["messages"], acc["removed"]
        scolding = X.is_format_error(m["role"], m["content"]) & (F.size(out) > 0)
        culprit = F.element_at(out, -1)["role"] == "assistant"
        popped = F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0)))
        return F.when(scolding & culprit, F.struct(popped.alias("messages"), (n + 1).alias("removed"))).when(scolding, acc).otherwise(
            F.struct(F.concat(out, F.array(F.struct(m["role"].alias("role"), m["content"].alias("content")))).alias("messages"), n.alias("removed"))
        )

    start = F.struct(F.array().cast(kind).alias("messages"), F.lit(0).alias("removed"))
    return F.aggregate(messages, start, step)


def next_fit(sizes: Column, limit: int) -> Column:
    """0-based group of each size of an ordered array: a new group starts where the next size doesn't fit any more."""
    start = F.struct(F.array().cast("array<bigint>").alias("groups"), F.lit(0).cast("bigint").alias("group"), F.lit(0).cast("bigint").alias("used"))

    def step(acc: Column, s: Column) -> Column:
        fresh = (acc["used"] + s > limit) & (acc["used"] > 0)
        g = acc["group"] + fresh.cast("bigint")
        return F.struct(F.concat(acc["groups"], F.array(g)).alias("groups"), g.alias("group"), (F.when(fresh, F.lit(0)).otherwise(acc["used"]) + s).alias("used"))

    return F.aggregate(sizes, start, step, lambda acc: acc["groups"])


def stage_lines(lines: DataFrame, file: str, line_no: str, text: str, wanted: str) -> DataFrame:
    """Lines of a log that belong to a stage: from its opening marker to the next marker of any kind. A file without an
    opening marker belongs wholly."""
    kind = F.regexp_extract(text, r"^=== (STAGE|SKIP|DONE|FAILED) (\S+)", 1)
    name = F.regexp_extract(text, r"^=== (STAGE|SKIP|DONE|FAILED) (\S+)", 2)
    order = Window.partitionBy(file).orderBy(line_no)
    marked = lines.withColumn("__qx_kind", kind).withColumn("__qx_at", F.last(F.when(kind != "", F.concat(kind, F.lit(" "), name)), ignorenulls=True).over(order))
    staged = F.max((F.col("__qx_kind") == "STAGE").cast("int")).over(Window.partitionBy(file))
    marked = marked.withColumn("__qx_any", staged)
    return marked.where(((F.col("__qx_at") == f"STAGE {wanted}") & (F.col("__qx_kind") == "")) | (F.col("__qx_any") == 0)).drop("__qx_kind", "__qx_at", "__qx_any")


def curve(lines: DataFrame, file: str, line_no: str, text: str) -> DataFrame:
    """(step, loss, grad_norm, lr, repeats) of the first line of each step over all files, by file and line."""
    fields = X.log_fields(F.col(text))
    rows = lines.select(file, line_no, *[c.alias(k) for k, c in fields.items()]).where("loss is not null and step is not null")
    first = F.min_by(F.struct("loss", "grad_norm", "lr"), F.struct(file, line_no)).alias("f")
    return rows.groupBy("step").agg(first, (F.count(F.lit(1)) - 1).alias("repeats")).select("step", "f.loss", "f.grad_norm", "f.lr", "repeats")


def assemble_turns(prompts: list, responses: list) -> tuple[list[int], list[int]] | None:
    """Token ids and mask of a session whose prompts each repeat what went before; None if one doesn't."""
    ids: list[int] = []
    mask: list[int] = []
    for p, r in zip(prompts, responses, strict=True):
        p, r = list(p), list(r)
        if p[: len(ids)] != ids:
            return None
        new = p[len(ids) :]
        ids += new + r
        mask += [0] * len(new) + [1] * len(r)
    return ids, mask


def assemble_sessions(turns: DataFrame) -> DataFrame:
    """(session_id, turns, input_ids, mask, diverged) from (session_id, turn_no, prompt_ids, response_ids). A session is
    as long as its last prompt, so a group is bounded by the context length."""

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("turn_no")
        got = assemble_turns(pdf["prompt_ids"].tolist(), pdf["response_ids"].tolist())
        ids, mask = got or ([], [])
        return pd.DataFrame({"session_id": [key[0]], "turns": [len(pdf)], "input_ids": [ids], "mask": [mask], "diverged": [got is None]})

    return turns.groupBy("session_id").applyInPandas(one, "session_id string, turns bigint, input_ids array<int>, mask array<int>, diverged boolean")
