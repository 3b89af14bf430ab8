"""Streams: resumable scoring of new pairs, event windows, stages of growing logs, sessions from turns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from quernix.operators.sequences import assemble_turns
from quernix.sources.readers import existing


def score_new(spark: SparkSession, source: str, schema: StructType, score: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, key: str = "pair_id") -> None:
    """Scores rows of new files of source and appends them to sink, as far as they are there now. A row whose key is in
    sink already isn't scored again, so an interrupted run goes on where it was."""

    def write(batch: DataFrame, _: int) -> None:
        todo = batch
        if existing(spark, [sink]):
            # of the sink only the keys are read
            done = spark.read.schema(batch.select(key).schema).parquet(sink)
            todo = batch.join(done, key, "left_anti")
        score(todo.dropDuplicates([key])).write.mode("append").parquet(sink)

    q = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def event_windows(events: DataFrame, ts: str, width: str, late: str, keys: list[str]) -> DataFrame:
    """Counts of events by window of time and keys; later than `late` they don't count any more."""
    timed = events.withColumn("__qx_ts", F.col(ts).cast("timestamp")).withWatermark("__qx_ts", late)
    return timed.groupBy(F.window("__qx_ts", width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), *keys, "n")


def stage_of_lines(lines: DataFrame) -> DataFrame:
    """(file, line_no, text, stage) of a stream of log lines (file, line_no, text): the stage opened last in each file,
    null before and after. Lines of a file have to come in their order."""
    schema = "file string, line_no bigint, text string, stage string"

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get[0] if state.exists else None
        for pdf in batches:
            pdf = pdf.sort_values("line_no")
            stages = []
            for t in pdf["text"]:
                words = t.split(" ", 3) if t.startswith("=== ") else []
                if len(words) > 2 and words[1] in ("STAGE", "SKIP", "DONE", "FAILED"):
                    now = words[2] if words[1] == "STAGE" else None
                    stages.append(None)
                else:
                    stages.append(now)
            yield pdf.assign(stage=stages)[["file", "line_no", "text", "stage"]]
        state.update((now,))

    return lines.groupBy("file").applyInPandasWithState(step, schema, "stage string", "append", GroupStateTimeout.NoTimeout)


def sessions_of_turns(turns: DataFrame, last: str = "last") -> DataFrame:
    """(session_id, turns, n_ids, n_trained, diverged) of a stream of turns (session_id, turn_no, prompt_ids,
    response_ids, last): a session comes out when its turn marked last has come; its turns until then are the state."""
    state_schema = "turn_no array<bigint>, prompts array<array<int>>, responses array<array<int>>"

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        nos, prompts, responses = ([list(x) for x in state.get] if state.exists else ([], [], []))
        over = False
        for pdf in batches:
            nos += pdf["turn_no"].tolist()
            prompts += [list(map(int, x)) for x in pdf["prompt_ids"]]
            responses += [list(map(int, x)) for x in pdf["response_ids"]]
            over = over or bool(pdf[last].any())
        if not over:
            state.update((nos, prompts, responses))
            return
        state.remove()
        order = sorted(range(len(nos)), key=nos.__getitem__)
        got = assemble_turns([prompts[k] for k in order], [responses[k] for k in order])
        ids, mask = got or ([], [])
        yield pd.DataFrame({"session_id": [key[0]], "turns": [len(nos)], "n_ids": [len(ids)], "n_trained": [sum(mask)], "diverged": [got is None]})

    return turns.groupBy("session_id").applyInPandasWithState(step, "session_id string, turns bigint, n_ids bigint, n_trained bigint, diverged boolean", state_schema, "append", GroupStateTimeout.NoTimeout)
