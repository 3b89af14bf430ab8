"""Sources, sinks and streams by round trips, and whole plans."""

from __future__ import annotations

import io
import tarfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernix.functions import arrays as A
from quernix.functions import text as X
from quernix.plans import evaluation as E
from quernix.plans import sft_build, task_pool
from quernix.functions.tokens import with_conversation_tokens
from quernix.queries.base import TOKENS, ATTEMPTS, CHATS, SFT, TASKS, TRAJ, Registry, attempts, big, chats, r6, sft, tasks, trajectories
from quernix.queries.gates import pairs
from quernix.runtime import scratch, ship, table
from quernix.sources import readers as S
from quernix.sources import writers as K
from quernix.streaming import incremental as I

R = Registry()


def _archives(spark: SparkSession, sf: str) -> DataFrame:
    """Tasks as tar archives, one for each shard."""
    ship(spark)

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w") as tar:
            for prefix, text, docker in zip(pdf["member_prefix"], pdf["instruction"], pdf["dockerfile"], strict=True):
                for name, body in (("instruction.md", text or ""), ("environment/Dockerfile", docker or "")):
                    info = tarfile.TarInfo(f"{prefix}/{name}")
                    info.size = len(body.encode())
                    tar.addfile(info, io.BytesIO(body.encode()))
        return pd.DataFrame({"path": [key[0]], "content": [out.getvalue()]})

    t = tasks(spark, sf).dropDuplicates(["task_id"]).select("shard", "member_prefix", "instruction", "dockerfile")
    return t.groupBy("shard").applyInPandas(pack, "path string, content binary")


@R.add("s04_tar_members", f"WITH {TASKS} SELECT task_id, sha256(coalesce(instruction, '')) AS sha FROM task")
def s04(spark: SparkSession, sf: str) -> DataFrame:
    wanted = table(spark, sf, "tasks").select("task_id", "shard", "member_prefix").distinct()
    got = S.wanted_members(S.expand_tars(_archives(spark, sf)), wanted, "instruction.md")
    return got.select("task_id", F.sha2("content", 256).alias("sha"))


@R.add("s05_tar_extract", f"WITH {TASKS} SELECT task_id, 'instruction.md' AS rel, octet_length(encode(coalesce(instruction, '')))::BIGINT AS n FROM task UNION ALL SELECT task_id, 'environment/Dockerfile', octet_length(encode(coalesce(dockerfile, '')))::BIGINT FROM task")
def s05(spark: SparkSession, sf: str) -> DataFrame:
    wanted = table(spark, sf, "tasks").select("task_id", "shard", "member_prefix").distinct()
    return S.under_prefix(S.expand_tars(_archives(spark, sf)), wanted).select("task_id", "rel", big(F.length("content")).alias("n"))


@R.add("s06_json_documents", f"WITH {TASKS} SELECT count(*)::BIGINT AS tasks, count(DISTINCT shard)::BIGINT AS shards FROM task")
def s06(spark: SparkSession, sf: str) -> DataFrame:
    """A manifest written as a JSON document and read back; its counts."""
    path = scratch(spark, "manifest")
    K.write_manifest(tasks(spark, sf, "shard").agg(F.count(F.lit(1)).alias("tasks"), F.countDistinct("shard").alias("shards")), path + "/manifest.json", seed=1228)
    doc = S.json_documents(spark, path)
    return doc.select(*[F.try_variant_get("document", f"$.{c}", "bigint").alias(c) for c in ("tasks", "shards")])


@R.add("s07_json_lines", f"WITH {TASKS} SELECT task_id, instruction, validation_status FROM task")
def s07(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "lines")
    K.write_json_lines(tasks(spark, sf).select("task_id", "instruction", "validation_status"), path)
    return S.json_lines(spark, path, "task_id string, instruction string, validation_status string")


@R.add("s08_signed_cache", f"WITH {TASKS} SELECT shard, count(*)::BIGINT AS n FROM task GROUP BY 1")
def s08(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch(spark, "cache")
    key = K.cache_signature(sf=sf, seed=1228)
    build = lambda: tasks(spark, sf, "shard").groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    K.cached(spark, folder, key, build)
    return K.cached(spark, folder, key, lambda: spark.range(0).toDF("never"))


@R.add("s14_split_loader", f"WITH {TRAJ} SELECT coalesce(status, '?') AS split, count(*)::BIGINT AS n FROM traj WHERE status = 'completed' GROUP BY 1")
def s14(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "splits")
    K.write_splits(trajectories(spark, sf).select("trajectory_id", F.coalesce("status", F.lit("?")).alias("split")), path)
    return S.split_table(spark, path, "completed").groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@R.add("s16_registry", "SELECT 'a' AS key, 'h80' AS memory_class, 4 AS tp, 1 AS pp UNION ALL SELECT 'b', NULL, 1, 1")
def s16(spark: SparkSession, sf: str) -> DataFrame:
    reg = spark.createDataFrame([("a", None, 2, 2), ("a", "h80", 4, None), ("b", None, None, None)], "key string, memory_class string, tp int, pp int")
    return S.registry_rows(reg, "a", "h80").unionByName(S.registry_rows(reg, "b", "h80"))


@R.add("k01_messages_table", f"WITH {SFT} SELECT trajectory_id, n_tokens, n_assistant_turns, len(messages)::BIGINT AS turns FROM sft")
def k01(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "messages")
    K.write_messages(sft(spark, sf), path)
    return spark.read.parquet(path).select("trajectory_id", "n_tokens", "n_assistant_turns", big(F.size("messages")).alias("turns"))


def token_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = sft(spark, sf).select("messages", "trajectory_id", "task_group_id", "model_name")
    t = with_conversation_tokens(rows).drop("messages")
    return t.withColumn("n_tokens", big(F.size("input_ids"))).withColumn("n_trained_tokens", A.total(F.col("loss_mask")))


@R.add("k02_token_table", f"WITH RECURSIVE {SFT}, {TOKENS} SELECT key AS trajectory_id, len(ids)::BIGINT AS n_tokens, coalesce(list_sum(ids), 0)::BIGINT AS ids_sum FROM encoded")
def k02(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "tokens")
    K.write_tokens(token_table(spark, sf), path)
    return spark.read.parquet(path).select("trajectory_id", "n_tokens", A.total(F.col("input_ids")).alias("ids_sum"))


@R.add("k04_manifest", f"WITH {SFT} SELECT count(*)::BIGINT AS n_rows, count(DISTINCT task_group_id)::BIGINT AS n_groups, sum(coalesce(n_tokens, 0))::BIGINT AS total_tokens, round(quantile_cont(coalesce(n_tokens, 0), 0.9), 6) AS p90 FROM sft")
def k04(spark: SparkSession, sf: str) -> DataFrame:
    return K.manifest_row(sft(spark, sf, "n_tokens", "task_group_id", "model_name"), "n_tokens", "task_group_id", "model_name").select("n_rows", "n_groups", "total_tokens", r6("p90").alias("p90"))


_POOL = f"""{TRAJ}, {TASKS}, s AS (SELECT grp, count(*)::BIGINT AS n, avg(CASE WHEN reward >= 1.0 THEN 1.0 ELSE 0.0 END) AS p FROM traj WHERE status = 'completed' AND has_trajectory AND NOT has_exception AND reward IS NOT NULL AND grp IS NOT NULL GROUP BY 1),
k AS (SELECT *, lower(regexp_replace(regexp_replace(task_group_id, '[@#][^@#]*\\z', ''), '[^\\pL\\pN]', '', 'g')) AS grp FROM task WHERE validation_status = 'passed')"""


@R.add("k05_task_pool", f"WITH {_POOL} SELECT task_id AS label, CASE WHEN regexp_extract(coalesce(dockerfile, ''), '(?im)^\\s*FROM\\s+(\\S+)', 1) = '' THEN '?' ELSE regexp_extract(dockerfile, '(?im)^\\s*FROM\\s+(\\S+)', 1) END AS image, round(p, 6) AS pass_rate, n AS trials FROM k JOIN s USING (grp) WHERE n >= 4 AND p >= 0.1 AND p < 0.9")
def k05(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "pool")
    pool = task_pool.task_pool(tasks(spark, sf), trajectories(spark, sf), "sweet")
    K.write_json_lines(K.task_pool_rows(pool, "/data/tasks"), path)
    back = S.json_lines(spark, path, "prompt string, label string, metadata struct<task_id: string, base_image: string, empirical_pass_rate: double, n_reference_trials: bigint, task_dir: string>")
    return back.select("label", F.col("metadata.base_image").alias("image"), r6("metadata.empirical_pass_rate").alias("pass_rate"), F.col("metadata.n_reference_trials").alias("trials"))


@R.add("k12_portable_pool", f"WITH {_POOL} SELECT task_id AS label, 'tasks/' || task_id AS task_dir FROM k JOIN s USING (grp) WHERE n >= 4 AND p >= 0.0 AND p < 0.1")
def k12(spark: SparkSession, sf: str) -> DataFrame:
    pool = task_pool.task_pool(tasks(spark, sf), trajectories(spark, sf), "hard")
    return K.portable(K.task_pool_rows(pool, "/data/tasks")).select("label", F.col("metadata.task_dir").alias("task_dir"))


@R.add("plan_task_pool", f"WITH {_POOL}, r AS (SELECT task_id, grp FROM k JOIN s USING (grp) WHERE n >= 4 AND p >= 0.1 AND p < 0.9 QUALIFY row_number() OVER (PARTITION BY grp ORDER BY task_id) <= 2) SELECT task_id, grp FROM r")
def plan_pool(spark: SparkSession, sf: str) -> DataFrame:
    return task_pool.task_pool(tasks(spark, sf), trajectories(spark, sf), "sweet", per_group=2).select("task_id", "grp")


@R.add("plan_sft_build")
def plan_sft(spark: SparkSession, sf: str) -> DataFrame:
    built = sft_build.build(trajectories(spark, sf), table(spark, sf, "sft_messages"))
    return built.select("trajectory_id", "grp", "model", "n_tokens", "n_assistant_turns", "n_rewritten_turns", "split")


@R.add("plan_pair_build")
def plan_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pairs(spark, sf).select("pair_id", "chosen_trajectory_id", "rejected_trajectory_id", "same_model", "chosen_n_tokens", "rejected_n_tokens", "common_prefix_tokens")


@R.add("plan_chat_conversion")
def plan_chat(spark: SparkSession, sf: str) -> DataFrame:
    """Reasons for which chat conversations can't be used as agents' conversations."""
    return sft_build.conversations(chats(spark, sf), "conversations").groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason")).agg(F.count(F.lit(1)).alias("n"))


@R.add("r01_data_findings", f"WITH RECURSIVE {SFT}, {TOKENS}, t AS (SELECT count(*) FILTER (len(ids) > 600) AS long, (SELECT count(*) FROM sft WHERE coalesce(len(list_filter(messages, lambda m: m.role = 'assistant')), 0) = 0) AS bare FROM encoded) SELECT 'data' AS area, 'too_long' AS \"check\", CASE WHEN long > 0 THEN 'FAIL' ELSE 'OK' END AS level, long::VARCHAR AS detail FROM t UNION ALL SELECT 'data', 'untrained', CASE WHEN bare > 0 THEN 'FAIL' ELSE 'OK' END, bare::VARCHAR FROM t")
def r01(spark: SparkSession, sf: str) -> DataFrame:
    f = E.token_table_findings(token_table(spark, sf), 600)
    return f.where(F.col("check").isin("too_long", "untrained")).select("area", "check", "level", "detail")


@R.add("a28_finding_counts")
def a28(spark: SparkSession, sf: str) -> DataFrame:
    return E.level_counts(E.token_table_findings(token_table(spark, sf), 600))


@R.add("l06_ordered_findings")
def l06(spark: SparkSession, sf: str) -> DataFrame:
    return E.ordered(E.token_table_findings(token_table(spark, sf), 600))


@R.add("r08_verdict")
def r08(spark: SparkSession, sf: str) -> DataFrame:
    return E.worst(E.token_table_findings(token_table(spark, sf), 600))


@R.add("r10_pair_table_gate")
def r10(spark: SparkSession, sf: str) -> DataFrame:
    return E.pair_table_problems(pairs(spark, sf))


@R.add("r12_identity_drift", f"WITH {TASKS} SELECT task_id, CASE WHEN validation_status IS DISTINCT FROM 'passed' THEN 2 ELSE 1 END::BIGINT AS changed FROM task")
def r12(spark: SparkSession, sf: str) -> DataFrame:
    before = F.create_map(F.lit("status"), F.lit("passed"), F.lit("shard"), F.col("shard"), F.lit("seed"), F.lit("1"))
    now = F.create_map(F.lit("status"), F.coalesce("validation_status", F.lit("none")), F.lit("shard"), F.col("shard"), F.lit("seed"), F.lit("2"))
    return tasks(spark, sf).select("task_id", big(F.size(E.identity_drift(before, now))).alias("changed"))


@R.add("r14_moved_tensors", "SELECT 't' || vec_id AS key, CASE WHEN vec_id % 5 = 0 THEN 'missing' WHEN vec_id % 5 = 1 THEN 'moved' WHEN vec_id % 5 = 2 THEN 'length' ELSE 'same' END AS state FROM embeddings")
def r14(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select(F.concat(F.lit("t"), "vec_id").alias("key"), F.col("embedding").alias("values"), "vec_id")
    k = F.col("vec_id") % 5
    after = e.where(k != 0).select("key", F.when(k == 1, F.transform("values", lambda x: (x + 1).cast("float"))).when(k == 2, F.slice("values", 1, 3)).otherwise(F.col("values")).alias("values"))
    return E.moved_tensors(e.select("key", "values"), after)


@R.add("st01_event_windows", "SELECT time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') AS window_start, event_type, count(*)::BIGINT AS n FROM events GROUP BY 1, 2")
def st01(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by window of a stream over all events that are there now."""
    out = scratch(spark, "windows")
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*")
    counts = I.event_windows(stream, "ts", "6 hours", "60 days", ["event_type"])
    keep = lambda df, _: df.write.mode("overwrite").parquet(out)
    counts.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", scratch(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


@R.add("st02_incremental_scores", "SELECT 'p' || o_orderkey AS pair_id, round(-o_totalprice / 1000.0, 6) AS logp FROM orders")
def st02(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over the same source; the second finds nothing left to score."""
    sink, check = scratch(spark, "scores"), scratch(spark, "checkpoint")
    score = lambda df: df.select("pair_id", r6(-F.col("o_totalprice").cast("double") / 1000.0).alias("logp"))
    source = scratch(spark, "pairs")
    table(spark, sf, "orders").withColumn("pair_id", F.concat(F.lit("p"), "o_orderkey")).write.parquet(source)
    full = spark.read.parquet(source).schema
    for c in (check, scratch(spark, "checkpoint")):
        I.score_new(spark, source, full, score, sink, c)
    return spark.read.parquet(sink)


@R.add("st03_stream_stages")
def st03(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    d = F.col("doc_id")
    text = F.when(d % 97 == 0, "=== STAGE train").when(d % 89 == 0, "=== DONE train").otherwise("step")
    source, out = scratch(spark, "log"), scratch(spark, "stages")
    table(spark, sf, "documents").select(F.col("source").alias("file"), d.alias("line_no"), text.alias("text")).write.parquet(source)
    stream = spark.readStream.schema("file string, line_no bigint, text string").parquet(source)
    I.stage_of_lines(stream).writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", scratch(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).groupBy("stage").agg(F.count(F.lit(1)).alias("n"))


@R.add("st04_stream_sessions", f"WITH {SFT}, o AS (SELECT trajectory_id, messages FROM sft WHERE len(messages) > 1 AND trajectory_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY trajectory_id ORDER BY len(messages)) = 1) SELECT trajectory_id AS session_id, len(list_filter(messages, lambda m: m.role = 'assistant'))::BIGINT AS turns, false AS diverged FROM o WHERE len(list_filter(messages, lambda m: m.role = 'assistant')) > 0")
def st04(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    rows = sft(spark, sf).where("size(messages) > 1 and trajectory_id is not null").dropDuplicates(["trajectory_id"])
    t = rows.select("trajectory_id", "messages", F.explode(F.expr("filter(sequence(0, size(messages) - 1), i -> messages[i].role = 'assistant')")).alias("i"))
    before = F.flatten(F.transform(F.slice("messages", F.lit(1), F.col("i")), lambda m: A.piece_lengths(m["content"])))
    last = F.col("i") == F.expr("array_max(filter(sequence(0, size(messages) - 1), i -> messages[i].role = 'assistant'))")
    turns = t.select(F.col("trajectory_id").alias("session_id"), big("i").alias("turn_no"), before.alias("prompt_ids"), A.piece_lengths(F.get("messages", F.col("i"))["content"]).alias("response_ids"), last.alias("last"))
    source, out = scratch(spark, "turns"), scratch(spark, "sessions")
    turns.write.parquet(source)
    stream = spark.readStream.schema(turns.schema).parquet(source)
    I.sessions_of_turns(stream).writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", scratch(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("session_id", "turns", "diverged")


@R.add("x16_failure_classes", f"WITH {ATTEMPTS}, w AS (SELECT benchmark, unnest(range(0, max(run) + 2)) AS run FROM att GROUP BY 1) SELECT CASE WHEN count(att.run) = 0 THEN 'empty' WHEN sum((returncode <> 0)::INT) = 0 THEN 'done' ELSE 'incomplete' END AS state, w.benchmark AS benchmark, w.run::INT AS run FROM w LEFT JOIN att ON w.benchmark = att.benchmark AND w.run = att.run GROUP BY w.benchmark, w.run")
def x16(spark: SparkSession, sf: str) -> DataFrame:
    """State of each run of a benchmark up to the one after its last, of which nothing is there."""
    rows = attempts(spark, sf, "returncode")
    due = rows.groupBy("benchmark").agg(F.max("run").alias("last")).select("benchmark", F.explode(F.sequence(F.lit(0), F.col("last") + 1)).alias("run"))
    seen = rows.groupBy("benchmark", "run").agg(F.sum(big(F.col("returncode") != 0)).alias("bad"))
    state = F.when(F.col("seen").isNull(), "empty").when(F.col("bad") == 0, "done").otherwise("incomplete")
    return due.join(seen.withColumn("seen", F.lit(True)), ["benchmark", "run"], "left").select(state.alias("state"), "benchmark", "run")


@R.add("x09_format_errors", f"WITH {CHATS}, m AS (SELECT unnest(conversations) AS c FROM chat) SELECT c.role AS role, sum((starts_with(coalesce(c.content, ''), 'Format error:'))::INT)::BIGINT AS errors FROM m GROUP BY 1")
def x09(spark: SparkSession, sf: str) -> DataFrame:
    m = chats(spark, sf).select(F.explode("conversations").alias("c"))
    return m.groupBy(F.col("c.role").alias("role")).agg(F.sum(big(X.is_format_error(F.col("c.role"), F.coalesce("c.content", F.lit(""))))).alias("errors"))


QUERIES, SQL = R.queries, R.sql
