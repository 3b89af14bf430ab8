"""Scans, gates and counters of drop reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernix.functions import arrays as A
from quernix.functions import text as X
from quernix.functions.numeric import tier_of
from quernix.operators import gates as G
from quernix.operators.outcomes import scorable, solved
from quernix.operators.selection import long_enough_else_longest
from quernix.functions.tokens import bpe_sql, with_conversation_tokens, with_token_ids
from quernix.queries.base import TOKENS, ATTEMPTS, CHATS, SFT, TASKS, TRAJ, Registry, attempts, big, chats, r6, sft, tasks, trajectories
from quernix.runtime import table
from quernix.sources.readers import parquet_parts, tagged_union

R = Registry()


@R.add("s01_scan_all", "SELECT task_id, task_group_id, validation_status, instruction, dockerfile, task_content_sha256, shard, member_prefix FROM tasks")
def s01(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "tasks")


@R.add("s02_scan_pruned", "SELECT trajectory_id, n_tokens FROM sft_messages WHERE n_tokens >= 500")
def s02(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "sft_messages").where("n_tokens >= 500").select("trajectory_id", "n_tokens")


@R.add("s03_parts_union", "SELECT 'eval_items' AS origin, count(*)::BIGINT AS n, count(DISTINCT task_id)::BIGINT AS tasks FROM eval_items UNION ALL SELECT 'attempts', count(*)::BIGINT, count(DISTINCT task_id)::BIGINT FROM attempts")
def s03(spark: SparkSession, sf: str) -> DataFrame:
    a = parquet_parts(spark, [f"{sf}/eval_items.parquet"]).select("task_id", "file").withColumn("origin", F.lit("eval_items"))
    b = parquet_parts(spark, [f"{sf}/attempts.parquet"]).select("task_id", "file").withColumn("origin", F.lit("attempts"))
    return a.unionByName(b).groupBy("origin").agg(F.count("file").alias("n"), F.countDistinct("task_id").alias("tasks"))


@R.add("s15_tagged_union", "SELECT split, count(*)::BIGINT AS n, sum(n_tokens)::BIGINT AS tokens FROM (SELECT 'short' AS split, n_tokens FROM sft_messages WHERE n_tokens < 600 UNION ALL SELECT 'long', n_tokens FROM sft_messages WHERE n_tokens >= 600) GROUP BY 1")
def s15(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "sft_messages").select("n_tokens")
    both = tagged_union({"short": t.where("n_tokens < 600"), "long": t.where("n_tokens >= 600")})
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("tokens"))


@R.add("f01_sft_gate", f"WITH {TRAJ} SELECT trajectory_id, grp, model FROM traj WHERE status = 'completed' AND has_trajectory AND NOT has_exception AND reward >= 1.0 AND task_present_in_task_dataset")
def f01(spark: SparkSession, sf: str) -> DataFrame:
    t = trajectories(spark, sf)
    return t.where(G.trainable(t)).select("trajectory_id", "grp", "model")


@R.add("f02_clean_gate", f"WITH {TRAJ} SELECT trajectory_id, reward FROM traj WHERE status = 'completed' AND has_trajectory AND NOT has_exception AND reward IS NOT NULL")
def f02(spark: SparkSession, sf: str) -> DataFrame:
    t = trajectories(spark, sf)
    return t.where(G.completed(t)).select("trajectory_id", "reward")


@R.add("f03_model_allow_list", f"WITH {TRAJ} SELECT model, count(*)::BIGINT AS n FROM traj WHERE model IN ('corvane32binstruct', 'mirelle70b', 'umbrielxl') GROUP BY 1")
def f03(spark: SparkSession, sf: str) -> DataFrame:
    return trajectories(spark, sf).where(F.col("model").isin("corvane32binstruct", "mirelle70b", "umbrielxl")).groupBy("model").agg(F.count(F.lit(1)).alias("n"))


@R.add("f04_validated_tasks", f"WITH {TASKS} SELECT task_id FROM task WHERE validation_status = 'passed'")
def f04(spark: SparkSession, sf: str) -> DataFrame:
    return tasks(spark, sf, "validation_status").where("validation_status = 'passed'").select("task_id")


_BLANK = r"regexp_replace({}, '[\s\x0B\x1C-\x1F\x{{85}}\pZ]', '', 'g') = ''"


@R.add(
    "f05_structure_gate",
    f"""WITH {SFT}, c AS (SELECT trajectory_id, messages AS m, list_filter(messages, lambda x: x.role = 'assistant') AS a FROM sft)
    SELECT drop_reason, count(*)::BIGINT AS n FROM (SELECT CASE WHEN m IS NULL OR len(m) = 0 OR m[1].role IS DISTINCT FROM 'user' THEN 'no_user_prompt'
      WHEN m[1].content IS NULL OR {_BLANK.format("m[1].content")} THEN 'empty_prompt' WHEN len(a) = 0 THEN 'no_agent_steps'
      WHEN len(list_filter(a, lambda x: x.content IS NULL)) > 0 THEN 'nonstring_message' WHEN m[len(m)].role IS DISTINCT FROM 'assistant' THEN 'not_assistant_terminated'
      WHEN len(m) < 2 THEN 'too_short' ELSE 'kept' END AS drop_reason FROM c) GROUP BY 1""",
)
def f05(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("messages")
    agent = F.filter(m, lambda x: x["role"] == "assistant")
    first = F.get(m, F.lit(0))
    checks = [
        ("no_user_prompt", m.isNull() | (F.size(m) == 0) | ~first["role"].eqNullSafe(F.lit("user"))),
        ("empty_prompt", first["content"].isNull() | (X.py_strip(first["content"]) == "")),
        ("no_agent_steps", F.size(agent) == 0),
        ("nonstring_message", F.exists(agent, lambda x: x["content"].isNull())),
        ("not_assistant_terminated", ~F.element_at(m, -1)["role"].eqNullSafe(F.lit("assistant"))),
        ("too_short", F.size(m) < 2),
    ]
    return G.reason_counts(G.gate(sft(spark, sf).select("messages"), checks))


@R.add(
    "f06_conversation_gate",
    f"""WITH {CHATS}, c AS (SELECT trial_name, conversations AS m, list_filter(list_transform(conversations, lambda x: CASE WHEN x.content IS NULL THEN 'nonstring_message' WHEN x.role = 'user' AND {_BLANK.format("x.content")} THEN 'empty_user_turn' END), lambda y: y IS NOT NULL) AS bad FROM chat)
    SELECT trial_name, CASE WHEN m IS NULL OR len(m) = 0 THEN 'empty_conversation' WHEN len(list_filter(m, lambda x: x.role IS NULL OR x.role NOT IN ('user', 'assistant'))) > 0 THEN 'unexpected_role'
      WHEN m[1].role <> 'user' THEN 'no_user_prompt' WHEN len(bad) > 0 THEN bad[1] WHEN m[len(m)].role <> 'assistant' THEN 'not_assistant_terminated' WHEN len(m) < 2 THEN 'too_short' END AS drop_reason FROM c""",
)
def f06(spark: SparkSession, sf: str) -> DataFrame:
    return G.gate(chats(spark, sf), G.conversation_checks(F.col("conversations"))).select("trial_name", "drop_reason")


@R.add(
    "f07_tool_conversation_gate",
    f"""WITH {CHATS} SELECT trial_name, CASE WHEN m IS NULL OR len(m) = 0 THEN 'empty_conversation' WHEN len(list_filter(m, lambda x: x.role IS NULL OR x.role NOT IN ('system', 'user', 'assistant', 'tool'))) > 0 THEN 'unexpected_role'
      WHEN m[1].role <> 'system' THEN 'no_system_prompt' WHEN len(list_filter(m, lambda x: x.role = 'user')) <> 1 THEN 'not_one_user_turn' WHEN len(list_filter(m, lambda x: x.role = 'assistant')) = 0 THEN 'no_assistant_turn'
      WHEN len(list_filter(m, lambda x: x.role = 'assistant' AND trim(coalesce(x.content, '')) = '')) > 0 THEN 'empty_assistant_turn' END AS drop_reason FROM (SELECT trial_name, conversations AS m FROM chat)""",
)
def f07(spark: SparkSession, sf: str) -> DataFrame:
    return G.gate(chats(spark, sf), G.tool_conversation_checks(F.col("conversations"))).select("trial_name", "drop_reason")


@R.add(
    "plan_tool_conversion",
    f"""WITH {CHATS}, t AS (SELECT conversations AS m FROM chat) SELECT CASE WHEN m IS NULL OR len(m) = 0 THEN 'empty_conversation' WHEN len(list_filter(m, lambda x: x.role IS NULL OR x.role NOT IN ('system', 'user', 'assistant', 'tool'))) > 0 THEN 'unexpected_role'
      WHEN m[1].role <> 'system' THEN 'no_system_prompt' WHEN len(list_filter(m, lambda x: x.role = 'user')) <> 1 THEN 'not_one_user_turn' WHEN len(list_filter(m, lambda x: x.role = 'assistant')) = 0 THEN 'no_assistant_turn'
      WHEN len(list_filter(m, lambda x: x.role = 'assistant' AND trim(coalesce(x.content, '')) = '')) > 0 THEN 'empty_assistant_turn' ELSE 'kept' END AS drop_reason, count(*)::BIGINT AS n FROM t GROUP BY 1""",
)
def plan_tool(spark: SparkSession, sf: str) -> DataFrame:
    """Reasons for which chats can't be rows of native tool conversations. The SQL leaves out control literals and
    lengths above 32,768 tokens, which the chats don't have."""
    from quernix.plans.tool_build import build_tool_rows

    return G.reason_counts(build_tool_rows(chats(spark, sf).select("conversations"), "conversations", "You are an agent."))


_LITERALS = ("ERROR", "Traceback", "<|im_start|>", "</think>", "rm -rf", "DEBUG")


@R.add("f08_forbidden_literals", "SELECT doc_id FROM documents WHERE " + " OR ".join(f"contains(text, '{x}')" for x in _LITERALS))
def f08(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where(X.has_any(F.col("text"), _LITERALS)).select("doc_id")


@R.add("f09_length_gate", f"WITH RECURSIVE {SFT}, {TOKENS} SELECT CASE WHEN len(ids) > 700 THEN 'too_long' WHEN len(ids) = 0 THEN 'unmeasured' ELSE 'kept' END AS drop_reason, count(*)::BIGINT AS n FROM encoded GROUP BY 1")
def f09(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations by their real length in tokens; none is cut."""
    n = F.size("input_ids")
    rows = with_conversation_tokens(sft(spark, sf).select("messages")).select("input_ids")
    return G.reason_counts(G.gate(rows, [("too_long", n > 700), ("unmeasured", n == 0)]))


@R.add("f10_contract_gate", f"WITH RECURSIVE src AS (SELECT doc_id || 'a' AS key, text FROM documents WHERE text <> '' UNION ALL SELECT doc_id || 'b', trim(text) FROM documents WHERE text <> ''), {bpe_sql('src')} SELECT key[:-2]::BIGINT AS doc_id, count(DISTINCT ids) = 1 AS same FROM encoded GROUP BY 1")
def f10(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the ids of a text are those that are expected, here the ids of the text without blanks at its ends."""
    t = table(spark, sf, "documents").where("text is not null and text <> ''").select("doc_id", "text")
    got = with_token_ids(t, F.col("text")).withColumnRenamed("input_ids", "got")
    return with_token_ids(got, F.trim("text")).select("doc_id", (F.col("got") == F.col("input_ids")).alias("same"))


@R.add("f11_text_equality_gate", f"WITH {TASKS} SELECT task_id FROM task WHERE instruction = trim(instruction) AND dockerfile = rtrim(dockerfile, chr(10)) || chr(10)")
def f11(spark: SparkSession, sf: str) -> DataFrame:
    return tasks(spark, sf).where((F.col("instruction") == F.trim("instruction")) & (F.col("dockerfile") == F.concat(F.rtrim("dockerfile", F.lit("\n")), F.lit("\n")))).select("task_id")




@R.add(
    "f12_mask_gate",
    f"""WITH {SFT} SELECT CASE WHEN coalesce(len(messages), 0) = 0 THEN 'empty' WHEN len(list_filter(messages, lambda m: m.role = 'assistant')) = 0 THEN 'no_trained_tokens' ELSE 'kept' END AS drop_reason, count(*)::BIGINT AS n FROM sft GROUP BY 1""",
)
def f12(spark: SparkSession, sf: str) -> DataFrame:
    """Masks of rendered conversations: every answer is trained with its end marker, the header before it never."""
    t = with_conversation_tokens(sft(spark, sf).select("messages")).select(F.col("input_ids").alias("ids"), F.col("loss_mask").alias("mask"))
    return G.reason_counts(t.withColumn("drop_reason", A.mask_reason(F.col("ids"), F.col("mask"))))


@R.add(
    "f15_tier_selection",
    f"""WITH {TRAJ}, {TASKS}, s AS (SELECT grp, count(*) AS n, avg(CASE WHEN reward >= 1.0 THEN 1.0 ELSE 0.0 END) AS p FROM traj WHERE status = 'completed' AND has_trajectory AND NOT has_exception AND reward IS NOT NULL AND grp IS NOT NULL GROUP BY 1),
    k AS (SELECT task_id, lower(regexp_replace(regexp_replace(task_group_id, '[@#][^@#]*\\z', ''), '[^\\pL\\pN]', '', 'g')) AS grp FROM task)
    SELECT task_id, coalesce(n, 0)::BIGINT AS n_trials, round(p, 6) AS pass_rate FROM k LEFT JOIN s USING (grp) WHERE n >= 4 AND p > 0 AND p < 1""",
)
def f15(spark: SparkSession, sf: str) -> DataFrame:
    from quernix.plans.task_pool import tiered_tasks

    t = tiered_tasks(tasks(spark, sf), trajectories(spark, sf))
    return t.where("n_trials >= 4 and pass_rate > 0 and pass_rate < 1").select("task_id", "n_trials", r6("pass_rate").alias("pass_rate"))


@R.add("f16_outcome_predicates", f"WITH {ATTEMPTS} SELECT benchmark, run, task_id, reward IS NOT NULL AND infra_reason IS NULL AS scorable, coalesce(reward IS NOT NULL AND infra_reason IS NULL AND reward >= 1.0, false) AS solved FROM att")
def f16(spark: SparkSession, sf: str) -> DataFrame:
    return attempts(spark, sf).select("benchmark", "run", "task_id", scorable().alias("scorable"), F.coalesce(solved(), F.lit(False)).alias("solved"))


@R.add(
    "f18_long_enough_else_longest",
    f"WITH {SFT} SELECT trajectory_id, n_tokens FROM sft WHERE n_tokens >= 600 ORDER BY trajectory_id LIMIT 20",
)
def f18(spark: SparkSession, sf: str) -> DataFrame:
    return long_enough_else_longest(sft(spark, sf, "n_tokens"), "n_tokens", 600, 20, "trajectory_id")


@R.add("f19_existing_skip", f"WITH {TASKS} SELECT task_id FROM task t WHERE NOT EXISTS (SELECT 1 FROM eval_items e WHERE e.task_id = t.task_id) AND NOT EXISTS (SELECT 1 FROM task u WHERE u.task_id = t.task_id AND u.validation_status = 'passed')")
def f19(spark: SparkSession, sf: str) -> DataFrame:
    t = tasks(spark, sf)
    done = t.where("validation_status = 'passed'").select("task_id").unionByName(table(spark, sf, "eval_items").select("task_id"))
    return t.join(done, "task_id", "left_anti").select("task_id")


@R.add("f20_heredoc_dockerfiles", f"WITH {TASKS} SELECT task_id, len(regexp_extract_all(coalesce(dockerfile, ''), '(?m)^\\s*(?:RUN|COPY)\\b[^\\n]*<<-?\\s*[''\"]?\\w+'))::BIGINT AS heredocs, len(regexp_extract_all(coalesce(dockerfile, ''), '(?m)^RUN '))::BIGINT AS runs FROM task")
def f20(spark: SparkSession, sf: str) -> DataFrame:
    d = F.coalesce("dockerfile", F.lit(""))
    return tasks(spark, sf).select("task_id", big(X.heredoc_count(F.col("dockerfile"))).alias("heredocs"), big(F.size(F.regexp_extract_all(d, F.lit(r"(?m)^RUN "), F.lit(0)))).alias("runs"))


@R.add("f21_file_predicates", f"WITH {TASKS} SELECT shard, sum(CASE WHEN contains(dockerfile, 'compose') OR contains(dockerfile, 'docker') THEN 1 ELSE 0 END)::BIGINT AS compose, sum(CASE WHEN dockerfile IS NULL THEN 1 ELSE 0 END)::BIGINT AS without FROM task GROUP BY 1")
def f21(spark: SparkSession, sf: str) -> DataFrame:
    compose = F.coalesce(F.col("dockerfile").contains("compose") | F.col("dockerfile").contains("docker"), F.lit(False))
    return tasks(spark, sf).groupBy("shard").agg(F.sum(big(compose)).alias("compose"), F.sum(big(F.col("dockerfile").isNull())).alias("without"))


@R.add("a04_drop_counters", f"WITH {TRAJ} SELECT CASE WHEN status IS DISTINCT FROM 'completed' THEN 'status' WHEN NOT has_trajectory THEN 'no_trajectory' WHEN has_exception THEN 'exception' WHEN reward IS NULL THEN 'unmeasured' WHEN reward < 1.0 THEN 'not_solved' ELSE 'kept' END AS drop_reason, count(*)::BIGINT AS n FROM traj GROUP BY 1")
def a04(spark: SparkSession, sf: str) -> DataFrame:
    checks = [
        ("status", ~F.col("status").eqNullSafe(F.lit("completed"))),
        ("no_trajectory", ~F.col("has_trajectory")),
        ("exception", F.col("has_exception")),
        ("unmeasured", F.col("reward").isNull()),
        ("not_solved", F.col("reward") < 1.0),
    ]
    return G.reason_counts(G.gate(trajectories(spark, sf), checks))


@R.add(
    "x70_tiers",
    f"""WITH {TRAJ}, s AS (SELECT grp, count(*)::BIGINT AS n, avg(CASE WHEN reward >= 1.0 THEN 1.0 ELSE 0.0 END) AS p FROM traj WHERE reward IS NOT NULL AND grp IS NOT NULL GROUP BY 1)
    SELECT grp, CASE WHEN n < 4 THEN 'unknown' WHEN p >= 0.1 AND p < 0.9 THEN 'sweet' WHEN p >= 0.0 AND p < 0.1 THEN 'hard' WHEN p >= 0.9 AND p < 1.01 THEN 'easy' ELSE 'unknown' END AS tier FROM s""",
)
def x70(spark: SparkSession, sf: str) -> DataFrame:
    s = trajectories(spark, sf).where("reward is not null and grp is not null").groupBy("grp").agg(F.count("reward").alias("n"), F.avg(F.when(F.col("reward") >= 1.0, 1.0).otherwise(0.0)).alias("p"))
    return s.select("grp", tier_of(F.col("n"), F.col("p"), 4).alias("tier"))


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    from quernix.plans.pair_build import build_pairs

    messages = table(spark, sf, "sft_messages")
    told = trajectories(spark, sf).join(messages.select("trajectory_id"), "trajectory_id", "left_semi")
    return build_pairs(told, messages, key="grp")


@R.add("f13_pair_gate")
def f13(spark: SparkSession, sf: str) -> DataFrame:
    return G.reason_counts(G.gate(pairs(spark, sf), G.pair_checks(max_len=2000, least_shared=1, max_divergence=90, max_ratio=1.5)))


@R.add("f14_pair_length")
def f14(spark: SparkSession, sf: str) -> DataFrame:
    return pairs(spark, sf).where(F.greatest("chosen_n_tokens", "rejected_n_tokens") <= 2000).select("pair_id", "chosen_n_tokens", "rejected_n_tokens")


QUERIES, SQL = R.queries, R.sql
