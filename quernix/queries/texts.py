"""Text, JSON, hash and array functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernix.functions import arrays as A
from quernix.functions import numeric as N
from quernix.functions import pyfunctions as P
from quernix.functions import text as X
from quernix.operators import outcomes as O
from quernix.operators import sequences as Q
from quernix.queries.aggregates import tokens
from quernix.functions.tokens import bpe_sql, with_token_ids
from quernix.queries.base import RENDER, ATTEMPTS, CHATS, SFT, TASKS, TRAJ, Registry, attempts, big, chats, r6, sft, tasks, trajectories
from quernix.runtime import ship, stage, table

R = Registry()
UUID_SQL = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
_SHELL = "'root@' || substr(task_content_sha256, 1, 12) || ':/app# id ' || substr(task_content_sha256, 1, 8) || '-' || substr(task_content_sha256, 9, 4) || '-' || substr(task_content_sha256, 13, 4) || '-' || substr(task_content_sha256, 17, 4) || '-' || substr(task_content_sha256, 21, 12) || ' ' || coalesce(instruction, '')"


def _shell():
    h = F.col("task_content_sha256")
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("root@"), cut(1, 12), F.lit(":/app# id "), cut(1, 8), F.lit("-"), cut(9, 4), F.lit("-"), cut(13, 4), F.lit("-"), cut(17, 4), F.lit("-"), cut(21, 12), F.lit(" "), F.coalesce("instruction", F.lit("")))


@R.add("x01_canonical_prompt", f"WITH {TASKS} SELECT task_id, sha256(regexp_replace(regexp_replace({_SHELL}, '{UUID_SQL}', '<UUID>', 'g'), '@[0-9a-f]{{12}}([:\\s])', '@<HOST>\\1', 'g')) AS prompt_sha256 FROM task WHERE task_content_sha256 IS NOT NULL")
def x01(spark: SparkSession, sf: str) -> DataFrame:
    return tasks(spark, sf).where("task_content_sha256 is not null").select("task_id", F.sha2(X.canonical_prompt(_shell()), 256).alias("prompt_sha256"))


@R.add("x02_strip_preamble", "SELECT doc_id, (len(text) + CASE WHEN doc_id % 5 = 0 THEN 0 ELSE 21 END)::BIGINT AS n FROM documents WHERE text IS NOT NULL")
def x02(spark: SparkSession, sf: str) -> DataFrame:
    """Texts led by a warning that belongs to a terminal output, and by one that doesn't."""
    t = table(spark, sf, "documents").where("text is not null")
    led = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("Previous response had warnings:\n- extra text\n\nNew Terminal Output:"), "text")).otherwise(F.concat(F.lit("Previous warnings:\n\n\n"), "text"))
    n = F.length(X.strip_warning_preamble(led))
    return t.select("doc_id", big(F.when(F.col("doc_id") % 5 == 0, n - len("New Terminal Output:")).otherwise(n)).alias("n"))


@R.add("x03_fenced_blocks", f"WITH {CHATS}, m AS (SELECT trial_name, unnest(conversations) AS c FROM chat) SELECT trial_name, count(*)::BIGINT AS messages, sum(len(regexp_extract_all(coalesce(c.content, '') || chr(10) || '```json' || chr(10) || '{{' || coalesce(c.content, '') || '}}' || chr(10) || '```', '(?s)```(?:json|JSON)?\\s*(\\{{.*?\\}})\\s*```', 1)))::BIGINT AS blocks FROM m GROUP BY 1")
def x03(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of each message, whole, followed by itself in a fence."""
    m = chats(spark, sf).select("trial_name", F.explode("conversations").alias("c"))
    own = F.coalesce("c.content", F.lit(""))
    return m.groupBy("trial_name").agg(F.count(F.lit(1)).alias("messages"), F.sum(big(F.size(X.fenced_objects(F.concat(own, F.lit("\n```json\n{"), own, F.lit("}\n```")))))).alias("blocks"))


@R.add("x05_base_image", f"WITH {TASKS} SELECT task_id, CASE WHEN regexp_extract(coalesce(dockerfile, ''), '(?im)^\\s*FROM\\s+(\\S+)', 1) = '' THEN '?' ELSE regexp_extract(dockerfile, '(?im)^\\s*FROM\\s+(\\S+)', 1) END AS image FROM task")
def x05(spark: SparkSession, sf: str) -> DataFrame:
    return tasks(spark, sf, "dockerfile").select("task_id", X.base_image(F.col("dockerfile")).alias("image"))


@R.add("x06_strip_scaffolding", "SELECT doc_id, len(regexp_replace(text || chr(10) || '</parameter>' || chr(10) || '</function>' || chr(10) || '</tool_call>' || chr(10), '(?:[\\s\\x0b]*</?(?:parameter|function|tool_call)[^>]*>)+[\\s\\x0b]*\\z', ''))::BIGINT AS n FROM documents WHERE text IS NOT NULL")
def x06(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "documents").where("text is not null")
    return t.select("doc_id", big(F.length(X.strip_scaffolding(F.concat("text", F.lit("\n</parameter>\n</function>\n</tool_call>\n"))))).alias("n"))


@R.add("x07_stray_think", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text WHEN doc_id % 3 = 1 THEN text END AS repaired FROM documents WHERE text IS NOT NULL")
def x07(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id") % 3
    text = F.when(k == 0, F.col("text")).when(k == 1, F.concat("text", F.lit("</think>\n \n"))).otherwise(F.concat("text", F.lit("</think>x</think>")))
    return table(spark, sf, "documents").where("text is not null").select("doc_id", X.repair_stray_think(text).alias("repaired"))


@R.add("x08_strip_think", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'none' WHEN doc_id % 3 = 1 THEN 'closed' ELSE 'open' END AS state, CASE WHEN doc_id % 3 = 2 THEN len(text) + 8 ELSE len(text) END::BIGINT AS n FROM documents WHERE text IS NOT NULL")
def x08(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id") % 3
    text = F.when(k == 0, F.col("text")).when(k == 1, F.concat(F.lit("<think>\na</think>b</think>"), "text")).otherwise(F.concat(F.lit("<think>\n"), "text"))
    return table(spark, sf, "documents").where("text is not null").select("doc_id", X.strip_think(text).alias("s")).select("doc_id", "s.state", big(F.length("s.rest")).alias("n"))


@R.add("x10_job_names", "SELECT doc_id, coalesce(nullif(regexp_replace(substr(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9_.-]', '-', 'g'), 1, 96), '^-+', ''), ''), 'job') AS job FROM documents")
def x10(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", X.job_name(F.coalesce("text", F.lit(""))).alias("job"))


@R.add("x11_session_ids", f"WITH {TRAJ} SELECT trajectory_id, coalesce(nullif(trim(model_name), ''), nullif(trim(task_group_id), ''), substr(sha256(coalesce(model_name, '') || '|' || coalesce(task_group_id, '')), 1, 16)) AS session FROM traj")
def x11(spark: SparkSession, sf: str) -> DataFrame:
    return trajectories(spark, sf).select("trajectory_id", X.session_id(F.col("model_name"), F.col("task_group_id")).alias("session"))


@R.add("x12_log_fields", "SELECT doc_id, (doc_id % 50)::BIGINT AS step, (doc_id % 7 + 0.5)::DOUBLE AS loss, (doc_id % 3)::DOUBLE AS grad_norm, NULL::DOUBLE AS lr FROM documents")
def x12(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("doc_id")
    f = X.log_fields(F.concat(F.lit("[x] Iteration "), d % 50, F.lit(" | LM loss: "), d % 7, F.lit(".5E+0 | Grad Norm="), d % 3, F.lit(" | lrx: 3")))
    return table(spark, sf, "documents").select("doc_id", *[f[k].alias(k) for k in ("step", "loss", "grad_norm", "lr")])


@R.add("x13_nan_lines", "SELECT doc_id FROM documents WHERE contains(lower(text), 'nan') AND (contains(lower(text), 'loss') OR contains(lower(text), 'grad'))")
def x13(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where(X.nan_warning(F.col("text")).isNotNull()).select("doc_id")


@R.add("x14_memory_lines", "SELECT doc_id, round((doc_id % 40 + 0.25) / 1024, 6) AS tried_gib, (doc_id % 9)::DOUBLE AS free_gib FROM documents")
def x14(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("doc_id")
    f = X.memory_fields(F.concat(F.lit("CUDA out of memory. Tried to allocate "), d % 40, F.lit(".25 MiB. GPU 0 has a total capacity of 79 GiB of which "), d % 9, F.lit(" GiB is free.")))
    return table(spark, sf, "documents").select("doc_id", r6(f["tried_gib"]).alias("tried_gib"), f["free_gib"].alias("free_gib"))


@R.add("x15_collective_timeouts", "SELECT 'ALLREDUCE' AS op, (doc_id % 4)::BIGINT AS numel, count(DISTINCT doc_id % 8)::BIGINT AS ranks FROM documents GROUP BY 2")
def x15(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("doc_id")
    f = X.collective_timeout(F.concat(F.lit("[Rank "), d % 8, F.lit("] Watchdog caught collective operation timeout: WorkNCCL(SeqNum=5, OpType=ALLREDUCE, NumelIn="), d % 4, F.lit(", Timeout(ms)=600000)")))
    return table(spark, sf, "documents").select(f["op"].alias("op"), f["numel"].alias("numel"), f["rank"].alias("rank")).groupBy("op", "numel").agg(F.countDistinct("rank").alias("ranks"))


_MARK = "list_filter(['connection reset by peer', 'could not resolve host', 'docker daemon', 'docker compose command failed', 'error during connect', 'failed to pull image', 'name or service not known', 'no space left on device', 'temporary failure in name resolution', 'unexpected eof while reading', 'rate limit exceeded', 'unable to locate package', 'command too long', 'timed out'], lambda m: contains(lower(t), m))[1]"


@R.add("x17_classify_outcome", f"WITH {ATTEMPTS}, t AS (SELECT benchmark, run, task_id, 'x TIMED OUT ' || coalesce(infra_reason, '') AS t FROM att), k AS (SELECT benchmark, run, task_id, {_MARK} AS marker FROM t) SELECT benchmark, run, task_id, marker, CASE WHEN marker IN ('command too long', 'timed out') THEN 'agent_budget' WHEN marker IS NOT NULL THEN 'harness_infra' END AS kind FROM k")
def x17(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.lit("x TIMED OUT "), F.coalesce("infra_reason", F.lit("")))
    return attempts(spark, sf).select("benchmark", "run", "task_id", X.classify_outcome(text).alias("c")).select("benchmark", "run", "task_id", "c.marker", "c.kind")


@R.add("x27_token_lengths", f"WITH RECURSIVE src AS (SELECT doc_id AS key, text FROM documents), {bpe_sql('src')} SELECT key AS doc_id, len(ids)::BIGINT AS n_tokens, coalesce(list_sum(ids), 0)::BIGINT AS ids_sum FROM encoded")
def x27(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of each text and the sum of their ids."""
    rows = with_token_ids(table(spark, sf, "documents").select("doc_id", "text"), F.col("text"))
    return rows.select("doc_id", big(F.size("input_ids")).alias("n_tokens"), A.total(F.col("input_ids")).alias("ids_sum"))


@R.add("x18_chat_render", f"WITH {CHATS} SELECT trial_name, sha256({RENDER}) AS rendered FROM (SELECT trial_name, conversations AS m FROM chat WHERE len(conversations) > 0)")
def x18(spark: SparkSession, sf: str) -> DataFrame:
    return chats(spark, sf).where("size(conversations) > 0").select("trial_name", F.sha2(X.chat_render(F.col("conversations")), 256).alias("rendered"))


@R.add("x19_tool_calls", f"WITH {TASKS} SELECT task_id, CASE WHEN trim(coalesce(validation_status, '')) <> '' THEN chr(10) || chr(10) ELSE '' END || '<tool_call>' || chr(10) || '<function=bash>' || chr(10) || '<parameter=command>' || chr(10) || shard || chr(10) || '</parameter>' || chr(10) || '</function>' || chr(10) || '</tool_call>' AS block FROM task")
def x19(spark: SparkSession, sf: str) -> DataFrame:
    calls = F.array(F.struct(F.lit("bash").alias("name"), F.array(F.struct(F.lit("command").alias("key"), F.col("shard").alias("value"))).alias("arguments")))
    return tasks(spark, sf).select("task_id", X.tool_calls_text(calls, F.coalesce("validation_status", F.lit(""))).alias("block"))


@R.add("x20_pre_render", f"WITH {CHATS}, m AS (SELECT trial_name, unnest(range(1, len(conversations) + 1)) AS i, unnest(conversations) AS c FROM chat) SELECT trial_name, (i - 1)::BIGINT AS turn, CASE WHEN c.role = 'system' THEN 4 WHEN c.role = 'assistant' THEN 19 ELSE 0 END + CASE WHEN c.role = 'system' THEN 0 ELSE len(regexp_replace(coalesce(c.content, ''), '^[\\s\\x0B\\x1C-\\x1F\\x{{85}}\\pZ]+|[\\s\\x0B\\x1C-\\x1F\\x{{85}}\\pZ]+$', '', 'g')) END::BIGINT AS n FROM m")
def x20(spark: SparkSession, sf: str) -> DataFrame:
    done = chats(spark, sf).select("trial_name", F.posexplode(X.pre_render(F.col("conversations"), F.lit("BASE"))).alias("turn", "m"))
    return done.select("trial_name", big("turn").alias("turn"), big(F.length("m.content")).alias("n"))


@R.add("x21_bake_system", f"WITH {CHATS} SELECT trial_name, CASE WHEN conversations[1].role = 'system' THEN coalesce(conversations[1].content, '') END AS system_text FROM chat WHERE len(conversations) > 0")
def x21(spark: SparkSession, sf: str) -> DataFrame:
    return chats(spark, sf).where("size(conversations) > 0").select("trial_name", X.bake_system(X.chat_render(F.col("conversations"))).alias("system_text"))


@R.add("x22_strip", "SELECT doc_id, len(regexp_replace(text, '^[\\s\\x0B\\x1C-\\x1F\\x{85}\\pZ]+|[\\s\\x0B\\x1C-\\x1F\\x{85}\\pZ]+$', '', 'g'))::BIGINT AS n FROM documents WHERE text IS NOT NULL")
def x22(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where("text is not null").select("doc_id", big(F.length(X.py_strip(F.col("text")))).alias("n"))


@R.add("x23_escape_cells", f"WITH {ATTEMPTS} SELECT benchmark, run, task_id, replace(benchmark || '|' || task_id, '|', '\\|') AS cell FROM att")
def x23(spark: SparkSession, sf: str) -> DataFrame:
    return attempts(spark, sf).select("benchmark", "run", "task_id", X.escape_cell(F.concat("benchmark", F.lit("|"), "task_id")).alias("cell"))


@R.add("x25_long_options", "SELECT doc_id, len(list_distinct(regexp_extract_all(text, '--[a-z0-9][a-z0-9-]+')))::BIGINT AS options FROM documents WHERE text IS NOT NULL")
def x25(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where("text is not null").select("doc_id", big(F.size(X.long_options(F.col("text")))).alias("options"))


@R.add("x26_forwarded_options", "WITH o AS (SELECT doc_id, list_distinct(regexp_extract_all(text, '--[a-z0-9][a-z0-9-]+')) AS asked FROM documents WHERE text IS NOT NULL) SELECT doc_id, len(list_filter(asked, lambda x: x IN ('--filter', '--merge', '--sort')))::BIGINT AS forwarded, len(list_filter(asked, lambda x: x NOT IN ('--filter', '--merge', '--sort')))::BIGINT AS unsupported FROM o")
def x26(spark: SparkSession, sf: str) -> DataFrame:
    known = F.array(*[F.lit(x) for x in ("--filter", "--merge", "--sort")])
    o = table(spark, sf, "documents").where("text is not null").select("doc_id", X.forwarded_options(X.long_options(F.col("text")), known).alias("o"))
    return o.select("doc_id", big(F.size("o.forwarded")).alias("forwarded"), big(F.size("o.unsupported")).alias("unsupported"))


@R.add("u06_ordered_unique", f"WITH {TASKS} SELECT task_id, CASE WHEN shard = '127.0.0.1' THEN 'x' ELSE shard || ',' || coalesce(validation_status, '?') || ',127.0.0.1,localhost' END AS entries FROM task")
def u06(spark: SparkSession, sf: str) -> DataFrame:
    have = F.concat_ws(",", F.col("shard"), F.coalesce("validation_status", F.lit("?")), F.col("shard"))
    return tasks(spark, sf).select("task_id", X.extend_list(have, "127.0.0.1", "localhost").alias("entries"))


@R.add("x28_proxy_policy", f"WITH {TASKS} SELECT task_id, shard || ',h.example,127.0.0.1,localhost' AS no_proxy, 0::BIGINT AS local_proxies FROM task")
def x28(spark: SparkSession, sf: str) -> DataFrame:
    env = F.create_map(F.lit("HTTP_PROXY"), F.lit("http://p:1"), F.lit("NO_PROXY"), F.col("shard"))
    keep, drop = X.proxy_policy(env, False, "h.example"), X.proxy_policy(env, True, "h.example")
    return tasks(spark, sf).select("task_id", F.try_element_at(keep, F.lit("NO_PROXY")).alias("no_proxy"), big(F.size(F.map_filter(drop, lambda k, v: k == "HTTP_PROXY"))).alias("local_proxies"))


@R.add("x30_normalize_responses")
def x30(spark: SparkSession, sf: str) -> DataFrame:
    """Reasons and rewrites of all agents' answers."""
    ship(spark)
    m = sft(spark, sf).select(F.explode("messages").alias("m")).where("m.role = 'assistant'")
    n = m.select(P.normalize_response_udf("m.content").alias("n"))
    return n.groupBy("n.reason", "n.rewritten").agg(F.count(F.lit(1)).alias("n"))


@R.add("x04_balanced_objects")
def x04(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    m = chats(spark, sf).select("trial_name", F.explode("conversations").alias("m")).where("m.role = 'assistant'")
    return m.groupBy("trial_name").agg(F.sum(big(F.size(P.balanced_objects_udf("m.content")))).alias("objects"))


@R.add("x33_action_agreement")
def x33(spark: SparkSession, sf: str) -> DataFrame:
    """How far an agent's action agrees with that of its next turn, by keystrokes."""
    ship(spark)
    agents = F.filter("messages", lambda m: m["role"] == "assistant")
    turns = sft(spark, sf).select("trajectory_id", F.posexplode(agents).alias("i", "m")).select("trajectory_id", "i", P.normalize_response_udf("m.content").alias("n"))
    keyed = stage(turns.select("trajectory_id", "i", P.keystrokes_udf(F.col("n.canonical")).alias("keys"), F.col("n.canonical").isNotNull().alias("parsed")), "actions")
    nxt = keyed.select("trajectory_id", (F.col("i") - 1).alias("i"), F.col("keys").alias("pred"), F.col("parsed").alias("pred_parsed"))
    both = keyed.join(nxt, ["trajectory_id", "i"])
    has = F.size("pred") > 0
    return both.agg(
        F.count(F.lit(1)).alias("pairs"), r6(F.avg(F.col("pred_parsed").cast("double"))).alias("parsed"), r6(F.avg((has & (F.col("pred") == F.col("keys"))).cast("double"))).alias("commands_exact"),
        r6(F.avg((has & F.coalesce(F.get("pred", F.lit(0)) == F.get("keys", F.lit(0)), F.lit(False))).cast("double"))).alias("first_exact"), r6(F.avg((F.size("pred") == F.size("keys")).cast("double"))).alias("count_match"),
    )


@R.add("a23_action_examples")
def a23(spark: SparkSession, sf: str) -> DataFrame:
    """The first five turns, in order of id and turn, whose commands differ from those of the agent's turn before."""
    ship(spark)
    agents = F.filter("messages", lambda m: m["role"] == "assistant")
    turns = sft(spark, sf).select("trajectory_id", F.posexplode(agents).alias("i", "m")).select("trajectory_id", "i", P.normalize_response_udf("m.content").alias("n"))
    keyed = stage(turns.select("trajectory_id", "i", P.keystrokes_udf(F.col("n.canonical")).alias("keys")), "actions")
    before = keyed.select("trajectory_id", (F.col("i") + 1).alias("i"), F.col("keys").alias("before"))
    differ = keyed.join(before, ["trajectory_id", "i"]).where("keys <> before")
    return differ.orderBy("trajectory_id", "i").limit(5).select("trajectory_id", big("i").alias("turn"), "before", "keys")


@R.add("x34_observation_text", f"WITH {CHATS} SELECT trial_name, nullif(list_aggregate(list_filter(list_transform(conversations, lambda m: m.content), lambda c: c IS NOT NULL AND c <> ''), 'string_agg', chr(10)), '') AS observation FROM chat")
def x34(spark: SparkSession, sf: str) -> DataFrame:
    return chats(spark, sf).select("trial_name", X.observation_text(F.col("conversations")).alias("observation"))


@R.add("x35_nested_paths", "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def x35(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@R.add("x36_key_paths", "SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS BIGINT), -1) AS k FROM events")
def x36(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.coalesce(F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint"), F.lit(-1).cast("bigint")).alias("k"))


@R.add("x40_content_hash", f"WITH {SFT} SELECT count(messages)::BIGINT AS rows, count(DISTINCT messages)::BIGINT AS contents FROM sft")
def x40(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    h = sft(spark, sf).select(P.content_hash_udf("messages").alias("h"))
    return h.agg(F.count("h").alias("rows"), F.countDistinct("h").alias("contents"))


@R.add("x41_command_signature")
def x41(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    turns = sft(spark, sf).select("trajectory_id", F.posexplode(F.filter("messages", lambda m: m["role"] == "assistant")).alias("i", "m"))
    keys = turns.select("trajectory_id", F.struct("i", P.keystrokes_udf(F.col("m.content")).alias("k")).alias("t"))
    lists = keys.groupBy("trajectory_id").agg(F.array_sort(F.collect_set("t")).alias("ts"))
    return lists.select("trajectory_id", F.sha2(F.array_join(F.flatten(F.col("ts.k")), "\0"), 256).alias("command_signature"))


@R.add("x42_tool_command_signature", f"WITH {TASKS} SELECT task_id, sha256(trim(shard) || chr(10) || chr(0) || chr(10) || trim(member_prefix)) AS signature FROM task")
def x42(spark: SparkSession, sf: str) -> DataFrame:
    return tasks(spark, sf).select("task_id", F.sha2(F.concat_ws("\n\0\n", X.py_strip(F.col("shard")), X.py_strip(F.col("member_prefix"))), 256).alias("signature"))


@R.add("x43_prompt_hashes", f"WITH {SFT} SELECT trajectory_id, sha256(coalesce(messages[1].content, '')) AS verbatim, sha256(regexp_replace(regexp_replace(coalesce(messages[1].content, ''), '{UUID_SQL}', '<UUID>', 'g'), '@[0-9a-f]{{12}}([:\\s])', '@<HOST>\\1', 'g')) AS canonical FROM sft WHERE len(messages) > 0")
def x43(spark: SparkSession, sf: str) -> DataFrame:
    first = F.coalesce(F.col("messages")[0]["content"], F.lit(""))
    return sft(spark, sf).where("size(messages) > 0").select("trajectory_id", F.sha2(first, 256).alias("verbatim"), F.sha2(X.canonical_prompt(first), 256).alias("canonical"))


@R.add("x47_content_sha", f"WITH {TASKS} SELECT task_id, sha256(coalesce(dockerfile, '')) AS sha256 FROM task")
def x47(spark: SparkSession, sf: str) -> DataFrame:
    return tasks(spark, sf).select("task_id", F.sha2(F.coalesce("dockerfile", F.lit("")), 256).alias("sha256"))


@R.add("x50_trained_chars", f"WITH {CHATS}, m AS (SELECT trial_name, len(conversations) AS k, unnest(range(1, len(conversations) + 1)) AS i, unnest(conversations) AS c FROM chat) SELECT trial_name, sum(CASE WHEN c.role = 'assistant' THEN len(coalesce(c.content, '')) + 11 + CASE WHEN i = k THEN 11 ELSE 0 END ELSE 0 END)::BIGINT AS trained FROM m GROUP BY 1")
def x50(spark: SparkSession, sf: str) -> DataFrame:
    """Trained characters of a render; tests hold the number against the spans."""
    m = F.col("conversations")
    return chats(spark, sf).where("size(conversations) > 0").select("trial_name", P.trained_chars(m).alias("trained"))


_TOK = f"""{SFT}, tok AS (SELECT trajectory_id, flatten(list_transform(messages, lambda m: list_transform(string_split(coalesce(m.content, ''), ' '), lambda w: len(w)))) AS ids,
flatten(list_transform(messages, lambda m: list_transform(string_split(coalesce(m.content, ''), ' '), lambda w: CASE WHEN m.role = 'assistant' THEN 1 ELSE 0 END))) AS mask FROM sft)"""


@R.add("x51_common_prefix", f"WITH {_TOK} SELECT trajectory_id, coalesce(list_min(list_filter(range(1, greatest(len(ids), len(mask)) + 1), lambda i: ids[i] IS DISTINCT FROM list_concat([ids[1], ids[2]], mask)[i])) - 1, len(ids))::BIGINT AS shared FROM tok WHERE len(ids) >= 2")
def x51(spark: SparkSession, sf: str) -> DataFrame:
    t = tokens(spark, sf).where(F.size("ids") >= 2)
    other = F.concat(F.slice("ids", 1, 2), "mask")
    return t.select("trajectory_id", A.common_prefix_len(F.col("ids"), other).alias("shared"))


@R.add("x52_first_supervised", f"WITH {_TOK} SELECT trajectory_id, coalesce(list_position(mask, 1) - 1, len(mask))::BIGINT AS first_trained, greatest(0, coalesce(list_position(mask, 1) - 1, len(mask)) - 30)::BIGINT AS divergence FROM tok")
def x52(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("mask")
    return tokens(spark, sf).select("trajectory_id", big(A.first_supervised(m)).alias("first_trained"), A.prompt_divergence(m, F.lit(30).cast("bigint")).alias("divergence"))


@R.add("x54_padded_rows", f"WITH {_TOK} SELECT trajectory_id, 64::BIGINT AS n, list_sum(ids[1:64])::BIGINT AS id_sum, coalesce(list_sum(mask[1:64]), 0)::BIGINT AS trained, least(64, len(ids))::BIGINT AS attended, (least(64, len(ids)) * (least(64, len(ids)) - 1) / 2)::BIGINT AS position_sum FROM tok")
def x54(spark: SparkSession, sf: str) -> DataFrame:
    t = tokens(spark, sf).select("trajectory_id", A.padded_row(F.col("ids"), F.col("mask"), 64, 0, "right").alias("r"))
    return t.select("trajectory_id", big(F.size("r.input_ids")).alias("n"), A.total(F.col("r.input_ids")).alias("id_sum"), A.total(F.col("r.loss_mask")).alias("trained"), A.total(F.col("r.attention_mask")).alias("attended"), A.total(F.col("r.position_ids")).alias("position_sum"))


@R.add("x55_labels", f"WITH {_TOK} SELECT trajectory_id, (list_sum(list_transform(ids, lambda x, i: CASE WHEN mask[i] = 1 THEN x ELSE -100 END)))::BIGINT AS label_sum FROM tok")
def x55(spark: SparkSession, sf: str) -> DataFrame:
    return tokens(spark, sf).select("trajectory_id", A.total(A.labels(F.col("ids"), F.col("mask"))).alias("label_sum"))


@R.add("x56_supervised_positions", f"WITH {_TOK} SELECT trajectory_id, len(list_filter(range(0, len(mask)), lambda i: i > 0 AND mask[i + 1] = 1))::BIGINT AS n, list_max(list_filter(range(0, len(mask)), lambda i: i > 0 AND mask[i + 1] = 1))::BIGINT AS last FROM tok")
def x56(spark: SparkSession, sf: str) -> DataFrame:
    p = A.supervised_positions(F.col("mask"))
    return tokens(spark, sf).select("trajectory_id", big(F.size(p)).alias("n"), big(F.array_max(p)).alias("last"))


@R.add("x57_trained_text", f"WITH {SFT} SELECT trajectory_id, sha256(list_aggregate(list_transform(list_filter(messages, lambda m: m.role = 'assistant'), lambda m: coalesce(m.content, '')), 'string_agg', ' ')) AS trained FROM sft")
def x57(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("messages")
    pieces = F.flatten(F.transform(m, lambda x: F.split(F.coalesce(x["content"], F.lit("")), " ")))
    return sft(spark, sf).select("trajectory_id", F.sha2(A.trained_text(pieces, A.message_mask(m)), 256).alias("trained"))


@R.add("x59_relative_l2", "SELECT a.vec_id, round(sqrt(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE) ** 2))) / sqrt(list_sum(list_transform(b.embedding, lambda x: x::DOUBLE ** 2))), 6) AS off FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def x59(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(nxt, "vec_id").select("vec_id", r6(A.relative_l2(F.col("embedding"), F.col("other"))).alias("off"))


@R.add("x66_gib", "SELECT p_partkey::BIGINT AS part, round(p_size * 4e9 / 1073741824.0, 6) AS unsharded, round(p_size * 4e9 / 1073741824.0 / 8, 6) AS sharded FROM part")
def x66(spark: SparkSession, sf: str) -> DataFrame:
    g = N.gib(F.col("p_size") * 4e9)
    return table(spark, sf, "part").select(big("p_partkey").alias("part"), r6(g).alias("unsharded"), r6(g / 8).alias("sharded"))


@R.add("x69_half_even", "SELECT l_orderkey::BIGINT AS k, l_linenumber::BIGINT AS n, round_even(l_quantity / 4.0, 0)::DOUBLE AS q FROM lineitem")
def x69(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(big("l_orderkey").alias("k"), big("l_linenumber").alias("n"), F.rint(F.col("l_quantity").cast("double") / 4.0).alias("q"))


@R.add("x71_sandbox_slots", "SELECT p_partkey::BIGINT AS part, least(p_size // 4, (p_size * 3) // 8)::BIGINT AS slots FROM part")
def x71(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(big("p_partkey").alias("part"), N.sandbox_slots(F.col("p_size"), F.col("p_size") * 3).alias("slots"))


@R.add("x73_expected_steps", f"WITH {TRAJ}, g AS (SELECT model, count(*) AS n FROM traj GROUP BY 1) SELECT model, (n // 16 * 2)::BIGINT AS steps, greatest(3.0, round(0.15 * (n // 16 * 2), 6))::DOUBLE AS tolerance FROM g")
def x73(spark: SparkSession, sf: str) -> DataFrame:
    g = trajectories(spark, sf).groupBy("model").agg(F.count(F.lit(1)).alias("n"))
    return g.select("model", N.expected_steps(F.col("n"), 16, 2).alias("e")).select("model", "e.steps", r6("e.tolerance").alias("tolerance"))


@R.add("w12_splice_scoldings", f"WITH {CHATS}, k AS (SELECT trial_name, len(conversations) AS n, len(list_filter(conversations, lambda m: m.role = 'assistant' AND len(coalesce(m.content, '')) % 2 = 1)) AS a FROM chat) SELECT trial_name, (n - a)::BIGINT AS kept, a::BIGINT AS removed FROM k")
def w12(spark: SparkSession, sf: str) -> DataFrame:
    """Every answer of an odd number of characters is followed by a scolding, so that these answers go and others stay."""
    scold = lambda m: F.array(F.struct(m["role"].alias("role"), m["content"].alias("content")), F.struct(F.lit("user").alias("role"), F.lit("Format error: no call").alias("content")))
    plain = lambda m: F.array(F.struct(m["role"].alias("role"), m["content"].alias("content")))
    scolded = lambda m: (m["role"] == "assistant") & (F.length(F.coalesce(m["content"], F.lit(""))) % 2 == 1)
    longer = F.flatten(F.transform("conversations", lambda m: F.when(scolded(m), scold(m)).otherwise(plain(m))))
    return chats(spark, sf).select("trial_name", Q.splice_format_errors(longer).alias("s")).select("trial_name", big(F.size("s.messages")).alias("kept"), big("s.removed").alias("removed"))


@R.add("w20_assembled_sessions", f"WITH {SFT}, o AS (SELECT trajectory_id, messages FROM sft WHERE len(messages) > 1 AND trajectory_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY trajectory_id ORDER BY len(messages)) = 1), m AS (SELECT trajectory_id, unnest(range(1, len(messages) + 1)) AS i, unnest(messages) AS c FROM o), l AS (SELECT trajectory_id, max(i) AS last FROM m WHERE c.role = 'assistant' GROUP BY 1) SELECT trajectory_id AS session_id, sum((c.role = 'assistant')::INT)::BIGINT AS turns, sum(len(string_split(coalesce(c.content, ''), ' ')))::BIGINT AS ids, sum(CASE WHEN c.role = 'assistant' THEN len(string_split(coalesce(c.content, ''), ' ')) ELSE 0 END)::BIGINT AS trained, false AS diverged FROM m JOIN l USING (trajectory_id) WHERE i <= last GROUP BY 1")
def w20(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    rows = sft(spark, sf).where("size(messages) > 1 and trajectory_id is not null").dropDuplicates(["trajectory_id"])
    turn = F.expr("filter(sequence(0, size(messages) - 1), i -> messages[i].role = 'assistant')")
    t = rows.select("trajectory_id", "messages", F.explode(turn).alias("i"))
    before = F.flatten(F.transform(F.slice("messages", F.lit(1), F.col("i")), lambda m: A.piece_lengths(m["content"])))
    turns = t.select(F.col("trajectory_id").alias("session_id"), big("i").alias("turn_no"), before.alias("prompt_ids"), A.piece_lengths(F.get("messages", F.col("i"))["content"]).alias("response_ids"))
    return Q.assemble_sessions(turns).select("session_id", "turns", big(F.size("input_ids")).alias("ids"), A.total(F.col("mask")).alias("trained"), "diverged")


@R.add("r16_result_outcomes", f"WITH {ATTEMPTS} SELECT benchmark, run, task_id, CASE WHEN infra_reason IS NOT NULL THEN NULL WHEN reward IS NOT NULL THEN reward END::DOUBLE AS reward, CASE WHEN infra_reason IS NOT NULL OR reward IS NULL THEN 'harness_infra' END AS kind FROM att WHERE infra_reason IS NULL OR NOT contains(lower(infra_reason), 'timed out')")
def r16(spark: SparkSession, sf: str) -> DataFrame:
    """Outcomes read back from result documents made of the attempts."""
    a = attempts(spark, sf).where(F.col("infra_reason").isNull() | ~F.lower("infra_reason").contains("timed out"))
    payload = F.to_json(F.struct(F.col("infra_reason").alias("exception_info"), F.struct(F.struct("reward").alias("rewards")).alias("verifier_result")))
    told = X.classify_outcome(F.coalesce("infra_reason", F.lit("")))
    o = a.select("benchmark", "run", "task_id", O.result_outcome(payload, told["kind"], told["marker"]).alias("o"))
    return o.select("benchmark", "run", "task_id", "o.reward", "o.kind")


@R.add("r19_refined_outcomes", f"WITH {ATTEMPTS} SELECT benchmark, run, task_id, CASE WHEN reward IS NOT NULL THEN 'scored' ELSE 'harness_infra' END AS kind FROM att")
def r19(spark: SparkSession, sf: str) -> DataFrame:
    """A score is never overwritten by what the log says, and infrastructure is never turned into budget."""
    base = F.when(F.col("reward").isNotNull(), O.scored(F.col("reward"))).otherwise(O.infra(F.lit("unmeasured")))
    told = X.classify_outcome(F.lit("then it timed out"))
    return attempts(spark, sf).select("benchmark", "run", "task_id", F.coalesce(O.refine(base, told["marker"], told["kind"])["kind"], F.lit("scored")).alias("kind"))


QUERIES, SQL = R.queries, R.sql
