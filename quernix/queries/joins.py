"""Joins, set operations and de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernix.operators.dedup import first_by, greedy_two_key, repeated_keys
from quernix.operators.outcomes import run_rates
from quernix.operators.selection import balanced_sides, form_pairs, holdout_groups, pair_id, shared_groups
from quernix.plans.pair_build import candidates, mixed_groups
from quernix.plans.task_pool import group_stats
from quernix.queries.base import ATTEMPTS, SFT, TASKS, TRAJ, Registry, attempts, big, r6, sft, tasks, trajectories
from quernix.queries.core_problems import group_key
from quernix.runtime import table

R = Registry()
KEYED = "lower(regexp_replace(regexp_replace({}, '[@#][^@#]*\\z', ''), '[^\\pL\\pN]', '', 'g'))"
CLEAN = "clean AS (SELECT * FROM traj WHERE status = 'completed' AND has_trajectory AND NOT has_exception AND reward IS NOT NULL)"


@R.add(
    "j01_tasks_with_stats",
    f"WITH {TRAJ}, {TASKS}, {CLEAN}, s AS (SELECT grp, count(*) AS n, avg(CASE WHEN reward >= 1.0 THEN 1.0 ELSE 0.0 END) AS p FROM clean WHERE grp IS NOT NULL GROUP BY 1) SELECT task_id, coalesce(n, 0)::BIGINT AS n_trials, round(p, 6) AS pass_rate FROM task LEFT JOIN s ON s.grp = {KEYED.format('task.task_group_id')}",
)
def j01(spark: SparkSession, sf: str) -> DataFrame:
    t = tasks(spark, sf).withColumn("grp", group_key(F.col("task_group_id")))
    return t.join(group_stats(trajectories(spark, sf)), "grp", "left").select("task_id", F.coalesce("n_trials", F.lit(0)).cast("bigint").alias("n_trials"), r6("pass_rate").alias("pass_rate"))


@R.add("j02_attach_metadata", f"WITH {TRAJ}, {SFT} SELECT s.trajectory_id, t.grp, t.model, t.reward, s.n_tokens FROM sft s JOIN traj t USING (trajectory_id)")
def j02(spark: SparkSession, sf: str) -> DataFrame:
    return sft(spark, sf, "n_tokens").join(trajectories(spark, sf).select("trajectory_id", "grp", "model", "reward"), "trajectory_id").select("trajectory_id", "grp", "model", "reward", "n_tokens")


@R.add("j03_mixed_group_pool", f"WITH {TRAJ}, {CLEAN} SELECT trajectory_id, grp FROM clean WHERE grp IN (SELECT grp FROM clean WHERE grp IS NOT NULL GROUP BY 1 HAVING sum(CASE WHEN reward >= 1.0 THEN 1 ELSE 0 END) BETWEEN 1 AND count(*) - 1)")
def j03(spark: SparkSession, sf: str) -> DataFrame:
    from quernix.operators.gates import completed

    t = trajectories(spark, sf)
    clean = t.where(completed(t)).select("trajectory_id", "grp", "reward")
    return clean.join(mixed_groups(clean).select("grp"), "grp", "left_semi").select("trajectory_id", "grp")


@R.add("j04_selected_not_built", f"WITH {TRAJ}, {CLEAN} SELECT reward >= 1.0 AS win, count(*)::BIGINT AS n FROM clean WHERE trajectory_id NOT IN (SELECT trajectory_id FROM sft_messages WHERE trajectory_id IS NOT NULL) GROUP BY 1")
def j04(spark: SparkSession, sf: str) -> DataFrame:
    from quernix.operators.gates import completed

    t = trajectories(spark, sf)
    lost = t.where(completed(t)).join(table(spark, sf, "sft_messages").select("trajectory_id"), "trajectory_id", "left_anti")
    return lost.groupBy((F.col("reward") >= 1.0).alias("win")).agg(F.count(F.lit(1)).alias("n"))


_SIDES = """k AS (SELECT trajectory_id, grp, model, reward >= 1.0 AS win, sha256('1228:' || trajectory_id) AS key FROM clean WHERE grp IS NOT NULL AND model IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY grp, model, win ORDER BY key, trajectory_id) AS i, sum(win::INT) OVER (PARTITION BY grp, model) AS w, sum((NOT win)::INT) OVER (PARTITION BY grp, model) AS l FROM k),
taken AS (SELECT * FROM r WHERE i <= least({per}, w, l)),
held AS (SELECT grp, sum(win::INT) AS s, sum((NOT win)::INT) AS f FROM taken GROUP BY 1),
more AS (SELECT r.*, row_number() OVER (PARTITION BY r.grp, r.win ORDER BY r.key, r.trajectory_id) AS j, greatest(0, {per} - least(coalesce(s, 0), coalesce(f, 0))) AS room FROM r LEFT JOIN held USING (grp) WHERE r.i > least({per}, w, l)),
picked AS (SELECT trajectory_id, grp, model, win FROM taken UNION ALL SELECT trajectory_id, grp, model, win FROM more WHERE j <= room)"""


@R.add("w02_balanced_sides", f"WITH {TRAJ}, {CLEAN}, {_SIDES.format(per=3)} SELECT trajectory_id, grp, model, win FROM taken")
def w02(spark: SparkSession, sf: str) -> DataFrame:
    from quernix.operators.gates import completed

    t = trajectories(spark, sf)
    return balanced_sides(t.where(completed(t)).select("trajectory_id", "grp", "model", "reward"), "grp", "model", "trajectory_id", F.col("reward") >= 1.0, 3, across=False).select("trajectory_id", "grp", "model", "win")


@R.add("w03_cross_source_top_up", f"WITH {TRAJ}, {CLEAN}, {_SIDES.format(per=5)} SELECT trajectory_id, grp, model, win FROM picked")
def w03(spark: SparkSession, sf: str) -> DataFrame:
    from quernix.operators.gates import completed

    t = trajectories(spark, sf)
    return balanced_sides(t.where(completed(t)).select("trajectory_id", "grp", "model", "reward"), "grp", "model", "trajectory_id", F.col("reward") >= 1.0, 5).select("trajectory_id", "grp", "model", "win")


_PAIRS = """m AS (SELECT trajectory_id, grp, model, reward >= 1.0 AS win, row_number() OVER (PARTITION BY grp, model, reward >= 1.0 ORDER BY trajectory_id) AS i FROM clean WHERE grp IS NOT NULL AND model IS NOT NULL),
same AS (SELECT w.grp, w.trajectory_id AS chosen, l.trajectory_id AS rejected, row_number() OVER (PARTITION BY w.grp ORDER BY w.model, w.i) AS nth FROM m w JOIN m l ON w.grp = l.grp AND w.model = l.model AND w.i = l.i AND w.win AND NOT l.win QUALIFY nth <= {cap}),
have AS (SELECT grp, count(*) AS n FROM same GROUP BY 1),
rest AS (SELECT m.*, {cap} - coalesce(n, 0) AS room, row_number() OVER (PARTITION BY m.grp, win ORDER BY trajectory_id) AS j FROM m LEFT JOIN have USING (grp) WHERE coalesce(n, 0) < {cap} AND trajectory_id NOT IN (SELECT chosen FROM same UNION ALL SELECT rejected FROM same)),
cross_pairs AS (SELECT w.grp, w.trajectory_id AS chosen, l.trajectory_id AS rejected, w.model = l.model AS same_source FROM rest w JOIN rest l ON w.grp = l.grp AND w.j = l.j AND w.win AND NOT l.win WHERE w.j <= w.room)"""


def _members(spark: SparkSession, sf: str) -> DataFrame:
    from quernix.operators.gates import completed

    t = trajectories(spark, sf)
    return t.where(completed(t)).select("trajectory_id", "grp", "model", (F.col("reward") >= 1.0).alias("win"))


@R.add("j05_ordinal_pairs", f"WITH {TRAJ}, {CLEAN}, {_PAIRS.format(cap=4)} SELECT grp, chosen, rejected FROM same")
def j05(spark: SparkSession, sf: str) -> DataFrame:
    return form_pairs(_members(spark, sf), "grp", "model", "trajectory_id", "win", 4, across=False).select("grp", "chosen", "rejected")


@R.add("j06_cross_source_pairs", f"WITH {TRAJ}, {CLEAN}, {_PAIRS.format(cap=6)} SELECT grp, chosen, rejected, true AS same_source FROM same UNION ALL SELECT grp, chosen, rejected, same_source FROM cross_pairs")
def j06(spark: SparkSession, sf: str) -> DataFrame:
    return form_pairs(_members(spark, sf), "grp", "model", "trajectory_id", "win", 6)


@R.add("x44_pair_ids", f"WITH {TRAJ}, {CLEAN}, {_PAIRS.format(cap=2)} SELECT sha256(chosen || '|' || rejected) AS pair_id FROM same UNION ALL SELECT sha256(chosen || '|' || rejected) FROM cross_pairs")
def x44(spark: SparkSession, sf: str) -> DataFrame:
    return form_pairs(_members(spark, sf), "grp", "model", "trajectory_id", "win", 2).select(pair_id(F.col("chosen"), F.col("rejected")).alias("pair_id"))


@R.add("w07_holdout_groups", f"WITH {TRAJ}, g AS (SELECT grp FROM traj WHERE grp IS NOT NULL GROUP BY 1 ORDER BY sha256('1228:' || grp) LIMIT (SELECT least(12, floor(count(DISTINCT grp) * 0.15))::BIGINT FROM traj)) SELECT trajectory_id, CASE WHEN grp IN (SELECT grp FROM g) THEN 'holdout' ELSE 'train' END AS split FROM traj")
def w07(spark: SparkSession, sf: str) -> DataFrame:
    return holdout_groups(trajectories(spark, sf).select("trajectory_id", "grp"), "grp", 12, 0.15).select("trajectory_id", "split")


@R.add("a33_split_overlap", f"WITH {TRAJ}, g AS (SELECT grp FROM traj WHERE grp IS NOT NULL GROUP BY 1 ORDER BY sha256('1228:' || grp) LIMIT (SELECT least(12, floor(count(DISTINCT grp) * 0.15))::BIGINT FROM traj)), s AS (SELECT grp, CASE WHEN grp IN (SELECT grp FROM g) THEN 'holdout' ELSE 'train' END AS split FROM traj WHERE grp IS NOT NULL) SELECT sum((k > 1)::INT)::BIGINT AS shared, sum((k = 1 AND m = 'holdout')::INT)::BIGINT AS held FROM (SELECT grp, count(DISTINCT split) AS k, min(split) AS m FROM s GROUP BY 1)")
def a33(spark: SparkSession, sf: str) -> DataFrame:
    split = holdout_groups(trajectories(spark, sf).select("trajectory_id", "grp"), "grp", 12, 0.15)
    held = split.where("split = 'holdout' and grp is not null").select("grp").distinct().join(shared_groups(split, "grp"), "grp", "left_anti")
    counts = shared_groups(split, "grp").select(F.lit(1).alias("s"), F.lit(0).alias("h")).unionByName(held.select(F.lit(0).alias("s"), F.lit(1).alias("h")))
    return counts.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("shared"), F.coalesce(F.sum("h"), F.lit(0)).alias("held"))


# log probabilities of pairs, made from numeric columns; the reference model's for all but some pairs
_LOGPS = """lp AS (SELECT 'p' || o_orderkey AS pair_id, -o_totalprice / 1000.0 AS chosen_logp, -(o_totalprice + o_custkey) / 1000.0 AS rejected_logp, 1 + o_orderkey % 50 AS n FROM orders),
ref AS (SELECT 'p' || l_orderkey AS pair_id, min(-l_extendedprice / 100.0) AS chosen_ref_logp, min(-(l_extendedprice + l_partkey) / 100.0) AS rejected_ref_logp, count(*)::BIGINT AS ref_n FROM lineitem WHERE l_quantity < 40 GROUP BY 1)"""


def logps(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    p = F.col("o_totalprice").cast("double")
    return o.select(F.concat(F.lit("p"), "o_orderkey").alias("pair_id"), (-p / 1000.0).alias("chosen_logp"), (-(p + F.col("o_custkey")) / 1000.0).alias("rejected_logp"), (1 + F.col("o_orderkey") % 50).alias("n"))


def ref_logps(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").where("l_quantity < 40")
    p = F.col("l_extendedprice").cast("double")
    return li.groupBy(F.concat(F.lit("p"), "l_orderkey").alias("pair_id")).agg(F.min(-p / 100.0).alias("chosen_ref_logp"), F.min(-(p + F.col("l_partkey")) / 100.0).alias("rejected_ref_logp"), F.count(F.lit(1)).alias("ref_n"))


@R.add("j07_pairs_with_reference", f"WITH {_LOGPS} SELECT pair_id, round(chosen_logp, 6) AS chosen_logp, round(chosen_ref_logp, 6) AS chosen_ref_logp FROM lp JOIN ref USING (pair_id)")
def j07(spark: SparkSession, sf: str) -> DataFrame:
    return logps(spark, sf).join(ref_logps(spark, sf), "pair_id").select("pair_id", r6("chosen_logp").alias("chosen_logp"), r6("chosen_ref_logp").alias("chosen_ref_logp"))


@R.add("j08_coverage_gap", f"WITH {_LOGPS} SELECT pair_id FROM lp WHERE pair_id NOT IN (SELECT pair_id FROM ref)")
def j08(spark: SparkSession, sf: str) -> DataFrame:
    return logps(spark, sf).join(ref_logps(spark, sf), "pair_id", "left_anti").select("pair_id")


@R.add("j09_scored_but_unwanted", f"WITH {_LOGPS} SELECT pair_id FROM ref WHERE pair_id NOT IN (SELECT pair_id FROM lp WHERE n > 25)")
def j09(spark: SparkSession, sf: str) -> DataFrame:
    return ref_logps(spark, sf).join(logps(spark, sf).where("n > 25"), "pair_id", "left_anti").select("pair_id")


@R.add("j10_resume_todo", f"WITH {_LOGPS} SELECT count(*)::BIGINT AS todo FROM lp WHERE pair_id NOT IN (SELECT pair_id FROM ref WHERE ref_n >= 2)")
def j10(spark: SparkSession, sf: str) -> DataFrame:
    return logps(spark, sf).join(ref_logps(spark, sf).where("ref_n >= 2"), "pair_id", "left_anti").agg(F.count(F.lit(1)).alias("todo"))


_CATALOGUE = """orig AS (SELECT p_name || '#' || p_partkey AS key, p_size AS rows_, p_size * 4::BIGINT AS nbytes FROM part),
trained AS (SELECT p_name || '#' || p_partkey AS key, CASE WHEN p_partkey % 7 = 0 THEN p_size + 1 ELSE p_size END AS rows_ FROM part WHERE p_partkey % 3 <> 0 UNION ALL SELECT 'new#' || s_suppkey, 1 FROM supplier)"""


def _catalogues(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf, "part")
    key = F.concat("p_name", F.lit("#"), "p_partkey").alias("key")
    orig = p.select(key, F.col("p_size").alias("rows_"), big(F.col("p_size") * 4).alias("nbytes"))
    trained = p.where("p_partkey % 3 <> 0").select(key, F.when(F.col("p_partkey") % 7 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")).alias("rows_"))
    return orig, trained.unionByName(table(spark, sf, "supplier").select(F.concat(F.lit("new#"), "s_suppkey").alias("key"), F.lit(1).alias("rows_")))


@R.add("j11_tensor_plan", f"WITH {_CATALOGUE} SELECT o.key, CASE WHEN t.key IS NULL THEN 'missing' WHEN t.rows_ <> o.rows_ THEN 'shape' ELSE 'trained' END AS reason FROM orig o LEFT JOIN trained t USING (key)")
def j11(spark: SparkSession, sf: str) -> DataFrame:
    o, t = _catalogues(spark, sf)
    t = t.withColumnRenamed("rows_", "t_rows")
    return o.join(t, "key", "left").select("key", F.when(F.col("t_rows").isNull(), "missing").when(F.col("t_rows") != F.col("rows_"), "shape").otherwise("trained").alias("reason"))


@R.add("a37_plan_summary", f"WITH {_CATALOGUE} SELECT reason, count(*)::BIGINT AS n, sum(nbytes)::BIGINT AS nbytes FROM (SELECT nbytes, CASE WHEN t.key IS NULL THEN 'missing' WHEN t.rows_ <> o.rows_ THEN 'shape' ELSE 'trained' END AS reason FROM orig o LEFT JOIN trained t USING (key)) GROUP BY 1")
def a37(spark: SparkSession, sf: str) -> DataFrame:
    o, _ = _catalogues(spark, sf)
    return j11(spark, sf).join(o, "key").groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("nbytes").alias("nbytes"))


@R.add("j12_new_keys", f"WITH {_CATALOGUE} SELECT key FROM trained WHERE key NOT IN (SELECT key FROM orig)")
def j12(spark: SparkSession, sf: str) -> DataFrame:
    o, t = _catalogues(spark, sf)
    return t.join(o, "key", "left_anti").select("key")


_FILES = f"""{TASKS}, files AS (SELECT task_id, 'environment/Dockerfile' AS rel, sha256(coalesce(dockerfile, '')) AS sha FROM task UNION ALL SELECT task_id, 'instruction.md', sha256(coalesce(instruction, '')) FROM task
UNION ALL SELECT task_id, 'tests/test.sh', sha256(CASE WHEN validation_status = 'passed' THEN 'verify ' || task_id ELSE coalesce(dockerfile, '') END) FROM task
UNION ALL SELECT task_id, 'environment/tests/test.sh', sha256(task_id) FROM task WHERE task_id LIKE '%a')"""


def task_files(spark: SparkSession, sf: str) -> DataFrame:
    t = tasks(spark, sf)
    rows = [
        (F.lit("environment/Dockerfile"), F.coalesce("dockerfile", F.lit("")), F.lit(True)),
        (F.lit("instruction.md"), F.coalesce("instruction", F.lit("")), F.lit(True)),
        (F.lit("tests/test.sh"), F.when(F.col("validation_status") == "passed", F.concat(F.lit("verify "), "task_id")).otherwise(F.coalesce("dockerfile", F.lit(""))), F.lit(True)),
        (F.lit("environment/tests/test.sh"), F.col("task_id"), F.col("task_id").endswith("a")),
    ]
    parts = F.array(*[F.when(on, F.struct(rel.alias("rel"), F.sha2(content, 256).alias("sha256"))) for rel, content, on in rows])
    return t.select("task_id", F.inline(F.array_compact(parts)))


@R.add("j13_verifier_leaks", f"WITH {_FILES} SELECT task_id, min(rel) AS rel FROM files f WHERE rel LIKE 'environment/%' AND (rel LIKE '%/test.sh' OR EXISTS (SELECT 1 FROM files p WHERE p.task_id = f.task_id AND p.rel = 'tests/test.sh' AND p.sha = f.sha)) GROUP BY 1")
def j13(spark: SparkSession, sf: str) -> DataFrame:
    from quernix.plans.task_pool import leaked_verifiers

    return leaked_verifiers(task_files(spark, sf))


@R.add("j14_drop_leaked", f"WITH {_FILES} SELECT DISTINCT task_id FROM task WHERE task_id NOT IN (SELECT task_id FROM files f WHERE rel LIKE 'environment/%' AND (rel LIKE '%/test.sh' OR EXISTS (SELECT 1 FROM files p WHERE p.task_id = f.task_id AND p.rel = 'tests/test.sh' AND p.sha = f.sha)))")
def j14(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "tasks").select("task_id").distinct().join(j13(spark, sf), "task_id", "left_anti").select("task_id")


@R.add("r15_file_completeness", f"WITH {_FILES} SELECT DISTINCT task_id, 3::BIGINT AS n_missing FROM task")
def r15(spark: SparkSession, sf: str) -> DataFrame:
    from quernix.plans.task_pool import missing_files

    return missing_files(task_files(spark, sf)).select("task_id", big(F.size("missing")).alias("n_missing"))


_RUNS = """runs AS (SELECT benchmark, run, CASE WHEN sum((reward IS NOT NULL AND infra_reason IS NULL)::INT) > 0 THEN 100.0 * sum((reward IS NOT NULL AND infra_reason IS NULL AND reward >= 1.0)::INT) / sum((reward IS NOT NULL AND infra_reason IS NULL)::INT) ELSE 0.0 END AS rate FROM att GROUP BY 1, 2)"""


@R.add(
    "j15_base_vs_candidate",
    f"WITH {ATTEMPTS}, {_RUNS}, b AS (SELECT benchmark, avg(rate) AS m, coalesce(stddev_samp(rate), 0.0) AS s FROM runs WHERE run % 2 = 1 GROUP BY 1), c AS (SELECT benchmark, avg(rate) AS m, coalesce(stddev_samp(rate), 0.0) AS s FROM runs WHERE run % 2 = 0 GROUP BY 1) SELECT benchmark, round(c.m - b.m, 6) AS delta, CASE WHEN c.m - b.m > greatest(2.0, b.s + c.s) THEN 'better' WHEN c.m - b.m < -greatest(2.0, b.s + c.s) THEN 'worse' ELSE 'within' END AS verdict FROM b JOIN c USING (benchmark)",
)
def j15(spark: SparkSession, sf: str) -> DataFrame:
    from quernix.functions.numeric import band_verdict

    runs = run_rates(attempts(spark, sf))
    side = lambda odd, x: runs.where(F.col("run") % 2 == odd).groupBy("benchmark").agg(F.avg("pass_rate").alias(f"{x}m"), F.coalesce(F.stddev_samp("pass_rate"), F.lit(0.0)).alias(f"{x}s"))
    both = side(1, "b").join(side(0, "c"), "benchmark")
    return both.select("benchmark", r6(F.col("cm") - F.col("bm")).alias("delta"), band_verdict(F.col("bm"), F.col("cm"), F.col("bs"), F.col("cs")).alias("verdict"))


@R.add("j16_published_lookup", f"WITH {ATTEMPTS}, {_RUNS}, pub(benchmark, published) AS (VALUES ('tb-alpha', 41.2), ('lh-suite', 18.1)) SELECT r.benchmark, run, round(rate - published, 6) AS off FROM runs r JOIN pub USING (benchmark)")
def j16(spark: SparkSession, sf: str) -> DataFrame:
    published = spark.createDataFrame([("tb-alpha", 41.2), ("lh-suite", 18.1)], "benchmark string, published double")
    return run_rates(attempts(spark, sf)).join(F.broadcast(published), "benchmark").select("benchmark", "run", r6(F.col("pass_rate") - F.col("published")).alias("off"))


@R.add("j17_claims_vs_manifest", f"WITH {SFT}, m AS (SELECT 'rows' AS path, count(*)::BIGINT AS value FROM sft UNION ALL SELECT 'groups', count(DISTINCT task_group_id)::BIGINT FROM sft UNION ALL SELECT 'tokens', sum(n_tokens)::BIGINT FROM sft), c(path, claimed) AS (SELECT 'rows', count(*)::BIGINT FROM sft UNION ALL SELECT 'tokens', 0::BIGINT UNION ALL SELECT 'pairs', 5::BIGINT) SELECT path, claimed, value, value IS NOT DISTINCT FROM claimed AS ok FROM c LEFT JOIN m USING (path)")
def j17(spark: SparkSession, sf: str) -> DataFrame:
    doc = sft(spark, sf, "task_group_id", "n_tokens").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("task_group_id").alias("groups"), F.sum("n_tokens").alias("tokens"))
    flat = doc.select(F.explode(F.create_map(*[x for c in doc.columns for x in (F.lit(c), big(c))])).alias("path", "value"))
    claims = doc.select(F.explode(F.create_map(F.lit("rows"), big("rows"), F.lit("tokens"), big(F.lit(0)), F.lit("pairs"), big(F.lit(5)))).alias("path", "claimed"))
    return claims.join(flat, "path", "left").select("path", "claimed", "value", F.col("value").eqNullSafe(F.col("claimed")).alias("ok"))


@R.add("j20_prefix_match", f"WITH {TASKS}, member AS (SELECT shard, member_prefix || '/' || f AS member FROM task, (VALUES ('instruction.md'), ('tests/test.sh')) v(f)) SELECT m.member, t.task_id, substr(m.member, len(t.member_prefix) + 2) AS rel FROM (SELECT DISTINCT * FROM member) m JOIN (SELECT DISTINCT task_id, shard, member_prefix FROM task) t ON m.shard = t.shard AND starts_with(m.member, t.member_prefix || '/')")
def j20(spark: SparkSession, sf: str) -> DataFrame:
    from quernix.sources.readers import under_prefix

    t = table(spark, sf, "tasks").select("task_id", "shard", "member_prefix").distinct()
    members = t.select("shard", F.explode(F.array(*[F.concat("member_prefix", F.lit("/" + f)) for f in ("instruction.md", "tests/test.sh")])).alias("member")).distinct()
    return under_prefix(members, t).select("member", "task_id", "rel")


@R.add(
    "u01_greedy_dedup",
    f"""WITH RECURSIVE {SFT}, c AS (SELECT trajectory_id AS id, sha256(list_aggregate(list_transform(messages, lambda m: coalesce(m.content, '')), 'string_agg', ' ')) AS c, sha256(coalesce(task_group_id, '') || '|' || coalesce(messages[len(messages)].content, '')) AS b FROM sft WHERE trajectory_id IS NOT NULL AND len(messages) > 0),
    o AS (SELECT *, row_number() OVER (ORDER BY id) AS k FROM c),
    scan(k, id, kept, cs, bs) AS (SELECT 0::BIGINT, NULL::VARCHAR, false, []::VARCHAR[], []::VARCHAR[] UNION ALL
      SELECT o.k, o.id, NOT list_contains(cs, o.c) AND NOT list_contains(bs, o.b), CASE WHEN NOT list_contains(cs, o.c) AND NOT list_contains(bs, o.b) THEN list_append(cs, o.c) ELSE cs END, CASE WHEN NOT list_contains(cs, o.c) AND NOT list_contains(bs, o.b) THEN list_append(bs, o.b) ELSE bs END FROM scan JOIN o ON o.k = scan.k + 1)
    SELECT id AS trajectory_id FROM scan WHERE kept""",
)
def u01(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations kept by their whole text and by task group and last message."""
    c = sft(spark, sf).where("trajectory_id is not null and size(messages) > 0")
    text = F.array_join(F.transform("messages", lambda m: F.coalesce(m["content"], F.lit(""))), " ")
    last = F.concat(F.coalesce("task_group_id", F.lit("")), F.lit("|"), F.coalesce(F.element_at("messages", -1)["content"], F.lit("")))
    keyed = c.select("trajectory_id", F.sha2(text, 256).alias("content"), F.sha2(last, 256).alias("behaviour"))
    return greedy_two_key(keyed, "trajectory_id", "content", ["behaviour"]).select("trajectory_id")


@R.add("u01_two_key_kept")
def u01b(spark: SparkSession, sf: str) -> DataFrame:
    """Kept conversations by content and by (group, commands)."""
    from quernix.plans.sft_build import conversations

    built = conversations(sft(spark, sf)).where("drop_reason is null")
    return greedy_two_key(built, "trajectory_id", "content_hash", ["task_group_id", "command_signature"]).select("trajectory_id")


@R.add("u02_last_write_wins", "SELECT l_orderkey::BIGINT AS pair_id, l_linenumber::BIGINT AS part, round(l_extendedprice::DOUBLE, 6) AS logp FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_extendedprice DESC) = 1")
def u02(spark: SparkSession, sf: str) -> DataFrame:
    rows = first_by(table(spark, sf, "lineitem"), ["l_orderkey"], [F.desc("l_linenumber"), F.desc("l_extendedprice")])
    return rows.select(big("l_orderkey").alias("pair_id"), big("l_linenumber").alias("part"), r6("l_extendedprice").alias("logp"))


@R.add("u03_concat_splits", "SELECT split, count(*)::BIGINT AS n FROM (SELECT 'items' AS split, task_id FROM eval_items UNION ALL SELECT 'tasks', task_id FROM tasks) GROUP BY 1")
def u03(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "eval_items").select(F.lit("items").alias("split"), "task_id")
    return a.unionByName(table(spark, sf, "tasks").select(F.lit("tasks").alias("split"), "task_id")).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@R.add("u04_intersection", "SELECT trajectory_id FROM sft_messages INTERSECT SELECT trajectory_id FROM trajectories WHERE reward >= 1.0 AND NOT isnan(reward)")
def u04(spark: SparkSession, sf: str) -> DataFrame:
    won = table(spark, sf, "trajectories").where((F.col("reward") >= 1.0) & ~F.isnan("reward")).select("trajectory_id")
    return table(spark, sf, "sft_messages").select("trajectory_id").intersect(won)


@R.add("u05_set_difference", "SELECT task_id, 'unscored' AS side FROM (SELECT task_id FROM eval_items EXCEPT SELECT task_id FROM attempts WHERE run = 1) UNION ALL SELECT task_id, 'unwanted' FROM (SELECT task_id FROM attempts WHERE run = 1 EXCEPT SELECT task_id FROM eval_items WHERE title IS NOT NULL)")
def u05(spark: SparkSession, sf: str) -> DataFrame:
    items, first = table(spark, sf, "eval_items"), table(spark, sf, "attempts").where("run = 1").select("task_id")
    a = items.select("task_id").subtract(first).withColumn("side", F.lit("unscored"))
    return a.unionByName(first.subtract(items.where("title is not null").select("task_id")).withColumn("side", F.lit("unwanted")))


@R.add("u07_first_wins", "SELECT source, lang, doc_id FROM documents WHERE lang IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) = 1")
def u07(spark: SparkSession, sf: str) -> DataFrame:
    return first_by(table(spark, sf, "documents").where("lang is not null").select("source", "lang", "doc_id"), ["source", "lang"], ["doc_id"])


@R.add("u08_repeated_keys", "SELECT trajectory_id, count(*)::BIGINT AS n FROM trajectories GROUP BY 1 HAVING count(*) > 1")
def u08(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_keys(table(spark, sf, "trajectories"), ["trajectory_id"])


@R.add("u09_identical_sides", f"WITH {SFT} SELECT (messages[1].content = messages[2].content)::BOOLEAN AS same, count(*)::BIGINT AS n FROM sft WHERE len(messages) > 1 GROUP BY 1")
def u09(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("messages")
    return sft(spark, sf).where(F.size(m) > 1).groupBy((m[0]["content"] == m[1]["content"]).alias("same")).agg(F.count(F.lit(1)).alias("n"))


@R.add("a15_prompts_per_group", f"WITH {SFT}, p AS (SELECT DISTINCT {KEYED.format('task_group_id')} AS grp, sha256(coalesce(messages[1].content, '')) AS prompt FROM sft WHERE task_group_id IS NOT NULL AND len(messages) > 0) SELECT grp, count(*)::BIGINT AS prompts FROM p GROUP BY 1")
def a15(spark: SparkSession, sf: str) -> DataFrame:
    from quernix.functions.text import canonical_prompt

    p = sft(spark, sf).where("task_group_id is not null and size(messages) > 0").select(group_key(F.col("task_group_id")).alias("grp"), F.sha2(canonical_prompt(F.coalesce(F.col("messages")[0]["content"], F.lit(""))), 256).alias("prompt"))
    return p.distinct().groupBy("grp").agg(F.count(F.lit(1)).alias("prompts"))


@R.add("a17_one_sided_prompts", f"WITH {TRAJ}, {CLEAN}, g AS (SELECT grp, min(reward >= 1.0) AS a, max(reward >= 1.0) AS b FROM clean WHERE grp IS NOT NULL GROUP BY 1) SELECT count(*)::BIGINT AS one_sided FROM g WHERE a = b")
def a17(spark: SparkSession, sf: str) -> DataFrame:
    g = _members(spark, sf).where("grp is not null").groupBy("grp").agg(F.min("win").alias("a"), F.max("win").alias("b"))
    return g.where("a = b").agg(F.count(F.lit(1)).alias("one_sided"))


@R.add("a18_shared_behaviour", f"WITH {SFT}, s AS (SELECT DISTINCT sha256(coalesce(messages[2].content, '')) AS sig, task_group_id AS g FROM sft WHERE len(messages) > 1 AND task_group_id IS NOT NULL) SELECT sig, count(*)::BIGINT AS owners FROM s GROUP BY 1 HAVING count(*) > 1")
def a18(spark: SparkSession, sf: str) -> DataFrame:
    s = sft(spark, sf).where("size(messages) > 1 and task_group_id is not null").select(F.sha2(F.coalesce(F.col("messages")[1]["content"], F.lit("")), 256).alias("sig"), "task_group_id")
    return s.groupBy("sig").agg(F.countDistinct("task_group_id").alias("owners")).where("owners > 1")


@R.add("pair_candidates", f"WITH {TRAJ}, c0 AS (SELECT * FROM traj WHERE status = 'completed' AND has_trajectory AND NOT has_exception AND reward IS NOT NULL), clean AS (SELECT * FROM c0 WHERE grp IN (SELECT grp FROM c0 WHERE grp IS NOT NULL GROUP BY 1 HAVING sum(CASE WHEN reward >= 1.0 THEN 1 ELSE 0 END) BETWEEN 1 AND count(*) - 1)), {_SIDES.format(per=4)} SELECT trajectory_id, win FROM picked")
def pair_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return candidates(trajectories(spark, sf), 4).select("trajectory_id", "win")


QUERIES, SQL = R.queries, R.sql
