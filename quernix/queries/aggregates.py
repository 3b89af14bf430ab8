"""Aggregations, windows, sorts and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quernix.functions import arrays as A
from quernix.functions import numeric as N
from quernix.functions import text as X
from quernix.operators import outcomes as O
from quernix.operators import selection as S
from quernix.operators import sequences as Q
from quernix.queries.base import ATTEMPTS, CHATS, SFT, TASKS, TRAJ, Registry, attempts, big, chats, r6, sft, tasks, trajectories
from quernix.queries.gates import pairs
from quernix.queries.joins import _LOGPS, CLEAN, logps, ref_logps
from quernix.runtime import table

R = Registry()
SCORABLE = "(reward IS NOT NULL AND infra_reason IS NULL)"



@R.add("a01_group_outcomes", f"WITH {TRAJ}, {CLEAN} SELECT grp, count(*)::BIGINT AS n, sum(CASE WHEN reward >= 1.0 THEN 1 ELSE 0 END)::BIGINT AS wins, sum(CASE WHEN reward >= 1.0 THEN 0 ELSE 1 END)::BIGINT AS fails FROM clean WHERE grp IS NOT NULL GROUP BY 1")
def a01(spark: SparkSession, sf: str) -> DataFrame:
    from quernix.operators.gates import completed

    t = trajectories(spark, sf)
    won = F.col("reward") >= 1.0
    return t.where(completed(t) & F.col("grp").isNotNull()).groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum(big(won)).alias("wins"), F.sum(big(~won)).alias("fails"))


@R.add("a02_group_pass_rate", f"WITH {TRAJ}, {CLEAN} SELECT grp, count(*)::BIGINT AS n_trials, round(avg(CASE WHEN reward >= 1.0 THEN 1.0 ELSE 0.0 END), 6) AS pass_rate FROM clean WHERE grp IS NOT NULL GROUP BY 1")
def a02(spark: SparkSession, sf: str) -> DataFrame:
    from quernix.plans.task_pool import group_stats

    return group_stats(trajectories(spark, sf)).select("grp", "n_trials", r6("pass_rate").alias("pass_rate"))


@R.add("a03_distinct_groups", f"WITH {TRAJ} SELECT count(DISTINCT grp)::BIGINT AS groups, count(DISTINCT model)::BIGINT AS models FROM traj")
def a03(spark: SparkSession, sf: str) -> DataFrame:
    return trajectories(spark, sf).agg(F.countDistinct("grp").alias("groups"), F.countDistinct("model").alias("models"))


@R.add("a05_image_mix", f"WITH {TASKS} SELECT image, count(*)::BIGINT AS n FROM (SELECT CASE WHEN regexp_extract(coalesce(dockerfile, ''), '(?im)^\\s*FROM\\s+(\\S+)', 1) = '' THEN '?' ELSE regexp_extract(coalesce(dockerfile, ''), '(?im)^\\s*FROM\\s+(\\S+)', 1) END AS image FROM task) GROUP BY 1 ORDER BY 2 DESC, 1")
def a05(spark: SparkSession, sf: str) -> DataFrame:
    return tasks(spark, sf, X.base_image(F.col("dockerfile")).alias("image")).groupBy("image").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "image")


@R.add("a06_length_stats", f"WITH {SFT} SELECT round(avg(n_tokens), 6) AS mean, round(quantile_cont(n_tokens, 0.5), 6) AS p50, round(quantile_cont(n_tokens, 0.9), 6) AS p90, round(quantile_cont(n_tokens, 0.99), 6) AS p99, max(n_tokens)::BIGINT AS longest, sum(n_tokens)::BIGINT AS total FROM sft")
def a06(spark: SparkSession, sf: str) -> DataFrame:
    q = F.percentile("n_tokens", F.array(F.lit(0.5), F.lit(0.9), F.lit(0.99)))
    s = sft(spark, sf, "n_tokens").agg(F.avg("n_tokens").alias("mean"), q.alias("q"), F.max("n_tokens").alias("longest"), F.sum("n_tokens").alias("total"))
    return s.select(r6("mean").alias("mean"), *[r6(F.col("q")[k]).alias(p) for k, p in enumerate(("p50", "p90", "p99"))], "longest", "total")


def _exclusive_sql(parts: int, cut: int) -> str:
    return f"CASE WHEN m > {parts} THEN (v[j{parts}] * ({parts} - ({cut} * (m + 1) - j{parts} * {parts})) + v[j{parts} + 1] * ({cut} * (m + 1) - j{parts} * {parts})) / {parts}.0 WHEN m > 0 THEN v[m]::DOUBLE END"


@R.add(
    "a07_exclusive_quantiles",
    f"""WITH {CHATS}, g AS (SELECT model, list(len(conversations) ORDER BY len(conversations)) AS v FROM chat WHERE model IS NOT NULL GROUP BY 1), k AS (SELECT model, v, len(v) AS m, greatest(1, least(len(v) - 1, (9 * (len(v) + 1)) // 10)) AS j10, greatest(1, least(len(v) - 1, (99 * (len(v) + 1)) // 100)) AS j100 FROM g)
    SELECT model, round({_exclusive_sql(10, 9)}, 6) AS p90, round({_exclusive_sql(100, 99)}, 6) AS p99 FROM k""",
)
def a07(spark: SparkSession, sf: str) -> DataFrame:
    v = chats(spark, sf, "model", F.size("conversations").alias("n")).where("model is not null").withColumnRenamed("n", "turns")
    cuts = {"p90": (10, 9), "p99": (100, 99)}
    places = {f"{name}_{k}": lambda n, c=c, k=k: N.exclusive_places(n, *c) + k for name, c in cuts.items() for k in (0, 1)}
    got = S.order_statistics(v, ["model"], "turns", places)
    return got.select("model", *[r6(N.exclusive_quantile(F.col("n"), F.col(f"{name}_0"), F.col(f"{name}_1"), *c)).alias(name) for name, c in cuts.items()])


@R.add("a08_nearest_rank", f"WITH {ATTEMPTS}, g AS (SELECT benchmark, run, list(seconds ORDER BY seconds) AS v FROM att WHERE seconds IS NOT NULL GROUP BY 1, 2) SELECT benchmark, run, round(v[least(len(v), floor(0.95 * len(v))::INT + 1)], 4) AS p95, round(v[least(len(v), floor(0.5 * len(v))::INT + 1)], 4) AS upper_median FROM g")
def a08(spark: SparkSession, sf: str) -> DataFrame:
    got = S.order_statistics(attempts(spark, sf, "seconds"), ["benchmark", "run"], "seconds", {"p95": lambda n: N.nearest_rank_place(n, 0.95), "upper_median": lambda n: N.nearest_rank_place(n, 0.5)})
    return got.select("benchmark", "run", F.round("p95", 4).alias("p95"), F.round("upper_median", 4).alias("upper_median"))


@R.add("a10_low_percentile", f"WITH {ATTEMPTS} SELECT benchmark, round(quantile_cont(seconds, 0.05), 6) AS p05 FROM att GROUP BY 1")
def a10(spark: SparkSession, sf: str) -> DataFrame:
    return attempts(spark, sf, "seconds").groupBy("benchmark").agg(r6(F.percentile("seconds", F.lit(0.05))).alias("p05"))


@R.add("a11_turn_stats", f"WITH {SFT} SELECT model_name, round(avg(n_assistant_turns), 6) AS mean_turns, max(n_assistant_turns)::BIGINT AS most_turns, round(sum(n_rewritten_turns) / greatest(1, sum(n_assistant_turns)), 6) AS rewritten FROM sft GROUP BY 1")
def a11(spark: SparkSession, sf: str) -> DataFrame:
    return sft(spark, sf, "model_name", "n_assistant_turns", "n_rewritten_turns").groupBy("model_name").agg(r6(F.avg("n_assistant_turns")).alias("mean_turns"), F.max("n_assistant_turns").alias("most_turns"), r6(N.ratio(F.col("n_rewritten_turns"), F.col("n_assistant_turns"))).alias("rewritten"))


_TOK = f"""{SFT}, tok AS (SELECT trajectory_id, model_name, flatten(list_transform(messages, lambda m: list_transform(string_split(coalesce(m.content, ''), ' '), lambda w: len(w)))) AS ids,
flatten(list_transform(messages, lambda m: list_transform(string_split(coalesce(m.content, ''), ' '), lambda w: CASE WHEN m.role = 'assistant' THEN 1 ELSE 0 END))) AS mask FROM sft)"""


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    return sft(spark, sf).select("trajectory_id", "model_name", A.message_ids(F.col("messages")).alias("ids"), A.message_mask(F.col("messages")).alias("mask"))


@R.add("a12_trained_fraction", f"WITH {_TOK} SELECT model_name, round(sum(list_sum(mask)) / greatest(1, sum(len(ids))), 6) AS trained_fraction FROM tok GROUP BY 1")
def a12(spark: SparkSession, sf: str) -> DataFrame:
    return tokens(spark, sf).groupBy("model_name").agg(r6(N.ratio(A.total(F.col("mask")), F.size("ids"))).alias("trained_fraction"))


@R.add("a13_length_bias")
def a13(spark: SparkSession, sf: str) -> DataFrame:
    p = pairs(spark, sf)
    c, r = F.col("chosen_n_trained"), F.col("rejected_n_trained")
    out = p.agg(F.avg((r > c).cast("double")).alias("rejected_longer"), F.percentile(r / F.greatest(c, F.lit(1)), F.lit(0.5)).alias("median_ratio"), F.percentile(c, F.lit(0.9)).alias("chosen_p90"), F.percentile(r, F.lit(0.9)).alias("rejected_p90"))
    return out.withColumn("warn", (F.col("rejected_longer") > 0.65) | (F.col("median_ratio") > 1.5))


@R.add("a14_prompt_agreement")
def a14(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("prompt_divergence_tokens")
    return pairs(spark, sf).agg(F.sum(big(d == 0)).alias("identical"), F.percentile(d, F.lit(0.5)).alias("p50"), F.max(d).alias("most"))


@R.add("a16_verbatim_vs_canonical", f"WITH {SFT} SELECT count(DISTINCT messages[1].content)::BIGINT AS verbatim, count(DISTINCT regexp_replace(regexp_replace(messages[1].content, '[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}', '<UUID>', 'g'), '@[0-9a-f]{{12}}([:\\s])', '@<HOST>\\1', 'g'))::BIGINT AS canonical FROM sft WHERE len(messages) > 0")
def a16(spark: SparkSession, sf: str) -> DataFrame:
    p = sft(spark, sf).where("size(messages) > 0").select(F.col("messages")[0]["content"].alias("p"))
    return p.agg(F.countDistinct("p").alias("verbatim"), F.countDistinct(X.canonical_prompt(F.col("p"))).alias("canonical"))


_RATE = "CASE WHEN sum(({b})::INT) > 0 THEN 100.0 * sum(({b} AND reward >= 1.0)::INT) / sum(({b})::INT) ELSE 0.0 END"
_RUNS = f"runs AS (SELECT benchmark, run, count(*)::BIGINT AS trials, sum({SCORABLE}::INT)::BIGINT AS scorable, {_RATE.format(b=SCORABLE)} AS pass_rate, {_RATE.format(b=SCORABLE + ' AND budget_reason IS NULL')} AS excl FROM att GROUP BY 1, 2)"


@R.add("a19_run_pass_rates", f"WITH {ATTEMPTS}, {_RUNS} SELECT benchmark, run, trials, scorable, round(pass_rate, 6) AS pass_rate, round(excl, 6) AS pass_rate_budget_excluded FROM runs")
def a19(spark: SparkSession, sf: str) -> DataFrame:
    return O.run_rates(attempts(spark, sf)).select("benchmark", "run", "trials", "scorable", r6("pass_rate").alias("pass_rate"), r6("pass_rate_budget_excluded").alias("pass_rate_budget_excluded"))


@R.add("a20_benchmark_summary", f"WITH {ATTEMPTS}, {_RUNS} SELECT benchmark, count(*)::BIGINT AS runs, round(avg(pass_rate), 6) AS pass_rate_mean, round(coalesce(stddev_samp(pass_rate), 0.0), 6) AS pass_rate_std, round(avg(excl), 6) AS pass_rate_mean_budget_excluded FROM runs GROUP BY 1")
def a20(spark: SparkSession, sf: str) -> DataFrame:
    s = O.benchmark_summary(attempts(spark, sf))
    return s.select("benchmark", "runs", *[r6(c).alias(c) for c in ("pass_rate_mean", "pass_rate_std", "pass_rate_mean_budget_excluded")])


@R.add("a21_failure_rates", f"WITH {ATTEMPTS} SELECT benchmark, count(*)::BIGINT AS trials_total, sum({SCORABLE}::INT)::BIGINT AS trials_scorable, round(100.0 * count(infra_reason) / count(*), 6) AS infra_failure_rate, round(100.0 * count(budget_reason) / count(*), 6) AS agent_budget_rate FROM att GROUP BY 1")
def a21(spark: SparkSession, sf: str) -> DataFrame:
    s = O.benchmark_summary(attempts(spark, sf))
    return s.select("benchmark", "trials_total", "trials_scorable", r6("infra_failure_rate").alias("infra_failure_rate"), r6("agent_budget_rate").alias("agent_budget_rate"))


@R.add("a21_reason_histogram", f"WITH {ATTEMPTS} SELECT benchmark, infra_reason AS reason, count(*)::BIGINT AS n FROM att WHERE infra_reason IS NOT NULL GROUP BY 1, 2")
def a21b(spark: SparkSession, sf: str) -> DataFrame:
    return O.reason_histogram(attempts(spark, sf), "infra_reason")


_PER_TASK = f"per_task AS (SELECT benchmark, task_id, count(*)::BIGINT AS attempts, coalesce(sum(({SCORABLE} AND reward >= 1.0)::INT), 0)::BIGINT AS solved, count(infra_reason)::BIGINT AS infra, count(budget_reason)::BIGINT AS budget FROM att GROUP BY 1, 2)"


@R.add("a22_per_task", f"WITH {ATTEMPTS}, {_PER_TASK} SELECT * FROM per_task")
def a22(spark: SparkSession, sf: str) -> DataFrame:
    return O.task_summary(attempts(spark, sf)).withColumn("solved", F.coalesce("solved", F.lit(0)))


@R.add("a22_pass_at_k", f"WITH {ATTEMPTS}, {_PER_TASK} SELECT benchmark, count(*)::BIGINT AS tasks, round(100.0 * avg((solved > 0)::INT), 6) AS pass_at_k, sum((solved = 0)::INT)::BIGINT AS never_solved FROM per_task GROUP BY 1")
def a22b(spark: SparkSession, sf: str) -> DataFrame:
    return O.pass_at_k(attempts(spark, sf)).select("benchmark", "tasks", r6("pass_at_k").alias("pass_at_k"), "never_solved")


@R.add("a24_token_weighted_loss", f"WITH {_LOGPS} SELECT r.ref_n, round(sum(-chosen_logp) / sum(n), 6) AS loss, round(exp(sum(-chosen_logp) / sum(n) / 100), 6) AS perplexity, round(sum(-chosen_logp) / sum(n) / ln(50257), 6) AS of_log_vocab FROM lp JOIN ref r USING (pair_id) GROUP BY 1")
def a24(spark: SparkSession, sf: str) -> DataFrame:
    j = logps(spark, sf).join(ref_logps(spark, sf), "pair_id")
    loss = F.sum(-F.col("chosen_logp")) / F.sum("n")
    return j.groupBy("ref_n").agg(r6(loss).alias("loss"), r6(F.exp(loss / 100)).alias("perplexity"), r6(loss / F.log(F.lit(50257.0))).alias("of_log_vocab"))


def scored_pairs(spark: SparkSession, sf: str, beta: float = 0.1, variant: str = "sigmoid", smoothing: float = 0.0) -> DataFrame:
    j = logps(spark, sf).join(ref_logps(spark, sf), "pair_id")
    # per-token values keep the losses in a range where the two engines agree to six digits
    c, r, rc, rr = (F.col(x) / F.col(n) / 10 for x, n in (("chosen_logp", "n"), ("rejected_logp", "n"), ("chosen_ref_logp", "ref_n"), ("rejected_ref_logp", "ref_n")))
    return j.withColumn("s", N.preference_loss(c, r, rc, rr, beta, variant, smoothing))


_Z = "((chosen_logp / n / 10 - rejected_logp / n / 10) - (chosen_ref_logp / ref_n / 10 - rejected_ref_logp / ref_n / 10))"
_NLS = "(greatest(-({x}), 0.0) + ln(1 + exp(-abs({x}))))"


@R.add("a25_reward_accuracy", f"WITH {_LOGPS} SELECT count(*)::BIGINT AS pairs, round(avg(CASE WHEN 0.1 * {_Z} > 1e-6 THEN 1.0 WHEN 0.1 * {_Z} < -1e-6 THEN 0.0 ELSE 0.5 END), 6) AS accuracy, round(avg(0.1 * {_Z}), 6) AS margin FROM lp JOIN ref USING (pair_id)")
def a25(spark: SparkSession, sf: str) -> DataFrame:
    s = scored_pairs(spark, sf)
    return s.agg(F.count(F.lit(1)).alias("pairs"), r6(F.avg(N.rank_score(F.col("s.margin")))).alias("accuracy"), r6(F.avg("s.margin")).alias("margin"))


@R.add("x60_preference_loss", f"WITH {_LOGPS} SELECT pair_id, round({_NLS.format(x='0.1 * ' + _Z)} * 0.9 + {_NLS.format(x='-0.1 * ' + _Z)} * 0.1, 6) AS sigmoid_loss, round(({_Z} - 5.0) ** 2, 4) AS ipo_loss FROM lp JOIN ref USING (pair_id)")
def x60(spark: SparkSession, sf: str) -> DataFrame:
    a = scored_pairs(spark, sf, smoothing=0.1).select("pair_id", r6("s.loss").alias("sigmoid_loss"))
    b = scored_pairs(spark, sf, variant="ipo").select("pair_id", F.round("s.loss", 4).alias("ipo_loss"))
    return a.join(b, "pair_id")


@R.add("x62_rank_scores", f"WITH {_LOGPS} SELECT CASE WHEN 0.1 * {_Z} > 1e-6 THEN 1.0 WHEN 0.1 * {_Z} < -1e-6 THEN 0.0 ELSE 0.5 END::DOUBLE AS score, abs(0.1 * {_Z}) < 0.1 * 1e-3 AS below_noise, count(*)::BIGINT AS n FROM lp JOIN ref USING (pair_id) GROUP BY 1, 2")
def x62(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("s.margin")
    return scored_pairs(spark, sf).groupBy(N.rank_score(m).alias("score"), N.below_noise_floor(m, 0.1).alias("below_noise")).agg(F.count(F.lit(1)).alias("n"))


@R.add("x64_calibration_delta", f"WITH {_LOGPS} SELECT round(max(abs(chosen_logp - chosen_ref_logp) / greatest(n, 1)), 6) AS chosen_delta, round(max(abs(rejected_logp - rejected_ref_logp) / greatest(n, 1)), 6) AS rejected_delta FROM lp JOIN ref USING (pair_id)")
def x64(spark: SparkSession, sf: str) -> DataFrame:
    j = logps(spark, sf).join(ref_logps(spark, sf), "pair_id")
    d = lambda a: r6(F.max(F.abs(F.col(f"{a}_logp") - F.col(f"{a}_ref_logp")) / F.greatest("n", F.lit(1))))
    return j.agg(d("chosen").alias("chosen_delta"), d("rejected").alias("rejected_delta"))


@R.add("a26_clip_fraction", f"WITH {ATTEMPTS}, g AS (SELECT benchmark, list(seconds ORDER BY seconds) AS v, avg((seconds > 300)::INT) AS clipped FROM att WHERE seconds IS NOT NULL GROUP BY 1) SELECT benchmark, round(v[least(len(v), floor(0.9 * len(v))::INT + 1)], 4) AS p90, round(clipped, 6) AS clip_fraction FROM g")
def a26(spark: SparkSession, sf: str) -> DataFrame:
    rows = attempts(spark, sf, "seconds")
    share = rows.where("seconds is not null").groupBy("benchmark").agg(r6(F.avg((F.col("seconds") > 300).cast("double"))).alias("clip_fraction"))
    got = S.order_statistics(rows, ["benchmark"], "seconds", {"p90": lambda n: N.nearest_rank_place(n, 0.9)})
    return got.join(share, "benchmark").select("benchmark", F.round("p90", 4).alias("p90"), "clip_fraction")


@R.add("a27_token_logp_means", f"WITH {_LOGPS} SELECT ref_n, round(avg(chosen_ref_logp / ref_n), 9) AS mean_logp, avg(chosen_ref_logp / ref_n) < -100.0 AS warn FROM ref GROUP BY 1")
def a27(spark: SparkSession, sf: str) -> DataFrame:
    m = F.avg(F.col("chosen_ref_logp") / F.col("ref_n"))
    return ref_logps(spark, sf).groupBy("ref_n").agg(F.round(m, 9).alias("mean_logp"), (m < -100.0).alias("warn"))


@R.add("a29_dataset_totals", f"WITH {_TOK} SELECT sum((len(ids) <> len(mask))::INT)::BIGINT AS misaligned, sum((len(ids) = 0)::INT)::BIGINT AS empty, sum((mask[1] = 1)::INT)::BIGINT AS leading, sum((len(ids) > 500)::INT)::BIGINT AS too_long, round(sum(list_sum(mask)) / greatest(1, sum(len(ids))), 6) AS fraction FROM tok")
def a29(spark: SparkSession, sf: str) -> DataFrame:
    i, m = F.col("ids"), F.col("mask")
    return tokens(spark, sf).agg(F.sum(big(F.size(i) != F.size(m))).alias("misaligned"), F.sum(big(F.size(i) == 0)).alias("empty"), F.sum(big(F.get(m, F.lit(0)) == 1)).alias("leading"), F.sum(big(F.size(i) > 500)).alias("too_long"), r6(N.ratio(A.total(m), F.size(i))).alias("fraction"))


@R.add("a30_mask_audit", f"WITH {_TOK}, few AS (SELECT * FROM tok ORDER BY trajectory_id LIMIT 100) SELECT sum(list_sum(mask))::BIGINT AS trained, round(quantile_cont(len(ids), 0.5), 6) AS p50, round(quantile_cont(len(ids), 0.95), 6) AS p95, floor(sum(list_sum(mask)) * (SELECT count(*) FROM tok) / count(*))::BIGINT AS projected FROM few")
def a30(spark: SparkSession, sf: str) -> DataFrame:
    """An audit of the first hundred rows, projected to all: the sample is the feature."""
    t = tokens(spark, sf)
    n = t.count()
    few = t.orderBy("trajectory_id").limit(100).select(A.total(F.col("mask")).alias("m"), F.size("ids").alias("n"))
    return few.agg(F.sum("m").alias("trained"), r6(F.percentile("n", F.lit(0.5))).alias("p50"), r6(F.percentile("n", F.lit(0.95))).alias("p95"), F.floor(F.sum("m") * n / F.count(F.lit(1))).cast("bigint").alias("projected"))


@R.add("a31_build_report", f"WITH {ATTEMPTS} SELECT benchmark, sum((returncode = 0)::INT)::BIGINT AS built, sum((returncode <> 0)::INT)::BIGINT AS failed, round(avg(CASE WHEN returncode = 0 THEN seconds END), 6) AS mean_seconds FROM att GROUP BY 1")
def a31(spark: SparkSession, sf: str) -> DataFrame:
    ok = F.col("returncode") == 0
    return attempts(spark, sf, "returncode", "seconds").groupBy("benchmark").agg(F.sum(big(ok)).alias("built"), F.sum(big(~ok)).alias("failed"), r6(F.avg(F.when(ok, F.col("seconds")))).alias("mean_seconds"))


@R.add("a32_pool_rates", f"WITH {TRAJ}, {CLEAN}, s AS (SELECT grp, avg(CASE WHEN reward >= 1.0 THEN 1.0 ELSE 0.0 END) AS p FROM clean WHERE grp IS NOT NULL GROUP BY 1) SELECT round(avg(p), 6) AS mean, round(min(p), 6) AS least, round(max(p), 6) AS most FROM s")
def a32(spark: SparkSession, sf: str) -> DataFrame:
    from quernix.plans.task_pool import group_stats

    return group_stats(trajectories(spark, sf)).agg(r6(F.avg("pass_rate")).alias("mean"), r6(F.min("pass_rate")).alias("least"), r6(F.max("pass_rate")).alias("most"))


_SHARDS = "sh AS (SELECT 'model_world_size_' || (4 + (o_custkey % 2) * 0) || '_rank_' || (o_orderkey % 5) || '.pt' AS name, o_totalprice::BIGINT AS size FROM orders WHERE o_orderkey % 5 <> 3)"


@R.add("a34_shard_completeness", f"WITH {_SHARDS}, p AS (SELECT regexp_extract(name, 'world_size_(\\d+)', 1)::BIGINT AS world, regexp_extract(name, 'rank_(\\d+)', 1)::BIGINT AS rank, size FROM sh), w AS (SELECT max(world) AS world, count(DISTINCT world) AS worlds FROM p) SELECT r.rank::BIGINT AS missing_rank, worlds::BIGINT AS worlds FROM w, range(0, w.world) r(rank) WHERE r.rank NOT IN (SELECT rank FROM p)")
def a34(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").where("o_orderkey % 5 <> 3")
    name = F.concat(F.lit("model_world_size_4_rank_"), F.col("o_orderkey") % 5, F.lit(".pt"))
    p = o.select(F.regexp_extract(name, r"world_size_(\d+)", 1).cast("bigint").alias("world"), F.regexp_extract(name, r"rank_(\d+)", 1).cast("bigint").alias("rank"))
    w = p.agg(F.max("world").alias("world"), F.countDistinct("world").alias("worlds"))
    want = w.select("worlds", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("world") - 1)).alias("rank"))
    return want.join(p.select("rank").distinct(), "rank", "left_anti").select(F.col("rank").alias("missing_rank"), "worlds")


@R.add("a35_shard_overlap", "SELECT l_orderkey::BIGINT AS pair_id, count(DISTINCT l_suppkey)::BIGINT AS shards FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 5")
def a35(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(big("l_orderkey").alias("pair_id")).agg(F.countDistinct("l_suppkey").alias("shards")).where("shards > 5")


@R.add("a38_first_and_last", f"WITH {TRAJ} SELECT model, arg_min(trajectory_id, (finished_at, trajectory_id)) AS first_id, arg_max(trajectory_id, (finished_at, trajectory_id)) AS last_id FROM traj WHERE finished_at IS NOT NULL GROUP BY 1")
def a38(spark: SparkSession, sf: str) -> DataFrame:
    key = F.struct("finished_at", "trajectory_id")
    return trajectories(spark, sf).where("finished_at is not null").groupBy("model").agg(F.min_by("trajectory_id", key).alias("first_id"), F.max_by("trajectory_id", key).alias("last_id"))


@R.add(
    "w01_rotate_sources",
    f"""WITH {TRAJ}, f AS (SELECT trajectory_id, grp, model, sha256('1228:' || trajectory_id) AS key FROM traj WHERE status = 'completed' AND has_trajectory AND NOT has_exception AND reward >= 1.0 AND task_present_in_task_dataset AND grp IS NOT NULL),
    p AS (SELECT *, row_number() OVER (PARTITION BY grp, model ORDER BY key, trajectory_id) AS place FROM f) SELECT trajectory_id, grp, model FROM p QUALIFY row_number() OVER (PARTITION BY grp ORDER BY place, model NULLS FIRST, key) <= 8""",
)
def w01(spark: SparkSession, sf: str) -> DataFrame:
    from quernix.operators.gates import trainable

    t = trajectories(spark, sf)
    return S.rotate_sources(t.where(trainable(t)).select("trajectory_id", "grp", "model"), "grp", "model", "trajectory_id", 8)


@R.add("w04_cap_per_prompt", f"WITH {TRAJ}, {CLEAN} SELECT grp, model, trajectory_id FROM clean WHERE grp IS NOT NULL QUALIFY row_number() OVER (PARTITION BY grp ORDER BY model NULLS FIRST, trajectory_id) <= 3")
def w04(spark: SparkSession, sf: str) -> DataFrame:
    from quernix.operators.gates import completed

    t = trajectories(spark, sf)
    rn = F.row_number().over(Window.partitionBy("grp").orderBy(F.col("model").asc_nulls_first(), "trajectory_id"))
    return t.where(completed(t) & F.col("grp").isNotNull()).select("grp", "model", "trajectory_id").withColumn("rn", rn).where("rn <= 3").drop("rn")


@R.add("w05_head_per_group", f"WITH {TASKS} SELECT task_group_id, task_id FROM task WHERE task_group_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY task_group_id ORDER BY task_id) <= 2")
def w05(spark: SparkSession, sf: str) -> DataFrame:
    rn = F.row_number().over(Window.partitionBy("task_group_id").orderBy("task_id"))
    return tasks(spark, sf, "task_group_id").where("task_group_id is not null").select("task_group_id", "task_id").withColumn("rn", rn).where("rn <= 2").drop("rn")


@R.add(
    "w06_holdout_until",
    f"""WITH {TRAJ}, s AS (SELECT grp, count(*) AS n, sha256('1228:' || grp) AS k FROM traj WHERE grp IS NOT NULL GROUP BY 1), c AS (SELECT grp, coalesce(sum(n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s)
    SELECT trajectory_id, CASE WHEN before < (SELECT least(256, floor(count(*) * 0.15)) FROM traj) THEN 'holdout' ELSE 'train' END AS split FROM traj LEFT JOIN c USING (grp)""",
)
def w06(spark: SparkSession, sf: str) -> DataFrame:
    return S.holdout_until(trajectories(spark, sf).select("trajectory_id", "grp"), "grp", 256, 0.15).select("trajectory_id", "split")


_LOG = "log AS (SELECT source AS file, doc_id AS line_no, CASE WHEN doc_id % 97 = 0 THEN '=== STAGE train' WHEN doc_id % 89 = 0 THEN '=== DONE train' ELSE 'step: ' || (doc_id % 50) || ' loss: ' || (doc_id % 7) || '.5 grad_norm=' || (doc_id % 3) || ' lr:1e-05' END AS text FROM documents)"


def _log(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("doc_id")
    line = F.concat(F.lit("step: "), d % 50, F.lit(" loss: "), d % 7, F.lit(".5 grad_norm="), d % 3, F.lit(" lr:1e-05"))
    text = F.when(d % 97 == 0, "=== STAGE train").when(d % 89 == 0, "=== DONE train").otherwise(line)
    return table(spark, sf, "documents").select(F.col("source").alias("file"), d.alias("line_no"), text.alias("text"))


@R.add("w08_curve", f"WITH {_LOG}, p AS (SELECT *, try_cast(nullif(regexp_extract(text, 'step: (\\d+)', 1), '') AS BIGINT) AS step, try_cast(nullif(regexp_extract(text, 'loss: ([0-9.]+)', 1), '') AS DOUBLE) AS loss, try_cast(nullif(regexp_extract(text, 'grad_norm=([0-9.]+)', 1), '') AS DOUBLE) AS gn FROM log) SELECT step, arg_min(loss, (file, line_no)) AS loss, arg_min(gn, (file, line_no)) AS grad_norm, 1e-05::DOUBLE AS lr, (count(*) - 1)::BIGINT AS repeats FROM p WHERE loss IS NOT NULL AND step IS NOT NULL GROUP BY 1")
def w08(spark: SparkSession, sf: str) -> DataFrame:
    return Q.curve(_log(spark, sf), "file", "line_no", "text")


@R.add(
    "w09_stage_lines",
    f"""WITH {_LOG}, k AS (SELECT *, regexp_matches(text, '^=== ') AS mark, last_value(CASE WHEN regexp_matches(text, '^=== ') THEN text END IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_no) AS mk, max(CASE WHEN starts_with(text, '=== STAGE') THEN 1 ELSE 0 END) OVER (PARTITION BY file) AS any_stage FROM log)
    SELECT file, line_no FROM k WHERE (mk = '=== STAGE train' AND NOT mark) OR any_stage = 0""",
)
def w09(spark: SparkSession, sf: str) -> DataFrame:
    return Q.stage_lines(_log(spark, sf), "file", "line_no", "text", "train").select("file", "line_no")


@R.add("w10_curve_ends", f"WITH {_LOG}, p AS (SELECT file, line_no, try_cast(nullif(regexp_extract(text, 'loss: ([0-9.]+)', 1), '') AS DOUBLE) AS loss FROM log) SELECT file, arg_min(loss, line_no) AS first_loss, arg_max(loss, line_no) AS last_loss, min(loss) AS least_loss FROM p WHERE loss IS NOT NULL GROUP BY 1")
def w10(spark: SparkSession, sf: str) -> DataFrame:
    rows = _log(spark, sf).select("file", "line_no", X.log_fields(F.col("text"))["loss"].alias("loss")).where("loss is not null")
    return rows.groupBy("file").agg(F.min_by("loss", "line_no").alias("first_loss"), F.max_by("loss", "line_no").alias("last_loss"), F.min("loss").alias("least_loss"))


@R.add(
    "w11_previous_turn",
    f"""WITH {CHATS}, t AS (SELECT trial_name, unnest(range(1, len(conversations) + 1)) AS i, unnest(conversations) AS m FROM chat), k AS (SELECT trial_name, i, m.role AS role, last_value(CASE WHEN m.role = 'assistant' THEN coalesce(len(m.content), 0) % 2 = 1 END IGNORE NULLS) OVER (PARTITION BY trial_name ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM t)
    SELECT trial_name, (i - 1)::BIGINT AS turn, coalesce(before, false) AS repaired FROM k WHERE role = 'user'""",
)
def w11(spark: SparkSession, sf: str) -> DataFrame:
    t = chats(spark, sf).select("trial_name", F.posexplode("conversations").alias("turn", "m"))
    lead = F.lit("Previous response had warnings:\nx\n\nNew Terminal Output:")
    t = t.select("trial_name", big("turn").alias("turn"), F.col("m.role").alias("role"), F.when(F.col("m.role") == "user", lead).otherwise(F.col("m.content")).alias("content"), (F.length(F.coalesce("m.content", F.lit(""))) % 2 == 1).alias("rw"))
    fixed = Q.repaired_turns(t, "trial_name", "turn", "role", "content", "rw").where("role = 'user'")
    return fixed.select("trial_name", "turn", (F.col("content") == "New Terminal Output:").alias("repaired"))


@R.add("w13_spread_turns", f"WITH {SFT}, k AS (SELECT trajectory_id, len(list_filter(messages, lambda m: m.role = 'assistant'))::INT AS n FROM sft) SELECT trajectory_id, unnest(CASE WHEN n <= 0 THEN [] WHEN n <= 3 THEN range(0, n) ELSE list_transform(range(0, 3), lambda i: round_even(i * (n - 1) / 2.0, 0)::BIGINT) END)::BIGINT AS pick FROM k")
def w13(spark: SparkSession, sf: str) -> DataFrame:
    n = F.size(F.filter("messages", lambda m: m["role"] == "assistant"))
    return sft(spark, sf).select("trajectory_id", F.explode(A.spread_indices(n, 3)).alias("pick")).select("trajectory_id", big("pick").alias("pick"))


@R.add("w14_strided_sample", f"WITH {TASKS}, k AS (SELECT task_id, row_number() OVER (ORDER BY task_id, task_content_sha256) - 1 AS r, count(*) OVER () AS n FROM task) SELECT task_id FROM k WHERE r % greatest(1, n // 25) = 0 AND r < 25 * greatest(1, n // 25)")
def w14(spark: SparkSession, sf: str) -> DataFrame:
    return S.strided(tasks(spark, sf, "task_content_sha256"), ["task_id", "task_content_sha256"], 25).select("task_id")


@R.add("w15_strided_shard", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS r FROM documents) WHERE r % 8 = 3")
def w15(spark: SparkSession, sf: str) -> DataFrame:
    return S.shard_of(table(spark, sf, "documents").select("doc_id"), ["doc_id"], 3, 8)


@R.add("w16_usable_prefix", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS r, count(*) OVER () AS n FROM documents) WHERE r < n // 64 * 64")
def w16(spark: SparkSession, sf: str) -> DataFrame:
    return S.usable_prefix(table(spark, sf, "documents").select("doc_id"), ["doc_id"], 64)


@R.add(
    "w17_next_fit",
    f"""WITH RECURSIVE {TASKS}, o AS (SELECT shard, task_id, coalesce(len(instruction), 0)::BIGINT AS size, row_number() OVER (PARTITION BY shard ORDER BY task_id, coalesce(len(instruction), 0)) AS k FROM task),
    f AS (SELECT shard, task_id, size, k, 0::BIGINT AS bin, size AS used FROM o WHERE k = 1 UNION ALL SELECT o.shard, o.task_id, o.size, o.k, CASE WHEN f.used + o.size > 4000 AND f.used > 0 THEN f.bin + 1 ELSE f.bin END, CASE WHEN f.used + o.size > 4000 AND f.used > 0 THEN o.size ELSE f.used + o.size END FROM f JOIN o ON o.shard = f.shard AND o.k = f.k + 1)
    SELECT shard, task_id, bin FROM f""",
)
def w17(spark: SparkSession, sf: str) -> DataFrame:
    """Next fit in order of keys within a shard, whose catalogue is bounded like its header."""
    rows = tasks(spark, sf).select("shard", F.struct("task_id", big(F.coalesce(F.length("instruction"), F.lit(0))).alias("size")).alias("e"))
    lists = rows.groupBy("shard").agg(F.array_sort(F.collect_list("e")).alias("es"))
    bins = lists.withColumn("bins", Q.next_fit(F.col("es.size"), 4000))
    return bins.select("shard", F.inline(F.arrays_zip(F.col("es.task_id").alias("task_id"), F.col("bins").alias("bin")))).select("shard", "task_id", "bin")


@R.add("w18_longest_first_fit", f"WITH {SFT}, o AS (SELECT n_tokens, row_number() OVER (ORDER BY n_tokens DESC, trajectory_id) AS k FROM sft WHERE n_tokens > 0), c AS (SELECT k, sum(n_tokens) OVER (ORDER BY k) AS used FROM o) SELECT (4 * count(*))::BIGINT AS fit FROM c WHERE used <= 30000")
def w18(spark: SparkSession, sf: str) -> DataFrame:
    budget = 30_000
    # items have a token at least, so no more than budget of them can fit
    top = sft(spark, sf, "n_tokens").where("n_tokens > 0").orderBy(F.desc("n_tokens"), "trajectory_id").limit(budget).select("n_tokens", "trajectory_id")
    used = F.sum("n_tokens").over(Window.orderBy(F.desc("n_tokens"), "trajectory_id").rowsBetween(Window.unboundedPreceding, 0))
    return top.withColumn("used", used).where(F.col("used") <= budget).agg((4 * F.count(F.lit(1))).alias("fit"))


@R.add("w19_worst_case_batches", f"WITH {SFT} SELECT ceil(sum(n_tokens) / 8192.0)::BIGINT AS worst FROM (SELECT n_tokens FROM sft WHERE n_tokens IS NOT NULL ORDER BY n_tokens DESC LIMIT 32)")
def w19(spark: SparkSession, sf: str) -> DataFrame:
    return sft(spark, sf, "n_tokens").where("n_tokens is not null").orderBy(F.desc("n_tokens")).limit(32).agg(F.ceil(F.sum("n_tokens") / 8192.0).cast("bigint").alias("worst"))


@R.add("w21_schedule", "SELECT s::BIGINT AS step, round(CASE WHEN s < 30 THEN 0.001 * (s + 1) / 30.0 ELSE 0.001 * 0.5 * (1.0 + cos(pi() * least((s - 30) / 970.0, 1.0))) END, 9) AS lr FROM range(0, 1000) t(s)")
def w21(spark: SparkSession, sf: str) -> DataFrame:
    return spark.range(1000).select(F.col("id").alias("step"), F.round(N.cosine_schedule(F.col("id"), 1000, 30, 0.001), 9).alias("lr"))


@R.add("l01_hash_order", f"WITH {TRAJ} SELECT trajectory_id, sha256('7:' || trajectory_id) AS key FROM traj ORDER BY key LIMIT 50")
def l01(spark: SparkSession, sf: str) -> DataFrame:
    return trajectories(spark, sf).select("trajectory_id", S.order_key(7, F.col("trajectory_id")).alias("key")).orderBy("key").limit(50)


@R.add("l02_global_sort", f"WITH {TASKS} SELECT task_id, task_group_id FROM task ORDER BY task_id")
def l02(spark: SparkSession, sf: str) -> DataFrame:
    return tasks(spark, sf, "task_group_id").orderBy("task_id")


@R.add("l04_longest", f"WITH {SFT} SELECT trajectory_id, n_tokens FROM sft ORDER BY n_tokens DESC NULLS LAST, trajectory_id LIMIT 16")
def l04(spark: SparkSession, sf: str) -> DataFrame:
    return sft(spark, sf, "n_tokens").orderBy(F.col("n_tokens").desc_nulls_last(), "trajectory_id").limit(16)


@R.add("l05_histogram_order", f"WITH {TRAJ} SELECT status, count(*)::BIGINT AS n FROM traj GROUP BY 1 ORDER BY 2 DESC, 1")
def l05(spark: SparkSession, sf: str) -> DataFrame:
    return trajectories(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "status")


@R.add("l07_latest_version", "SELECT lang, max(regexp_extract(source || '_' || doc_id, '_(\\d+)$', 1)::BIGINT) AS latest FROM documents GROUP BY 1")
def l07(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat("source", F.lit("_"), "doc_id")
    return table(spark, sf, "documents").groupBy("lang").agg(F.max(F.regexp_extract(name, r"_(\d+)$", 1).cast("bigint")).alias("latest"))


QUERIES, SQL = R.queries, R.sql
