"""Smaller operators on logs, batches, shards and outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernix.functions import text as X
from quernix.operators import outcomes as O
from quernix.operators import selection as S
from quernix.plans import evaluation as E
from quernix.queries.aggregates import _LOG, _log
from quernix.queries.base import ATTEMPTS, SFT, TASKS, Registry, attempts, big, r6, sft, tasks
from quernix.queries.joins import _LOGPS, logps, ref_logps
from quernix.runtime import table

R = Registry()


@R.add("f17_unnumbered_lines", "WITH log AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'loss: 1.5' WHEN doc_id % 4 = 1 THEN 'step 3 loss=2.5' ELSE 'nothing' END AS text FROM documents) SELECT contains(text, 'step') AS numbered, count(*)::BIGINT AS n FROM log WHERE contains(text, 'loss') GROUP BY 1")
def f17(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id") % 4
    line = F.when(k == 0, "loss: 1.5").when(k == 1, "step 3 loss=2.5").otherwise("nothing")
    f = X.log_fields(line)
    rows = table(spark, sf, "documents").select(f["loss"].alias("loss"), f["step"].alias("step")).where("loss is not null")
    return rows.groupBy(F.col("step").isNotNull().alias("numbered")).agg(F.count(F.lit(1)).alias("n"))


@R.add("l03_capped_head", f"WITH {TASKS} SELECT task_id FROM (SELECT DISTINCT task_id FROM task) ORDER BY task_id LIMIT 40")
def l03(spark: SparkSession, sf: str) -> DataFrame:
    """A cap of 0 is none; here it is 40."""
    cap = 40
    ordered = table(spark, sf, "tasks").select("task_id").distinct().orderBy("task_id")
    return ordered.limit(cap) if cap else ordered


@R.add("x24_image_tags", f"WITH {TASKS} SELECT DISTINCT task_id, 'agent-task:' || lower(regexp_replace(task_id, '[^A-Za-z0-9_.-]', '-', 'g')) AS tag FROM task")
def x24(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "tasks").select("task_id", F.concat(F.lit("agent-task:"), F.lower(F.regexp_replace("task_id", "[^A-Za-z0-9_.-]", "-"))).alias("tag")).distinct()


@R.add("x29_implied_shards", "SELECT p_partkey::BIGINT AS part, round(p_size * 4.0 / (1 + p_partkey % 9))::BIGINT AS degree, p_size * 4.0 / (1 + p_partkey % 9) * 0.55 > 20 AS over FROM part")
def x29(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("p_size") * 4.0 / (1 + F.col("p_partkey") % 9)
    return table(spark, sf, "part").select(big("p_partkey").alias("part"), F.round(d).cast("bigint").alias("degree"), (d * 0.55 > 20).alias("over"))


@R.add("x61_length_normalised", f"WITH {_LOGPS} SELECT pair_id, round(chosen_logp / n, 9) AS chosen, round(rejected_logp / n, 9) AS rejected FROM lp")
def x61(spark: SparkSession, sf: str) -> DataFrame:
    return logps(spark, sf).select("pair_id", F.round(F.col("chosen_logp") / F.col("n"), 9).alias("chosen"), F.round(F.col("rejected_logp") / F.col("n"), 9).alias("rejected"))


def micro_batches(lengths: DataFrame, column: str, batch: int, world: int, sp: int, per_gpu: int) -> DataFrame:
    """(dp, per_dp, typical, worst) batches of a step; raises if a sample can't be placed at all. The worst rank holds the
    longest samples, of which only per_dp are needed."""
    dp = world // sp
    per_dp, budget = -(-batch // dp), per_gpu * sp
    mean = lengths.agg(F.avg(column).alias("mean"), F.max(column).alias("most"))
    top = lengths.orderBy(F.desc(column)).limit(per_dp).agg(F.sum(column).alias("top"))
    fits: Column = F.when(F.col("most") > budget, F.raise_error(F.lit(f"a sample exceeds the budget of {budget}")).cast("bigint"))
    at_least_one = lambda c: F.greatest(F.lit(1), F.ceil(c / F.lit(float(budget)))).cast("bigint")
    both = mean.crossJoin(F.broadcast(top))  # one row each
    return both.select(F.lit(dp).cast("bigint").alias("dp"), F.lit(per_dp).cast("bigint").alias("per_dp"), fits.otherwise(at_least_one(per_dp * F.col("mean"))).alias("typical"), at_least_one(F.col("top")).alias("worst"))


@R.add("x67_micro_batches", f"WITH {SFT}, l AS (SELECT n_tokens FROM sft WHERE n_tokens IS NOT NULL) SELECT 4::BIGINT AS dp, 32::BIGINT AS per_dp, greatest(1, ceil(32 * (SELECT avg(n_tokens) FROM l) / 8192.0))::BIGINT AS typical, greatest(1, ceil((SELECT sum(n_tokens) FROM (SELECT n_tokens FROM l ORDER BY n_tokens DESC LIMIT 32)) / 8192.0))::BIGINT AS worst")
def x67(spark: SparkSession, sf: str) -> DataFrame:
    return micro_batches(sft(spark, sf, "n_tokens").where("n_tokens is not null").select("n_tokens"), "n_tokens", 128, 32, 8, 1024)


@R.add("x75_shard_counts", "SELECT p_partkey::BIGINT AS part, ceil(p_size * 1.0 / (1 + p_partkey % 7))::BIGINT AS shards FROM part")
def x75(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(big("p_partkey").alias("part"), F.ceil(F.col("p_size") * 1.0 / (1 + F.col("p_partkey") % 7)).cast("bigint").alias("shards"))


@R.add("a36_weight_bytes", "SELECT p_brand AS model, sum(p_size * 1000)::BIGINT AS bytes, sum(p_size * 1000) * 8 > 400000 AS too_much FROM part GROUP BY 1")
def a36(spark: SparkSession, sf: str) -> DataFrame:
    n = F.sum(big(F.col("p_size") * 1000))
    return table(spark, sf, "part").groupBy(F.col("p_brand").alias("model")).agg(n.alias("bytes"), (n * 8 > 400000).alias("too_much"))


@R.add("r11_reference_gates", f"WITH {_LOGPS} SELECT count(DISTINCT ref_n)::BIGINT AS identities, (SELECT count(*) FROM lp WHERE pair_id NOT IN (SELECT pair_id FROM ref))::BIGINT AS uncovered FROM ref")
def r11(spark: SparkSession, sf: str) -> DataFrame:
    ref = ref_logps(spark, sf)
    gap = logps(spark, sf).join(ref, "pair_id", "left_anti").agg(F.count(F.lit(1)).alias("uncovered"))
    return ref.agg(F.countDistinct("ref_n").alias("identities")).crossJoin(F.broadcast(gap))  # one row each


@R.add("r17_rollout_disposition", f"WITH {ATTEMPTS} SELECT benchmark, run, task_id, infra_reason IS NOT NULL OR (reward IS NULL AND budget_reason IS NULL) AS remove_sample, CASE WHEN infra_reason IS NOT NULL THEN NULL WHEN budget_reason IS NOT NULL THEN 0.0 ELSE reward END::DOUBLE AS kept_reward FROM att")
def r17(spark: SparkSession, sf: str) -> DataFrame:
    o = F.when(F.col("infra_reason").isNotNull(), O.infra(F.col("infra_reason"))).when(F.col("budget_reason").isNotNull(), O.budget(F.col("budget_reason"))).when(F.col("reward").isNotNull(), O.scored(F.col("reward"))).otherwise(O.infra(F.lit("no samples")))
    return attempts(spark, sf).select("benchmark", "run", "task_id", o.alias("o")).select("benchmark", "run", "task_id", F.coalesce(F.col("o.kind") == "harness_infra", F.lit(False)).alias("remove_sample"), F.col("o.reward").alias("kept_reward"))


@R.add("r03_curve_findings", f"WITH {_LOG}, p AS (SELECT file, line_no, try_cast(nullif(regexp_extract(text, 'loss: ([0-9.]+)', 1), '') AS DOUBLE) AS loss FROM log), e AS (SELECT file, arg_min(loss, line_no) AS a, arg_max(loss, line_no) AS b FROM p WHERE loss IS NOT NULL GROUP BY 1) SELECT CASE WHEN b >= a THEN 'WARN' ELSE 'OK' END AS level, count(*)::BIGINT AS n FROM e GROUP BY 1")
def r03(spark: SparkSession, sf: str) -> DataFrame:
    rows = _log(spark, sf).select("file", "line_no", X.log_fields(F.col("text"))["loss"].alias("loss")).where("loss is not null")
    ends = rows.groupBy("file").agg(F.min_by("loss", "line_no").alias("a"), F.max_by("loss", "line_no").alias("b"))
    f = E.finding(ends, "training", "loss_fell", F.when(F.col("b") >= F.col("a"), "WARN").otherwise("OK"), F.col("file"))
    return E.level_counts(f)


@R.add("x68_parallel_degrees", "SELECT p_partkey::BIGINT AS part, ((1 + p_size) * 8 // (1 + p_partkey % 4))::BIGINT AS dp, ((1 + p_size) * 8) % (1 + p_partkey % 4) = 0 AS valid FROM part")
def x68(spark: SparkSession, sf: str) -> DataFrame:
    gpus, model = (1 + F.col("p_size")) * 8, 1 + F.col("p_partkey") % 4
    problems = F.array_compact(F.array(F.when(gpus % model != 0, F.lit("gpus not divisible"))))
    return table(spark, sf, "part").select(big("p_partkey").alias("part"), F.floor(gpus / model).cast("bigint").alias("dp"), (F.size(problems) == 0).alias("valid"))


@R.add("w15_every_shard_once", "SELECT count(*)::BIGINT AS n, count(DISTINCT doc_id)::BIGINT AS ids FROM documents")
def w15(spark: SparkSession, sf: str) -> DataFrame:
    """All strided shards together hold every row once."""
    rows = S.numbered(table(spark, sf, "documents").select("doc_id"), ["doc_id"]).withColumn("shard", F.col("row_no") % 8)
    return rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("ids")).agg(F.sum("n").alias("n"), F.sum("ids").alias("ids"))


QUERIES, SQL = R.queries, R.sql
