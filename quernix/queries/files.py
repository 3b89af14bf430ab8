"""Round trips of files: what the sinks write the readers read back."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernix.queries.base import ATTEMPTS, TASKS, Registry, attempts, big, tasks
from quernix.runtime import scratch, table
from quernix.sources import readers as S
from quernix.sources import writers as K

R = Registry()


def _one(spark: SparkSession, **values: object) -> DataFrame:
    return spark.createDataFrame([tuple(values.values())], list(values))


def _trials_by_benchmark(spark: SparkSession, sf: str) -> list[tuple[str, int]]:
    """One row for each benchmark."""
    return sorted((r[0], r[1]) for r in attempts(spark, sf).groupBy("benchmark").count().collect())


@R.add("s09_log_lines", "SELECT doc_id, len(regexp_replace(text, '[\\r\\n]+', ' ', 'g'))::BIGINT AS n FROM documents WHERE text IS NOT NULL")
def s09(spark: SparkSession, sf: str) -> DataFrame:
    """Every text as a line of a log, read back line by line."""
    path = scratch(spark, "log")
    rows = table(spark, sf, "documents").where("text is not null")
    rows.select(F.concat(F.col("doc_id").cast("string"), F.lit("|"), F.regexp_replace("text", r"[\r\n]+", " ")).alias("value")).write.text(path)
    parts = F.split("text", r"\|", 2)
    return S.log_lines(spark, [path]).where("text <> ''").select(parts[0].cast("bigint").alias("doc_id"), big(F.length(parts[1])).alias("n"))


@R.add("s10_result_documents", f"WITH {ATTEMPTS} SELECT benchmark, count(*)::BIGINT AS trials FROM att GROUP BY 1")
def s10(spark: SparkSession, sf: str) -> DataFrame:
    """Result documents in the three layouts of a job, beside one in a place that is none."""
    job = scratch(spark, "job")
    for k, (benchmark, n) in enumerate(_trials_by_benchmark(spark, sf)):
        K.write_text(spark, f"{job}/{'' if k == 0 else 'trials/' if k % 2 else ''}{f't{k}/' if k else ''}result.json", json.dumps({"benchmark": benchmark, "trials": n}))
    K.write_text(spark, f"{job}/trials/t1/deeper/result.json", json.dumps({"benchmark": "none", "trials": 0}))
    return S.result_documents(spark, job).select(F.from_json("payload", "benchmark string, trials bigint").alias("d")).select("d.*")


@R.add("s11_newest_logs", "SELECT 'run' || (i + 2) || '.log' AS file, i::BIGINT AS place, i + 2 AS lines FROM (SELECT unnest(range(4)) AS i)")
def s11(spark: SparkSession, sf: str) -> DataFrame:
    """Six logs written one after the other, the k-th of k lines; the newest four, oldest of them first."""
    folder = scratch(spark, "logs")
    for k in range(6):
        K.write_text(spark, f"{folder}/d{k % 2}/run{k}.log", "line\n" * k)
        time.sleep(0.02)
    newest = S.newest_logs(spark, folder)
    order = spark.createDataFrame([(p, k) for k, p in enumerate(newest)], "file string, place bigint")
    lines = S.log_lines(spark, newest).groupBy("file").agg(F.count(F.lit(1)).alias("lines"))
    return order.join(lines, "file").select(F.regexp_extract("file", "([^/]+)$", 1).alias("file"), "place", "lines")


@R.add("s12_task_folders", f"WITH {TASKS} SELECT DISTINCT shard AS folder FROM task WHERE shard IS NOT NULL")
def s12(spark: SparkSession, sf: str) -> DataFrame:
    """A folder with an instruction for each shard, below the root's tasks folder, and one too deep."""
    root = scratch(spark, "release")
    for r in tasks(spark, sf, "shard").select("shard").where("shard is not null").distinct().collect():
        K.write_text(spark, f"{root}/tasks/{r.shard}/instruction.md", "do it")
    K.write_text(spark, f"{root}/tasks/a/b/instruction.md", "too deep")
    return S.task_folders(spark, root).select(F.regexp_extract("folder", "([^/]+)$", 1).alias("folder"))


@R.add("s13_weight_headers", f"WITH {ATTEMPTS} SELECT benchmark || '.safetensors' AS shard, 'w.' || run AS key, (2 * count(*))::BIGINT AS nbytes, count(*)::BIGINT AS width FROM att GROUP BY benchmark, run")
def s13(spark: SparkSession, sf: str) -> DataFrame:
    """Weight files, one for each benchmark, with a tensor for each run; only their headers are read."""
    folder = scratch(spark, "weights")
    rows = attempts(spark, sf).groupBy("benchmark", "run").count().collect()
    for b in {r.benchmark for r in rows}:
        header, at = {"__metadata__": {"format": "pt"}}, 0
        for r in sorted((r for r in rows if r.benchmark == b), key=lambda r: r.run):
            header[f"w.{r.run}"] = {"dtype": "BF16", "shape": [r["count"]], "data_offsets": [at, at + 2 * r["count"]]}
            at += 2 * r["count"]
        head = json.dumps(header).encode()
        K.write_bytes(spark, f"{folder}/{b}.safetensors", len(head).to_bytes(8, "little") + head + bytes(at))
    return S.safetensors_catalogue(spark, folder).select("shard", "key", "nbytes", F.col("shape")[0].alias("width"))


@R.add("s18_existing_paths", "SELECT 'b' AS name, 0::BIGINT AS place UNION ALL SELECT 'a', 1")
def s18(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch(spark, "candidates")
    for name in "ab":
        K.write_text(spark, f"{folder}/{name}", name)
    got = S.existing(spark, [f"{folder}/{name}" for name in ("x", "b", "y", "a")])
    return spark.createDataFrame([(p.rsplit("/", 1)[-1], k) for k, p in enumerate(got)], "name string, place bigint")


@R.add("j18_manifest_check", "SELECT * FROM (VALUES ('cut', 'size'), ('gone', 'missing'), ('other', 'sha256')) AS t(shard, problem)")
def j18(spark: SparkSession, sf: str) -> DataFrame:
    """Files against the manifest they were published with: one sound, one shorter, one changed, one gone."""
    folder = scratch(spark, "shards")
    for name, body in (("sound", "abc"), ("cut", "ab"), ("other", "abd")):
        K.write_text(spark, f"{folder}/{name}", body)
    manifest = spark.createDataFrame([(n,) for n in ("sound", "cut", "other", "gone")], "shard string").select("shard", F.lit(3).cast("bigint").alias("size_bytes"), F.sha2(F.lit("abc"), 256).alias("sha256"))
    return S.verify_manifest(S.file_fingerprints(spark, folder), manifest)


@R.add("k06_exclusions", f"WITH {TASKS} SELECT task_id FROM task WHERE dockerfile IS NULL")
def k06(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "exclusions")
    bare = tasks(spark, sf, "dockerfile").where("dockerfile is null").select("task_id")
    written = K.exclusions(bare, path)
    none = K.exclusions(bare.where("false"), path + "-none")
    if none or not written:
        return bare.where("false")
    return S.json_lines(spark, path, "task_id string")


@R.add("k07_cache_in_order", f"WITH {TASKS} SELECT task_id, (row_number() OVER (ORDER BY task_id) - 1)::BIGINT AS place FROM (SELECT DISTINCT task_id FROM task)")
def k07(spark: SparkSession, sf: str) -> DataFrame:
    """A cached table keeps its rows in the order of ids, over its files in the order of their names."""
    from quernix.operators.selection import numbered

    folder = scratch(spark, "cache")
    ids = table(spark, sf, "tasks").select("task_id").distinct()
    got = K.cached(spark, folder, K.cache_signature(kind="ids"), lambda: ids.orderBy("task_id"))
    return numbered(got.withColumn("f", F.col("_metadata.file_name")).withColumn("at", F.monotonically_increasing_id()), ["f", "at"], "place").select("task_id", "place")


@R.add("k09_metrics_lines", f"WITH {ATTEMPTS} SELECT benchmark, (2 * count(*))::BIGINT AS trials FROM att GROUP BY 1")
def k09(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics appended twice; both are there."""
    path = scratch(spark, "metrics")
    rows = attempts(spark, sf).groupBy("benchmark").agg(F.count(F.lit(1)).alias("trials"))
    for _ in range(2):
        K.append_json_lines(rows, path)
    return S.json_lines(spark, path, "benchmark string, trials bigint").groupBy("benchmark").agg(F.sum("trials").alias("trials"))


@R.add("k10_report", f"WITH {ATTEMPTS} SELECT '| ' || benchmark || ' \\| x | ' || count(*) || ' |' AS line FROM att GROUP BY benchmark UNION ALL SELECT unnest(['# Runs', '## trials', '| benchmark | trials |', '|---|---|'])")
def k10(spark: SparkSession, sf: str) -> DataFrame:
    """A report in Markdown, written and read back; cells with a bar in them."""
    path = scratch(spark, "report")
    rows = attempts(spark, sf).groupBy("benchmark").agg(F.count(F.lit(1)).alias("trials"))
    K.write_text(spark, f"{path}/report.md", K.render_report("Runs", {"trials": rows.select(F.concat("benchmark", F.lit(" | x")).alias("benchmark"), "trials")}))
    return S.log_lines(spark, [path]).where("text <> ''").select(F.col("text").alias("line"))


@R.add("k11_verdict", f"WITH {ATTEMPTS} SELECT benchmark, CASE WHEN sum((infra_reason IS NOT NULL)::INT) > 0 THEN 'WARN' ELSE 'OK' END AS level FROM att GROUP BY 1")
def k11(spark: SparkSession, sf: str) -> DataFrame:
    """A verdict document with a level for each benchmark."""
    path = scratch(spark, "verdict")
    told = attempts(spark, sf, "infra_reason").groupBy("benchmark").agg(F.when(F.count("infra_reason") > 0, "WARN").otherwise("OK").alias("level"))
    K.write_text(spark, f"{path}/verdict.json", json.dumps({"in_range": True, "checks": [r.asDict() for r in told.collect()]}))
    checks = F.try_variant_get("document", "$.checks", "array<struct<benchmark: string, level: string>>")
    return S.json_documents(spark, path).select(F.inline(checks))


@R.add("k13_publish", f"WITH {TASKS} SELECT 'ids' AS part, count(DISTINCT task_id)::BIGINT AS n FROM task UNION ALL SELECT 'shards', count(DISTINCT shard)::BIGINT FROM task")
def k13(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables published together in place of others."""
    target = scratch(spark, "published")
    t = tasks(spark, sf, "shard")
    K.publish(spark, {"ids": t.limit(1), "old": t.limit(1)}, target)
    K.publish(spark, {"ids": t.select("task_id").distinct(), "shards": t.select("shard").where("shard is not null").distinct()}, target)
    gone = S.existing(spark, [f"{target}/old"])
    parts = {name: spark.read.parquet(f"{target}/{name}") for name in ("ids", "shards", *("old" for _ in gone))}
    return S.tagged_union({k: v.agg(F.count(F.lit(1)).alias("n")) for k, v in parts.items()}).select(F.col("split").alias("part"), "n")


@R.add("k14_provenance", f"WITH {ATTEMPTS} SELECT count(*)::BIGINT AS n_rows, true AS same_signature, 'base' AS model FROM att")
def k14(spark: SparkSession, sf: str) -> DataFrame:
    """What a scoring run was made with, written before its scores, and its manifest, written after them."""
    folder = scratch(spark, "scoring")
    signature = K.write_provenance(spark, folder, model="base", seed=1228)
    K.finish_provenance(attempts(spark, sf, "reward"), folder, signature)
    docs = S.json_documents(spark, f"{folder}/*.json").select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), F.try_variant_get("document", "$.signature", "string").alias("s"), F.try_variant_get("document", "$.rows", "bigint").alias("n"), F.try_variant_get("document", "$.model", "string").alias("m"))
    return docs.agg(F.max("n").alias("n_rows"), (F.countDistinct("s") == 1).alias("same_signature"), F.max("m").alias("model"))


@R.add("x45_cache_signature", "SELECT true AS order_free, true AS value_bound")
def x45(spark: SparkSession, sf: str) -> DataFrame:
    one = K.cache_signature(a=1, b=[2, 3])
    return _one(spark, order_free=one == K.cache_signature(b=[2, 3], a=1), value_bound=one != K.cache_signature(a=1, b=[3, 2]))


@R.add("x46_checkpoint_fingerprint", "SELECT true AS stable, true AS by_config, true AS by_head, true AS not_by_tail")
def x46(spark: SparkSession, sf: str) -> DataFrame:
    """Name, size and head of every file and the configuration make the fingerprint; what is beyond the head doesn't."""
    prints = {}
    for name, body in (("a", "head|tail"), ("same", "head|tail"), ("tail", "head|TAIL"), ("head", "HEAD|tail")):
        folder = scratch(spark, f"checkpoint-{name}")
        K.write_text(spark, f"{folder}/model.bin", body)
        prints[name] = S.file_fingerprints(spark, folder, head=4, whole=False)
    p = {k: S.fingerprint(v, "c") for k, v in prints.items()}
    return _one(spark, stable=p["a"] == p["same"], by_config=p["a"] != S.fingerprint(prints["a"], "d"), by_head=p["a"] != p["head"], not_by_tail=p["a"] == p["tail"])


QUERIES, SQL = R.queries, R.sql
