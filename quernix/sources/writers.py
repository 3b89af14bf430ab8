"""Sinks: tables, JSON lines, manifests, reports. Tables are written by all executors under Spark's commit protocol."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_COLUMNS = ["messages", "trajectory_id", "task_group_id", "model_name", "n_tokens", "n_assistant_turns", "n_rewritten_turns"]
TOKEN_COLUMNS = ["input_ids", "loss_mask", "n_tokens", "n_trained_tokens", "trajectory_id", "task_group_id", "model_name"]


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_messages(df: DataFrame, path: str) -> None:
    """The seven columns of a messages table in order of trajectory_id, ranges of it file by file."""
    df.select(*MESSAGE_COLUMNS).orderBy("trajectory_id").write.mode("overwrite").parquet(path)


def write_tokens(df: DataFrame, path: str) -> None:
    df.select(*TOKEN_COLUMNS).write.mode("overwrite").parquet(path)


def write_splits(df: DataFrame, path: str) -> None:
    """A table with a folder for each split."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_text(spark: SparkSession, path: str, content: str) -> None:
    write_bytes(spark, path, content.encode())


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small document, whole or not at all: written beside its place, then renamed."""
    fs, target = _fs(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.partial-{uuid.uuid4().hex[:8]}")
    out = fs.create(part, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"could not rename to {path}")


def manifest_row(df: DataFrame, length: str, group: str, model: str) -> DataFrame:
    """One row of counts, length quantiles and source mix of a table."""
    mix = df.groupBy(model).agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.coalesce(model, F.lit("?")), "n")))).alias("model_mix"))
    n = F.coalesce(length, F.lit(0))
    q = F.percentile(n, F.array(F.lit(0.5), F.lit(0.9), F.lit(0.99)))
    stats = df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct(group).alias("n_groups"), F.coalesce(F.sum(n), F.lit(0)).alias("total_tokens"), F.coalesce(F.avg(n), F.lit(0.0)).alias("mean_tokens"), F.coalesce(F.max(n), F.lit(0)).alias("max_tokens"), q.alias("q"),
    )
    return stats.select("*", F.get("q", F.lit(0)).alias("p50"), F.get("q", F.lit(1)).alias("p90"), F.get("q", F.lit(2)).alias("p99")).drop("q").crossJoin(F.broadcast(mix))


def write_manifest(df: DataFrame, path: str, **extra: object) -> dict:
    """A one-row table and settings as a JSON document."""
    doc = {**json.loads(df.toJSON().first()), **extra}
    write_text(df.sparkSession, path, json.dumps(doc, indent=2, ensure_ascii=False) + "\n")
    return doc


def task_pool_rows(tasks: DataFrame, folder: str) -> DataFrame:
    """Prompt rows of a task pool; the pass rate is null where nothing was tried."""
    from quernix.functions.text import base_image

    meta = F.struct(
        "task_id", "task_group_id", F.concat(F.lit(folder.rstrip("/") + "/"), "task_id").alias("task_dir"), "task_content_sha256", base_image(F.col("dockerfile")).alias("base_image"), "tier",
        F.when(F.col("n_trials") > 0, F.col("pass_rate")).alias("empirical_pass_rate"), F.col("n_trials").alias("n_reference_trials"),
    )
    return tasks.select(F.col("instruction").alias("prompt"), F.col("task_id").alias("label"), meta.alias("metadata"))


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def append_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def portable(pool: DataFrame, folder: str = "tasks") -> DataFrame:
    """Pool rows whose task folders are relative."""
    return pool.withColumn("metadata", F.col("metadata").withField("task_dir", F.concat(F.lit(folder + "/"), F.col("metadata.task_id"))))


def exclusions(leaked: DataFrame, path: str) -> bool:
    """A table of exclusions, written only if there are any."""
    if leaked.isEmpty():
        return False
    leaked.write.mode("overwrite").json(path)
    return True


def publish(spark: SparkSession, parts: dict[str, DataFrame], target: str) -> None:
    """Several tables that appear together: all are written aside, the old folder is renamed away, the new one put in its
    place, and only then the old one deleted. If that fails the old one is put back."""
    fs, place = _fs(spark, target)
    mark = uuid.uuid4().hex[:8]
    aside, old = (spark._jvm.org.apache.hadoop.fs.Path(f"{target}.{kind}-{mark}") for kind in ("staging", "old"))
    for name, df in parts.items():
        df.write.parquet(f"{target}.staging-{mark}/{name}")
    had = fs.exists(place)
    if had and not fs.rename(place, old):
        raise OSError(f"could not set {target} aside")
    if not fs.rename(aside, place):
        if had:
            fs.rename(old, place)
        raise OSError(f"could not publish {target}")
    fs.delete(old, True)


def write_provenance(spark: SparkSession, folder: str, **settings: object) -> str:
    """What a scoring run is made with, written before it begins; its signature."""
    told = {"signature": cache_signature(**settings), **settings}
    write_text(spark, f"{folder}/provenance.json", json.dumps(told, sort_keys=True, default=str))
    return told["signature"]


def finish_provenance(scores: DataFrame, folder: str, signature: str) -> dict:
    """The manifest of a scoring run, written when its table is whole: number of rows under the signature it began with."""
    spark = scores.sparkSession
    scores.write.mode("overwrite").parquet(f"{folder}/scores")
    doc = {"signature": signature, "rows": spark.read.parquet(f"{folder}/scores").count()}
    write_text(spark, f"{folder}/manifest.json", json.dumps(doc))
    return doc


def cache_signature(**settings: object) -> str:
    return hashlib.sha256(json.dumps(settings, sort_keys=True, default=str).encode()).hexdigest()[:32]


def cached(spark: SparkSession, folder: str, signature: str, build) -> DataFrame:
    """A table kept under its signature, built if it isn't there whole."""
    path = f"{folder.rstrip('/')}/{signature}"
    fs, done = _fs(spark, f"{path}/_SUCCESS")
    if not fs.exists(done):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stage_done(spark: SparkSession, path: str) -> bool:
    """Whether a stage's output is there whole, so that a resumed run may skip it."""
    fs, done = _fs(spark, f"{path}/_SUCCESS")
    return fs.exists(done)


def render_report(title: str, sections: dict[str, DataFrame], limit: int = 200) -> str:
    """Markdown with a table for each section. Sections are small results; more than limit rows is an error."""
    from quernix.functions.text import escape_cell

    out = [f"# {title}", ""]
    for name, df in sections.items():
        rows = df.select(*[escape_cell(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in df.columns]).limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"section {name} has more than {limit} rows")
        out += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *("| " + " | ".join(r) + " |" for r in rows), ""]
    return "\n".join(out)
