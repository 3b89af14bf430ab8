"""Readers: tables, archives, documents, logs, checkpoints. Lists of paths stay in the plan wherever Spark can list."""

from __future__ import annotations

import hashlib
import io
import json
import re
import tarfile
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernix.functions import text as X
from quernix.runtime import ship


def _utf8(c: str) -> Column:
    """Bytes as text, those that are no UTF-8 replaced."""
    return F.make_valid_utf8(F.col(c).cast("string"))


def parquet_parts(spark: SparkSession, paths: list[str], schema: T.StructType | None = None) -> DataFrame:
    """Several files as one table with file, the name each row came from."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*paths).withColumn("file", F.col("_metadata.file_name"))


def split_table(spark: SparkSession, path: str, split: str) -> DataFrame | None:
    """One split of a table partitioned by split; of a table without splits everything is train, and holdout None."""
    df = spark.read.parquet(path)
    if "split" in df.columns:
        return df.where(F.col("split") == split)
    return df if split == "train" else None


def tagged_union(parts: dict[str, DataFrame]) -> DataFrame:
    """Tables one after the other, each row tagged with its table's name as split."""
    out = None
    for name, df in parts.items():
        tagged = df.withColumn("split", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def _opened(path: str, at_place: bool = False):
    """A file of any file system that pyarrow knows, for reading at places or from front to end, in a task."""
    where, inner = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if ":" in path else f"file://{path}")
    return where.open_input_file(inner) if at_place else where.open_input_stream(inner)


def _paths(spark: SparkSession, path: str | list[str], glob: str | None = None, deep: bool = False) -> DataFrame:
    """(path, size_bytes) of files, one row each in its own task as far as there are cores; contents aren't read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", deep)
    found = (reader.option("pathGlobFilter", glob) if glob else reader).load(path).select("path", F.col("length").alias("size_bytes"))
    return found.repartition(max(1, min(found.count(), 4 * spark.sparkContext.defaultParallelism)), "path")


_TAR_SCHEMA = "shard string, member string, content binary"


def _members(tar: tarfile.TarFile, path: str, suffix: str) -> Iterator[pd.DataFrame]:
    for m in tar:
        if m.isfile() and m.name.endswith(suffix):
            yield pd.DataFrame([(path.rsplit("/", 1)[-1], m.name, tar.extractfile(m).read())], columns=["shard", "member", "content"])


def expand_tars(archives: DataFrame, suffix: str = "") -> DataFrame:
    """(shard, member, content) of the files in archives (path, content) that are at hand as rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                with tarfile.open(fileobj=io.BytesIO(content)) as tar:
                    yield from _members(tar, path, suffix)

    return archives.select("path", "content").mapInPandas(run, _TAR_SCHEMA)


def tar_members(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """(shard, member, content) of the files in the archives of a folder. Archives of any size: they are read from front
    to end in a task, of which it holds one member at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p in pdf["path"]:
                with _opened(p) as stream, tarfile.open(fileobj=stream, mode="r|*") as tar:
                    yield from _members(tar, p, suffix)

    ship(spark)
    return _paths(spark, path, "*.tar").select("path").mapInPandas(run, _TAR_SCHEMA)


def wanted_members(members: DataFrame, wanted: DataFrame, name: str = "trajectory.json") -> DataFrame:
    """Members that are `name` under a wanted (shard, member_prefix), with the other columns of wanted. Equality of the
    whole name, so the join is a hash join however many are wanted."""
    keyed = wanted.withColumn("member", F.concat(F.regexp_replace("member_prefix", "/+$", ""), F.lit(f"/{name}")))
    return members.join(keyed, ["shard", "member"])


def under_prefix(members: DataFrame, wanted: DataFrame) -> DataFrame:
    """Members below a wanted (shard, member_prefix), with rel, the path below it. The prefix is found among the member's
    ancestors by equality instead of by comparing every member with every prefix; the longest one holds.
    Raises for names that would lead out of the prefix."""
    parts = F.split("member", "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    keyed = wanted.withColumn("ancestor", F.regexp_replace("member_prefix", "/+$", ""))
    hit = members.withColumn("ancestor", F.explode(ancestors)).join(keyed, ["shard", "ancestor"])
    rel = F.expr("substring(member, length(ancestor) + 2)")
    unsafe = rel.startswith("/") | F.array_contains(F.split(rel, "/"), "..")
    hit = hit.withColumn("rel", F.when(unsafe, F.raise_error(F.concat(F.lit("unsafe member path: "), "member"))).otherwise(rel))
    best = hit.groupBy("shard", "member").agg(F.max(F.length("ancestor")).alias("__qx_n"))
    return hit.join(best, ["shard", "member"]).where(F.length("ancestor") == F.col("__qx_n")).drop("ancestor", "__qx_n")


def trajectory_steps(members: DataFrame, schema: T.DataType) -> DataFrame:
    """Members with record, their JSON document read by schema; null where it is none."""
    return members.withColumn("record", F.from_json(_utf8("content"), schema, {"mode": "PERMISSIVE", "allowUnquotedControlChars": "true"}))


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, document) with the text of each file as a variant, null for what isn't JSON or can't be read."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("document"))


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of JSON lines; blank lines are none."""
    return spark.read.schema(schema).json(path)


def log_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, line_no, text) of text files, undecodable bytes replaced, lines ended by \\n, \\r or both. A file is read
    line by line in one task, so that its lines can be numbered; it may be of any size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p in pdf["path"]:
                with _opened(p) as stream, io.TextIOWrapper(stream, encoding="utf-8", errors="replace", newline=None) as lines:
                    at = 0
                    while part := [x.removesuffix("\n") for x in islice(lines, 20_000)]:
                        yield pd.DataFrame({"file": p, "line_no": range(at, at + len(part)), "text": part})
                        at += len(part)

    ship(spark)
    return _paths(spark, paths).select("path").mapInPandas(run, "file string, line_no int, text string")


def newest_logs(spark: SparkSession, folder: str, k: int = 4) -> list[str]:
    """Paths of the k newest logs below a folder, oldest of them first. Only names and times are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.log").load(folder)
    top = files.select("path", "modificationTime").orderBy(F.desc("modificationTime"), F.desc("path")).limit(k)
    return [r["path"] for r in sorted(top.collect(), key=lambda r: (r["modificationTime"], r["path"]))]


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those paths that exist, in their order."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(conf).exists(hp):
            out.append(p)
    return out


def result_documents(spark: SparkSession, job: str) -> DataFrame:
    """(path, payload) of the result documents of a job in its three layouts, in order of path: in the job's folder, one
    below, or one below trials."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "result.json").load(job)
    rel = F.regexp_extract("path", rf"{job.rstrip('/').replace('file://', '')}/(.*)$", 1)
    layout = rel.rlike(r"^(?:trials/[^/]+/|[^/]+/)?result\.json$")
    return files.where(layout).select("path", _utf8("content").alias("payload")).distinct().orderBy("path")


def task_folders(spark: SparkSession, root: str) -> DataFrame:
    """Folders with an instruction, directly below root or, if there are none, below its tasks folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "instruction.md").load(root)
    rel = F.regexp_extract("path", rf"{root.rstrip('/').replace('file://', '')}/(.*)/instruction\.md$", 1)
    found = files.select(rel.alias("rel"), F.regexp_replace("path", "/instruction.md$", "").alias("folder"))
    direct = found.where(~F.col("rel").contains("/") & (F.col("rel") != ""))
    nested = found.where(F.col("rel").rlike("^tasks/[^/]+$"))
    return (direct if not direct.isEmpty() else nested).select("folder").orderBy("folder")


def safetensors_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(key, shard, dtype, shape, nbytes) of weight files: 8 bytes of length, then a JSON header. Nothing else is read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for p in pdf["path"]:
                with _opened(p, at_place=True) as f:
                    header = json.loads(f.read_at(int.from_bytes(f.read_at(8, 0), "little"), 8))
                for key, e in header.items():
                    if key != "__metadata__":
                        rows.append((key, p.rsplit("/", 1)[-1], e["dtype"], list(e["shape"]), e["data_offsets"][1] - e["data_offsets"][0]))
            yield pd.DataFrame(rows, columns=["key", "shard", "dtype", "shape", "nbytes"])

    ship(spark)
    return _paths(spark, path, "*.safetensors").select("path").mapInPandas(run, "key string, shard string, dtype string, shape array<bigint>, nbytes bigint")


def file_fingerprints(spark: SparkSession, path: str, head: int = 1 << 20, whole: bool = True) -> DataFrame:
    """(name, size_bytes, head_sha256, sha256) of files. Without whole only their heads are read and sha256 is null; with
    it they are read piece by piece."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for p, size in zip(pdf["path"], pdf["size_bytes"], strict=True):
                with _opened(p) as f:
                    first = f.read(head)
                    digest = hashlib.sha256(first)
                    while whole and (piece := f.read(1 << 22)):
                        digest.update(piece)
                rows.append((p.rsplit("/", 1)[-1], size, hashlib.sha256(first).hexdigest(), digest.hexdigest() if whole else None))
            yield pd.DataFrame(rows, columns=["name", "size_bytes", "head_sha256", "sha256"])

    ship(spark)
    return _paths(spark, path).mapInPandas(run, "name string, size_bytes bigint, head_sha256 string, sha256 string")


def fingerprint(files: DataFrame, config: str) -> str:
    """One digest of a configuration and of name, size and head of every file. One row per file comes to the driver."""
    rows = files.select("name", "size_bytes", "head_sha256").orderBy("name").collect()
    return hashlib.sha256(json.dumps([config, [list(r) for r in rows]], sort_keys=True).encode()).hexdigest()


def verify_manifest(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """(shard, problem) of files that are missing or differ from a manifest (shard, size_bytes, sha256)."""
    got = files.select(F.col("name").alias("shard"), F.col("size_bytes").alias("got_size"), F.col("sha256").alias("got_sha"))
    told = manifest.join(got, "shard", "left")
    problem = F.when(F.col("got_size").isNull(), "missing").when(F.col("got_size") != F.col("size_bytes"), "size").when(F.col("got_sha") != F.col("sha256"), "sha256")
    return told.select("shard", problem.alias("problem")).where("problem is not null")


REGISTRY_DEFAULTS = {"tp": 1, "pp": 1, "cp": 1, "dtype": "bf16"}


def registry_rows(registry: DataFrame, key: str, memory_class: str, defaults: dict = REGISTRY_DEFAULTS) -> DataFrame:
    """The row of a model for a memory class, else its row for any class, with defaults for what it leaves open."""
    rows = registry.where((F.col("key") == key) & (F.col("memory_class").isNull() | (F.col("memory_class") == memory_class)))
    best = rows.orderBy(F.col("memory_class").isNull()).limit(1)
    return best.select(*[F.coalesce(c, F.lit(defaults[c])).alias(c) if c in defaults else F.col(c) for c in registry.columns])


def log_curve_source(spark: SparkSession, paths: list[str]) -> DataFrame:
    return log_lines(spark, paths).select("file", "line_no", "text", *[c.alias(k) for k, c in X.log_fields(F.col("text")).items()])
