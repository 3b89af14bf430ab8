"""Session, table access, staging in the cluster's shared folder, and shipping of this package to executors."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path
from urllib.parse import urlparse

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_own_folder: dict[str, str] = {}
_staged: list[str] = []


def build_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quernix")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only in local mode with that setting unset."""
    told = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if told:
        return told.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="quernix-")
        _staged.append(_own_folder[app])
    return "file://" + _own_folder[app]


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed at the end of the application."""
    if not _staged:
        # registered after the JVM's own end, hence run before it
        atexit.unregister(_drop_staged)
        atexit.register(_drop_staged)
    path = f"{shared_folder(spark)}/quernix-{label}-{uuid.uuid4().hex[:12]}"
    _staged.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Writes df as a table into the shared folder and reads it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Lets go of the shuffle files of what is staged; else they stay until the driver happens to collect its garbage."""
    spark.sparkContext._jvm.System.gc()


def _drop_staged() -> None:
    """Deletes what is staged, at the end of the application; on a shared store as long as the JVM can be reached."""
    jvm = SparkContext._jvm
    for path in _staged:
        parts = urlparse(path)
        if parts.scheme in ("", "file"):
            shutil.rmtree(parts.path, ignore_errors=True)
            if os.path.isfile(parts.path):
                os.remove(parts.path)
        elif jvm is not None:
            try:
                place = jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(place, True)
            except Exception:  # noqa: BLE001 - the end of an application must not fail for its leftovers
                break


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def release(spark: SparkSession) -> None:
    """Deletes all staged tables, on any file system; what was read from them must not be used any more."""
    while _staged:
        fs, p = _hadoop_path(spark, _staged.pop())
        fs.delete(p, True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands this package to the executors once per application, by the shared folder, so that functions sent there
    find it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
        for p in sorted(root.rglob("*.py")):
            out.write(p, p.relative_to(root.parent))
    target = scratch(spark, "package") + ".zip"
    _staged.append(target)
    fs, place = _hadoop_path(spark, target)
    stream = fs.create(place, True)
    try:
        stream.write(bytearray(packed.getvalue()))
    finally:
        stream.close()
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)
