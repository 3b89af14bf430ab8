"""De-duplication in the order of ids by two keys at once."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernix.operators.components import connected_components
from quernix.runtime import ship, stage


def greedy_two_key(df: DataFrame, id_col: str, content: str, behaviour: list[str], max_rounds: int = 200) -> DataFrame:
    """The rows that a scan in order of id keeps if it drops a row whose content, or else whose behaviour (columns
    together), one of the rows kept before has.

    Done in rounds instead of a scan: a row that is the least one left both of its content and of its behaviour is kept
    whatever comes, and every row that shares either with it goes. Keys are only aggregated, so a key with any number
    of rows, like the empty behaviour, needs no task of its own. Rounds are as many as the longest chain of rows that
    wait for each other; what is left after max_rounds is scanned in order of id, each connected part of it, given as
    ids and hashes, in a task of its own. The result is that of the scan.
    Defined cases: ids have to be unique; a null key equals other nulls.
    """
    beh = F.struct(*[F.col(c) for c in behaviour])
    left = df.select(F.col(id_col).alias("id"), F.sha2(F.coalesce(F.col(content).cast("string"), F.lit("\0")), 256).alias("c"), F.sha2(F.to_json(beh), 256).alias("b"))
    # of equal content and behaviour only the first can be kept
    left = stage(left.groupBy("c", "b").agg(F.min("id").alias("id")), "left")
    kept = None
    for _ in range(max_rounds):
        by_c = left.groupBy("c").agg(F.min("id").alias("mc"))
        by_b = left.groupBy("b").agg(F.min("id").alias("mb"))
        told = left.join(by_c, "c").join(by_b, "b")
        now = stage(told.where("id = mc and id = mb").select("id", "c", "b"), "kept")
        kept = now if kept is None else kept.unionByName(now)
        left = stage(left.join(now.select("c"), "c", "left_anti").join(now.select("b"), "b", "left_anti").select("c", "b", "id"), "left")
        if left.isEmpty():
            break
    else:
        kept = kept.unionByName(_scan_components(left))
    return df.join(kept.select(F.col("id").alias(id_col)), id_col, "left_semi")


def _scan_components(left: DataFrame) -> DataFrame:
    """(id, c, b) of the rows of left that the scan keeps, one connected part of shared keys at a time."""
    ship(left.sparkSession)
    edges = left.select(F.concat(F.lit("c:"), "c").alias("u"), F.concat(F.lit("b:"), "b").alias("v"))
    parts = connected_components(edges, "u", "v").withColumnRenamed("node", "u")

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        seen_c, seen_b, keep = set(), set(), []
        pdf = pdf.sort_values("id")
        for c, b in zip(pdf["c"], pdf["b"], strict=True):
            fresh = c not in seen_c and b not in seen_b
            keep.append(fresh)
            if fresh:
                seen_c.add(c)
                seen_b.add(b)
        return pdf.loc[keep, ["id", "c", "b"]]

    kind = left.schema["id"].dataType.simpleString()
    rows = left.withColumn("u", F.concat(F.lit("c:"), "c")).join(parts, "u")
    return rows.select("component", "id", "c", "b").groupBy("component").applyInPandas(scan, f"id {kind}, c string, b string")


def first_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first in an order; the others are dropped per partition before the shuffle."""
    from pyspark.sql import Window

    return df.withColumn("__qx_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__qx_rn = 1").drop("__qx_rn")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
