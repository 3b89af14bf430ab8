"""Caps on the records of a contributor, by mergeable histograms of quality."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernix.operators.selection import ranked_by_ranges
from quernix.operators.skew import salted_join
from quernix.runtime import free_shuffles, stage

BIN, QUALITY, TIE, CUT, ROOM, RANK = ("__qx_bin", "__qx_quality", "__qx_tie", "__qx_cut", "__qx_room", "__qx_rank")


def quality_bin(quality: Column, bins: int) -> Column:
    """Bin of a quality of any range, higher for better; -1 where nothing was measured (null or NaN)."""
    q = F.floor((F.atan(quality) / F.lit(math.pi) + 0.5) * bins).cast("int")
    return F.when(quality.isNull() | F.isnan(quality), F.lit(-1)).otherwise(q)


def cutoffs(df: DataFrame, keys: list[str], cap: int) -> DataFrame:
    """Per contributor above its cap: the bin in which the cap is met and how many of that bin still fit.
    Counts per bin merge across partitions before the shuffle; a contributor has at most bins + 1 of them.
    """
    counts = df.groupBy(*keys, BIN).agg(F.count(F.lit(1)).alias("__qx_n"))
    upto = F.sum("__qx_n").over(Window.partitionBy(*keys).orderBy(F.desc(BIN)).rowsBetween(Window.unboundedPreceding, 0))
    met = counts.withColumn("__qx_upto", upto).withColumn("__qx_above", F.col("__qx_upto") - F.col("__qx_n"))
    return met.where((F.col("__qx_above") < cap) & (F.col("__qx_upto") > cap) | (F.col("__qx_above") == cap)).groupBy(*keys).agg(
        F.max(F.struct(F.col(BIN).alias("b"), (F.lit(cap) - F.col("__qx_above")).alias("r"))).alias("__qx_c")
    ).select(*keys, F.col("__qx_c.b").alias(CUT), F.col("__qx_c.r").alias(ROOM))


#: Caps up to which the rows of a border bin are cut by a window, and cutoffs up to which these are sent to all executors.
WINDOW_CAP, BROADCAST_CUTS = 10_000, 100_000


def cap_contributors(
    df: DataFrame, keys: list[str], cap: int | None, quality: str, tie: str, *, share: float | None = None, bins: int = 1024, salts: int = 8
) -> DataFrame:
    """The rows of df that stay when each contributor (value of keys) is held to cap rows, or to a share of all rows.

    Better quality stays first, unmeasured (null, NaN) last, equal quality in ascending order of tie, which should be
    unique within a contributor. Rows above the contributor's cutoff bin stay, rows below go, and only those in the
    borderline bin are ranked. Up to WINDOW_CAP that keeps at most cap rows of a contributor per partition before the
    shuffle; beyond, the border rows are put in order by ranges and counted per range, so a contributor with a third of
    all rows, all of one quality, never comes together in a task.
    Defined cases: rows with a null key belong to no contributor and stay; repeated rows count as often as they occur,
    and where they tie entirely any of them stays; an empty table gives an empty one; cap 0 keeps no row with a key.
    """
    if cap is None:
        cap = math.floor((share or 0.0) * df.count())
    if cap < 0:
        raise ValueError("cap must not be negative")
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    if cap == 0:
        return df.where(~whole)
    q = F.col(quality).cast("double")
    work = df.withColumn(QUALITY, F.when(F.isnan(q), None).otherwise(q)).withColumn(BIN, quality_bin(q, bins))
    cuts = stage(cutoffs(work.where(whole), keys, cap), "cutoffs")
    if cuts.count() <= BROADCAST_CUTS:
        told = work.join(F.broadcast(cuts), keys, "left")
    else:
        # joined once and staged, as each of the two uses below would move all rows again
        free_shuffles(df.sparkSession)
        told = salted_join(work, cuts, keys, F.col(tie), "left", salts)
        told = stage(told.where(F.col(CUT).isNull() | (F.col(BIN) >= F.col(CUT))), "told")
        free_shuffles(df.sparkSession)
    stays = told.where(F.col(CUT).isNull() | (F.col(BIN) > F.col(CUT)))
    border = told.where(F.col(BIN) == F.col(CUT))
    order = [F.col(QUALITY).desc_nulls_last(), F.col(tie)]
    if cap <= WINDOW_CAP:
        # the first condition is a literal, which Spark applies within each partition before the shuffle
        border = border.withColumn(RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where((F.col(RANK) <= cap) & (F.col(RANK) <= F.col(ROOM)))
    else:
        border = ranked_by_ranges(border, keys, order, RANK).where(F.col(RANK) <= F.col(ROOM))
    return stays.select(*df.columns).unionByName(border.select(*df.columns))
