"""Deterministic selection per group: rotation over sources, balanced sides, pairs, strides, holdouts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernix.runtime import stage


def order_key(seed: int | str, column: Column) -> Column:
    """Order of rows that doesn't depend on files: SHA-256 of seed and id."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), column), 256)


def rotate_sources(df: DataFrame, group: str, source: str, id_col: str, cap: int, seed: int = 1228) -> DataFrame:
    """At most cap rows a group, taken in turn from its sources. Within a source by order_key, sources by name.

    Equals the rank by (place within the source, name), so two windows do it. Both conditions are literals that Spark
    applies per partition before the shuffle: a source never gives more than cap rows, nor does a group, so a hot group
    never comes together in a task. Rows with a null group are dropped; a null source is a source of its own, first.
    """
    key = order_key(seed, F.col(id_col))
    place = F.row_number().over(Window.partitionBy(group, source).orderBy(key, id_col))
    first = df.where(F.col(group).isNotNull()).withColumn("__qx_place", place).where(F.col("__qx_place") <= cap)
    turn = F.row_number().over(Window.partitionBy(group).orderBy("__qx_place", F.col(source).asc_nulls_first(), key))
    return first.withColumn("__qx_turn", turn).where(F.col("__qx_turn") <= cap).drop("__qx_place", "__qx_turn")


def balanced_sides(df: DataFrame, group: str, source: str, id_col: str, win: Column, per_side: int, seed: int = 1228, across: bool = True) -> DataFrame:
    """Rows of both outcomes, as many of each per (group, source) as the rarer one has, per_side at most. across: what is
    missing to per_side in a group is added from the rest of the group, whatever the source. Adds the column win.
    """
    key = order_key(seed, F.col(id_col))
    work = df.withColumn("win", win).where(F.col(group).isNotNull() & F.col(source).isNotNull() & F.col("win").isNotNull())
    rank = F.row_number().over(Window.partitionBy(group, source, "win").orderBy(key, id_col))
    # no row beyond per_side of a source and outcome can be taken from its source, nor beyond 2 x per_side be added
    near = work.withColumn("__qx_k", rank).where(F.col("__qx_k") <= 2 * per_side)
    near = stage(near, "sides")
    sizes = near.groupBy(group, source).agg(F.sum(F.col("win").cast("int")).alias("__qx_w"), F.sum((~F.col("win")).cast("int")).alias("__qx_l"))
    told = near.join(sizes, [group, source])
    budget = F.least(F.lit(per_side), "__qx_w", "__qx_l")
    taken = told.where(F.col("__qx_k") <= budget)
    if not across:
        return taken.select(*df.columns, "win")
    held = taken.groupBy(group).agg(F.sum(F.col("win").cast("int")).alias("__qx_s"), F.sum((~F.col("win")).cast("int")).alias("__qx_f"))
    rest = told.where(F.col("__qx_k") > budget).join(held, group, "left")
    room = F.greatest(F.lit(0), per_side - F.least(F.coalesce("__qx_s", F.lit(0)), F.coalesce("__qx_f", F.lit(0))))
    more = rest.withColumn("__qx_r", F.row_number().over(Window.partitionBy(group, "win").orderBy(key, id_col))).where((F.col("__qx_r") <= per_side) & (F.col("__qx_r") <= room))
    return taken.select(*df.columns, "win").unionByName(more.select(*df.columns, "win"))


def form_pairs(df: DataFrame, key: str, source: str, id_col: str, win: str, cap: int, across: bool = True) -> DataFrame:
    """(key, chosen, rejected, same_source) pairs of a won and a lost row of one key, cap at most a key: first the i-th
    won with the i-th lost of a source, by id, sources by name; then, across sources, those left, by id.
    """
    # ranks beyond cap never meet a partner that counts
    rank = F.row_number().over(Window.partitionBy(key, source, win).orderBy(id_col))
    rows = df.select(key, source, id_col, win).where(F.col(key).isNotNull() & F.col(source).isNotNull())
    ranked = rows.withColumn("i", rank).where(F.col("i") <= 2 * cap)
    ranked = stage(ranked, "ranked")
    won = ranked.where(F.col(win)).select(key, source, "i", F.col(id_col).alias("chosen"))
    lost = ranked.where(~F.col(win)).select(key, source, "i", F.col(id_col).alias("rejected"))
    nth = F.row_number().over(Window.partitionBy(key).orderBy(source, "i"))
    same = won.join(lost, [key, source, "i"]).withColumn("nth", nth).where(F.col("nth") <= cap)
    same = stage(same.select(key, "chosen", "rejected", F.lit(True).alias("same_source"), "nth"), "same-source")
    out = same.select(key, "chosen", "rejected", "same_source")
    if not across:
        return out
    used = same.select(key, F.explode(F.array("chosen", "rejected")).alias(id_col))
    have = same.groupBy(key).agg(F.count(F.lit(1)).alias("have"))
    left = ranked.join(used, [key, id_col], "left_anti").join(have, key, "left").where(F.coalesce("have", F.lit(0)) < cap)
    j = F.row_number().over(Window.partitionBy(key, win).orderBy(id_col))
    left = left.withColumn("j", j).where(F.col("j") <= cap).withColumn("room", cap - F.coalesce("have", F.lit(0)))
    w = left.where(F.col(win)).select(key, "j", "room", F.col(id_col).alias("chosen"), F.col(source).alias("s"))
    lo = left.where(~F.col(win)).select(key, "j", F.col(id_col).alias("rejected"), F.col(source).alias("t"))
    cross = w.join(lo, [key, "j"]).where(F.col("j") <= F.col("room")).select(key, "chosen", "rejected", (F.col("s") == F.col("t")).alias("same_source"))
    return out.unionByName(cross)


def pair_id(chosen: Column, rejected: Column) -> Column:
    return F.sha2(F.concat_ws("|", chosen, rejected), 256)


def numbered(df: DataFrame, order: list[Column | str], name: str = "row_no") -> DataFrame:
    """df with the 0-based place of each row in a total order, counted per range of the order, not in one task."""
    ordered = df.orderBy(*order).withColumn("__qx_part", F.spark_partition_id()).withColumn("__qx_at", F.monotonically_increasing_id())
    ordered = stage(ordered, "ordered")
    sizes = ordered.groupBy("__qx_part").agg(F.count(F.lit(1)).alias("n"), F.min("__qx_at").alias("__qx_first"))
    # one row per partition
    starts = sizes.select("__qx_part", "__qx_first", (F.sum("n").over(Window.orderBy("__qx_part")) - F.col("n")).alias("__qx_start"))
    return ordered.join(F.broadcast(starts), "__qx_part").withColumn(name, F.col("__qx_start") + F.col("__qx_at") - F.col("__qx_first")).drop("__qx_part", "__qx_at", "__qx_first", "__qx_start")


def ranked_by_ranges(df: DataFrame, keys: list[str], order: list[Column | str], name: str) -> DataFrame:
    """df with the 1-based rank of each row among those of its keys: rows are sorted by ranges, and a row's rank is its
    place in its range after all rows of its keys in the ranges before. Rows of one key fill as many ranges as they need.
    """
    part, at, first, n, start = "__qx_part", "__qx_at", "__qx_first", "__qx_n", "__qx_start"
    rows = df.orderBy(*keys, *order).withColumn(part, F.spark_partition_id()).withColumn(at, F.monotonically_increasing_id())
    rows = stage(rows, "border")
    runs = rows.groupBy(*keys, part).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(n))
    # one row for each key and range in which it occurs
    before = F.sum(n).over(Window.partitionBy(*keys).orderBy(part)) - F.col(n)
    runs = runs.withColumn(start, before).drop(n)
    return rows.join(runs, [*keys, part]).withColumn(name, F.col(start) + F.col(at) - F.col(first) + 1).drop(part, at, first, start)


def order_statistics(df: DataFrame, keys: list[str], value: str, places: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """(keys, n, a column for each of places) of the values that aren't null: places gives from n the 0-based place in
    ascending order whose value is wanted, null for none. Values are ranked by ranges, so a key may have any number.
    """
    some = df.where(F.col(value).isNotNull()).select(*keys, value)
    sizes = some.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    ranked = ranked_by_ranges(some, keys, [value], "__qx_rank").join(sizes, keys)
    at = F.col("__qx_rank") - 1
    return ranked.groupBy(*keys, "n").agg(*[F.max(F.when(at == place(F.col("n")), F.col(value))).alias(name) for name, place in places.items()])


def strided(df: DataFrame, order: list[Column | str], k: int) -> DataFrame:
    """Every (n // k)-th row of the order, k at most."""
    rows = numbered(df, order)
    step = max(1, rows.count() // k)
    return rows.where((F.col("row_no") % step == 0) & (F.col("row_no") < k * step)).drop("row_no")


def shard_of(df: DataFrame, order: list[Column | str], shard: int, shards: int) -> DataFrame:
    return numbered(df, order).where(F.pmod("row_no", F.lit(shards)) == shard).drop("row_no")


def usable_prefix(df: DataFrame, order: list[Column | str], multiple: int) -> DataFrame:
    """The first rows of the order, as many as make a whole multiple."""
    rows = numbered(df, order)
    return rows.where(F.col("row_no") < rows.count() // multiple * multiple).drop("row_no")


def holdout_until(df: DataFrame, group: str, holdout: int | None, fraction: float, seed: int = 1228) -> DataFrame:
    """df with split: whole groups, by order_key, go to the holdout until it has its target of rows, the least of
    holdout and fraction of all. Group sizes alone are ordered; there is one row for each group.
    """
    sizes = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    target = int(total * fraction) if holdout is None else min(holdout, int(total * fraction))
    # a running sum by ranges: a group's rows before it are those of the ranges before and those in its own
    ordered = sizes.withColumn("k", order_key(seed, F.col(group).cast("string"))).orderBy("k").withColumn("__qx_part", F.spark_partition_id())
    ordered = stage(ordered, "holdout-order")
    parts = ordered.groupBy("__qx_part").agg(F.sum("n").alias("m"))
    # one row per partition
    starts = parts.select("__qx_part", (F.sum("m").over(Window.orderBy("__qx_part")) - F.col("m")).alias("__qx_start"))
    inside = F.sum("n").over(Window.partitionBy("__qx_part").orderBy("k")) - F.col("n")
    near = ordered.join(F.broadcast(starts.where(F.col("__qx_start") < target)), "__qx_part")
    chosen = near.withColumn("before", F.col("__qx_start") + inside).where(F.col("before") < target).select(group, F.lit("holdout").alias("split"))
    return df.join(chosen, group, "left").withColumn("split", F.coalesce("split", F.lit("train")))


def holdout_groups(df: DataFrame, group: str, groups: int, fraction: float, seed: int = 1228) -> DataFrame:
    """df with split: the first groups by order_key, at most a fraction of all groups, are the holdout."""
    names = df.select(group).where(F.col(group).isNotNull()).distinct()
    n = min(groups, int(names.count() * fraction))
    if n == 0:
        raise ValueError("too few groups to hold any out")
    held = names.orderBy(order_key(seed, F.col(group).cast("string"))).limit(n).withColumn("split", F.lit("holdout"))
    return df.join(held, group, "left").withColumn("split", F.coalesce("split", F.lit("train")))


def shared_groups(df: DataFrame, group: str, split: str = "split") -> DataFrame:
    """Groups on both sides of a split; none in a sound one."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.min(split).alias("a"), F.max(split).alias("b")).where("a <> b").select(group)


def long_enough_else_longest(df: DataFrame, length: str, least: int, k: int, tie: str) -> DataFrame:
    """k rows of at least the length, in order of tie; if there are none, the k longest."""
    enough = df.where(F.col(length) >= least).orderBy(tie).limit(k)
    return enough if not enough.isEmpty() else df.orderBy(F.desc(length), tie).limit(k)
