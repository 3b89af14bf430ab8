"""Filling of containers of fixed capacity with items, by exact complements of sums and best fit of what is left.

The planning works on counts by length alone: lengths are whole numbers up to the capacity, so the table of counts and
the plan made from it are bounded by the capacity, however many items there are. A plan is a list of patterns (lengths
that go together) with how many containers take each. Items then find their container by their rank among the items of
their length, without coming together anywhere.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernix.runtime import stage


@dataclass(frozen=True)
class Pattern:
    lengths: tuple[int, ...]
    containers: int


class _Stock:
    """Counts of items by length, and which lengths are left."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.n = [0] * (capacity + 1)
        for length, count in counts.items():
            self.n[length] += count
        self.left = sorted(x for x, c in enumerate(self.n) if c and x)

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for x in lengths:
            self.n[x] -= times
            if not self.n[x]:
                self.left.pop(bisect_left(self.left, x))

    def times(self, lengths: tuple[int, ...]) -> int:
        return min(self.n[x] // lengths.count(x) for x in set(lengths))


class _PairSums:
    """For each sum, lengths a <= b in stock with a + b equal to it. A pair that is used up never comes back, so the
    place from which a sum goes on looking for a only falls; that place is all that is kept."""

    def __init__(self, stock: _Stock, capacity: int) -> None:
        self.stock = stock
        self.has = np.zeros(capacity + 1, dtype=bool)
        self.has[stock.left] = True
        self.upto = np.arange(capacity + 1) // 2

    def find(self, total: int, held: tuple[int, ...]) -> tuple[int, int] | None:
        n, has, top = self.stock.n, self.has, int(self.upto[total])
        while top:
            # a from top down: both a and total - a are in stock
            both = has[top:0:-1] & has[total - top : total]
            k = int(both.argmax())
            if not both[k]:
                top = 0
                break
            top -= k
            if self.stock.times((top, total - top)):
                break
            if not n[top]:
                has[top] = False
            elif not n[total - top]:
                has[total - top] = False
            else:
                top -= 1  # two of one length, of which one is left
        self.upto[total] = top
        for k in np.flatnonzero(has[top:0:-1] & has[total - top : total]).tolist():
            if self.stock.times((*held, top - k, total - top + k)):
                return top - k, total - top + k
        return None

    def thirds(self, gap: int) -> list[int]:
        """Lengths below gap, longest first, beside which a pair may still fill it."""
        if gap < 3:
            return []
        return (gap - 1 - np.flatnonzero(self.has[gap - 1 : 0 : -1] & (self.upto[1:gap] > 0))).tolist()


def plan_containers(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that hold every item of counts (length to number; lengths from 1 to capacity), none over capacity.

    From the longest length down, the gap beside an item is filled exactly by one item, else by two, else by three, as
    far as they last; what has no exact complement goes by best fit, longest first, into the fullest container it fits.
    """
    stock, done = _Stock(counts, capacity), []
    if stock.n[capacity]:
        done.append(Pattern((capacity,), stock.n[capacity]))
        stock.take((capacity,), stock.n[capacity])
    sums = _PairSums(stock, capacity)
    residual: dict[int, int] = {}
    while stock.left:
        x = stock.left[-1]
        gap = capacity - x
        filled = (x, gap) if stock.times((x, gap)) else None
        if filled is None and (two := sums.find(gap, (x,))):
            filled = (x, *two)
        if filled is None:
            for c in sums.thirds(gap):
                if stock.times((x, c)) and (two := sums.find(gap - c, (x, c))):
                    filled = (x, c, *two)
                    break
        if filled is None:
            residual[x] = stock.n[x]
            stock.take((x,), stock.n[x])
            continue
        times = stock.times(filled)
        done.append(Pattern(filled, times))
        stock.take(filled, times)
    return done + _best_fit(residual, capacity)


def _best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit, longest first, on whole groups of equal containers."""
    open_groups: list[tuple[int, tuple[int, ...], int]] = []  # room, lengths, containers; sorted by room
    for x in sorted(counts, reverse=True):
        n = counts[x]
        while n:
            k = bisect_left(open_groups, (x,))
            if k < len(open_groups):
                room, held, m = open_groups.pop(k)
                used = min(m, n)
                if m > used:
                    insort(open_groups, (room, held, m - used))
                insort(open_groups, (room - x, (*held, x), used))
            else:
                each = capacity // x
                whole, rest = divmod(n, each)
                used = n
                if whole:
                    insort(open_groups, (capacity - each * x, (x,) * each, whole))
                if rest:
                    insort(open_groups, (capacity - rest * x, (x,) * rest, 1))
            n -= used
    return [Pattern(held, m) for _, held, m in open_groups]


def plan_rows(plan: list[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """(length, first_rank, last_rank, first_container, containers): items of a length with ranks in a range go one by
    one to the containers of a pattern, round and round if the pattern has the length several times."""
    at, base, rows = {}, 0, []
    for p in plan:
        for x in sorted(set(p.lengths)):
            n = p.lengths.count(x) * p.containers
            first = at.get(x, 0)
            rows.append((x, first, first + n - 1, base, p.containers))
            at[x] = first + n
        base += p.containers
    return rows


#: Items of a length that are ranked together in a task, and plan rows up to which the plan is sent to all executors.
RANKED_TOGETHER, BROADCAST_PLAN = 50_000, 500_000


def pack(df: DataFrame, id_col: str, size_col: str, capacity: int, together: int = RANKED_TOGETHER) -> DataFrame:
    """(id, piece, size, container_id) for every item of df, its pieces numbered from 0.

    Only an item larger than capacity is divided: full pieces, each alone in a container, and one rest that is packed
    like an item. Container ids are 0, 1, 2, ... without gaps; no container holds more than capacity. Items of a length
    are ranked in parts of about `together`; their number follows from the counts.
    Defined cases: a null or not positive size takes no room and gets piece 0, size 0 and a null container; repeated
    rows are separate items; items of equal size are ranked by id within parts of their hash, so the result is the same
    on every run as long as ids are unique; an empty table gives an empty one; other columns are left out.
    """
    spark = df.sparkSession
    size = F.greatest(F.coalesce(F.col(size_col).cast("bigint"), F.lit(0)), F.lit(0))
    items = df.select(F.col(id_col).alias("id"), size.alias("total"))
    pieces = F.expr(f"""CASE WHEN total <= {capacity} THEN array(struct(0L AS piece, total AS size))
        ELSE transform(sequence(0L, CAST((total - 1) div {capacity} AS BIGINT)), k -> struct(k AS piece, least({capacity}L, total - k * {capacity}L) AS size)) END""")
    pieces = stage(items.select("id", F.inline(pieces)), "pieces")
    held = pieces.where("size > 0")
    # as many rows as there are lengths, capacity at most
    counts = {r["size"]: r["n"] for r in held.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    lengths = spark.createDataFrame([(x, 1 + n // together) for x, n in counts.items()] or [(0, 1)], "size bigint, salts bigint")
    salted = held.join(F.broadcast(lengths), "size").withColumn("salt", F.pmod(F.xxhash64("id", "piece"), F.col("salts"))).drop("salts")
    parts = salted.groupBy("size", "salt").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.select("size", "salt", (F.sum("n").over(Window.partitionBy("size").orderBy("salt")) - F.col("n")).alias("offset"))
    rows = plan_rows(plan_containers(counts, capacity))
    plan = spark.createDataFrame(rows or [(0, 0, -1, 0, 1)], "size bigint, first_rank bigint, last_rank bigint, first_container bigint, containers bigint")
    # rows stay where the window has put them
    ranked = salted.withColumn("k", F.row_number().over(Window.partitionBy("size", "salt").orderBy("id", "piece")) - 1)
    ranked = ranked.join(parts, ["size", "salt"]).withColumn("rank", F.col("k") + F.col("offset"))
    # a length has few plan rows; they are found by equality of size and a range of ranks
    placed = ranked.join(F.broadcast(plan) if len(rows) <= BROADCAST_PLAN else plan, "size").where("rank between first_rank and last_rank")
    placed = placed.select("id", "piece", "size", (F.col("first_container") + (F.col("rank") - F.col("first_rank")) % F.col("containers")).alias("container_id"))
    none = pieces.where("size = 0").select("id", "piece", "size", F.lit(None).cast("bigint").alias("container_id"))
    return placed.unionByName(none).withColumnRenamed("id", id_col)
