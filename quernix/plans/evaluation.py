"""Findings from data: checks as rows, their counts, and the worst of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernix.functions import arrays as A
from quernix.functions.numeric import ratio

LEVELS = ("FAIL", "WARN", "OK", "INFO")


def finding(df: DataFrame, area: str, check: str, level: Column, detail: Column) -> DataFrame:
    """A row (level, area, check, detail) for each row of df whose level isn't null."""
    return df.select(level.alias("level"), F.lit(area).alias("area"), F.lit(check).alias("check"), detail.cast("string").alias("detail")).where("level is not null")


def severity(level: Column) -> Column:
    return F.array_position(F.array(*[F.lit(x) for x in LEVELS]), level)


def ordered(findings: DataFrame) -> DataFrame:
    return findings.orderBy(severity(F.col("level")), "area", "check", "detail")


def level_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("level").agg(F.count(F.lit(1)).alias("n"))


def worst(findings: DataFrame) -> DataFrame:
    return findings.agg(F.coalesce(F.min_by("level", severity(F.col("level"))), F.lit("OK")).alias("worst"))


def token_table_findings(tokens: DataFrame, max_len: int, lo: float = 0.25, hi: float = 0.45) -> DataFrame:
    """Findings on a table of input_ids and loss_mask, from one pass over it."""
    i, m = F.col("input_ids"), F.col("loss_mask")
    one = tokens.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.size(i) != F.size(m)).alias("misaligned"),
        F.count_if(A.total(m) == 0).alias("untrained"),
        F.count_if(F.get(m, F.lit(0)) == 1).alias("leading"),
        F.count_if(F.size(i) > max_len).alias("too_long"),
        ratio(A.total(m), F.size(i)).alias("fraction"),
    )
    out = finding(one, "data", "rows", F.when(F.col("rows") == 0, "FAIL").otherwise("INFO"), F.col("rows"))
    for name in ("misaligned", "untrained", "leading", "too_long"):
        out = out.unionByName(finding(one, "data", name, F.when(F.col(name) > 0, "FAIL").otherwise("OK"), F.col(name)))
    return out.unionByName(finding(one, "data", "trained_fraction", F.when(F.col("fraction").between(lo, hi), "OK").otherwise("WARN"), F.round("fraction", 4)))


def pair_table_problems(pairs: DataFrame) -> DataFrame:
    """One row of what would make a pair table unfit: repeated ids, equal sides, empty sides."""
    return pairs.agg(
        (F.count(F.lit(1)) - F.countDistinct("pair_id")).alias("repeated_ids"),
        F.count_if(F.col("chosen_input_ids") == F.col("rejected_input_ids")).alias("identical_sides"),
        F.count_if((F.size("chosen_input_ids") == 0) | (F.size("rejected_input_ids") == 0)).alias("empty_sides"),
        F.count_if(F.size("chosen_input_ids") != F.size("chosen_loss_mask")).alias("misaligned"),
    )


def identity_drift(before: Column, now: Column) -> Column:
    """Entries of a map of settings that changed, with both values."""
    keys = F.array_union(F.map_keys(before), F.map_keys(now))
    both = F.transform(keys, lambda k: F.struct(k.alias("key"), F.try_element_at(before, k).alias("before"), F.try_element_at(now, k).alias("now")))
    return F.filter(both, lambda x: ~x["before"].eqNullSafe(x["now"]))


def moved_tensors(before: DataFrame, after: DataFrame) -> DataFrame:
    """(key, state) of tensors (key, values): moved, same, missing or of another length."""
    b, a = before.select("key", F.col("values").alias("b")), after.select("key", F.col("values").alias("a"))
    state = (
        F.when(F.col("a").isNull(), "missing")
        .when(F.size("a") != F.size("b"), "length")
        .when(A.relative_l2(F.col("a"), F.col("b")) > 0, "moved")
        .otherwise("same")
    )
    return b.join(a, "key", "left").select("key", state.alias("state"))
