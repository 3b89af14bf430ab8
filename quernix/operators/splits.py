"""Train, validation and test splits that keep related records together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernix.operators.components import connected_components
from quernix.operators.skew import salted_join
from quernix.runtime import stage

NODE, ENTS, COMP = "__qx_node", "__qx_ents", "component"


def entity_nodes(df: DataFrame, entities: dict[str, Column]) -> Column:
    """The record's entities as node names, kind and value, null ones left out."""
    named = [F.when(c.isNotNull(), F.concat(F.lit(f"{kind}:"), c.cast("string"))) for kind, c in entities.items()]
    return F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")


def tie_entities(df: DataFrame, entities: dict[str, Column]) -> DataFrame:
    """(node, component) over all entities that some record has together. A record's entities are chained to its first
    one, and equal edges are merged before the shuffle, so the graph has entities as nodes, not records.
    """
    ents = df.select(entity_nodes(df, entities).alias(ENTS))
    edges = ents.where(F.size(ENTS) > 1).select(F.col(ENTS)[0].alias("a"), F.explode(F.slice(ENTS, 2, len(entities))).alias("b")).distinct()
    return connected_components(edges, "a", "b")


def unit_hash(c: Column) -> Column:
    """Place of a string in [0, 1), from the first 52 bits of its SHA-256."""
    return F.conv(F.substring(F.sha2(c, 256), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def assign_splits(
    df: DataFrame,
    entities: dict[str, Column],
    record_id: str,
    proportions: dict[str, float],
    seed: str = "0",
    heavy: float = 0.01,
    salts: int = 8,
    pinned: DataFrame | None = None,
) -> DataFrame:
    """df with component and split, all records tied by any shared entity in the same split.

    Components holding more than `heavy` of all rows (fewer than 1/heavy of them, hence a bounded list) go, largest
    first, to the split that lacks most rows; the others fall by the hash of their component into ranges whose widths
    are what each split still lacks. So shares stay near the proportions even with one very large component.
    These widths follow the data, so a later run over more rows may place a component elsewhere: hand it the placements
    of the run before as pinned (component, split). A pinned component keeps its split and counts as that split's rows;
    a component that has grown together of several keeps that of its least name.
    Defined cases: a null entity ties nothing; a record without entities is its own component, by record_id (records
    with a null id too are placed together); repeated rows go together; columns of df named component or split are
    replaced; an empty table gives an empty one.
    """
    total_p = sum(proportions.values())
    base = df.drop(COMP, "split")
    ties = tie_entities(base, entities)
    rows = base.withColumn(ENTS, entity_nodes(base, entities)).withColumn(
        NODE, F.when(F.size(ENTS) > 0, F.col(ENTS)[0]).otherwise(F.concat(F.lit("record:"), F.coalesce(F.col(record_id).cast("string"), F.lit("")))) 
    )
    renamed = ties.select(F.col("node").alias(NODE), F.col("component").alias(COMP))
    rows = salted_join(rows, renamed, [NODE], F.col(record_id), "left", salts)
    rows = rows.withColumn(COMP, F.coalesce(COMP, NODE)).drop(NODE, ENTS)
    sizes = stage(rows.groupBy(COMP).agg(F.count(F.lit(1)).alias("n")), "component-sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    lacks = {s: p / total_p * total for s, p in proportions.items()}
    if pinned is not None:
        pins = pinned.where(F.col("split").isin(list(proportions))).groupBy(COMP).agg(F.min("split").alias("__qx_pin"))
        for r in sizes.join(pins, COMP).groupBy("__qx_pin").agg(F.sum("n").alias("n")).collect():
            lacks[r["__qx_pin"]] -= r["n"]
        sizes = sizes.join(pins, COMP, "left_anti")
    big = sizes.where(F.col("n") > heavy * total).orderBy(F.desc("n"), COMP).collect()
    placed = {}
    for r in big:
        s = max(lacks, key=lambda k: (lacks[k], k))
        placed[r[COMP]] = s
        lacks[s] -= r["n"]
    rest = {s: max(0.0, x) for s, x in lacks.items()}
    width = sum(rest.values()) or 1.0
    at, pick = 0.0, None
    names = list(proportions)
    h = unit_hash(F.concat(F.lit(f"{seed}:"), F.col(COMP)))
    for s in names[:-1]:
        at += rest[s] / width
        pick = F.when(h < at, F.lit(s)) if pick is None else pick.when(h < at, F.lit(s))
    pick = F.lit(names[-1]) if pick is None else pick.otherwise(F.lit(names[-1]))
    for c, s in placed.items():
        pick = F.when(F.col(COMP) == c, F.lit(s)).otherwise(pick)
    if pinned is None:
        return rows.withColumn("split", pick)
    return salted_join(rows, pins, [COMP], F.col(record_id), "left", salts).withColumn("split", F.coalesce("__qx_pin", pick)).drop("__qx_pin")


def placements(assigned: DataFrame) -> DataFrame:
    """(component, split) of a result of assign_splits, to be kept and handed to the next run."""
    return assigned.select(COMP, "split").distinct()
