"""Identities that are tangled: groups of rows linked by shared names, found as connected components.

A source should have one path, one URI and one digest, each its own. Where a path has two URIs, a URI two
paths, or two paths one digest, the rows hang together, through other rows too; one group is one mistake to
mend. Rows whose names are all their own are told off by counting, so the rounds see the tangled ones alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posefold.operators.gates import Refused
from posefold.operators.scale import cut_lineage, lookup_join

NAMES = ("path", "source_uri", "sha256")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``edges`` (``a``, ``b``): the smallest node it is linked to.

    Each round gives every node the smallest label around it, then the label of that label, so labels cross
    a chain in strides that double. A round is two lookups, spread if a node or a label is hot, and one
    partial-aggregated minimum; the driver sees one count.
    """
    edges = cut_lineage(edges.where("a <> b").select("a", "b").distinct(), "edges")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        near = lookup_join(both, labels.select(F.col("node").alias("b"), "label"), ["b"], how="inner")
        hooked = (
            near.select(F.col("a").alias("node"), "label").unionByName(labels).groupBy("node").agg(F.min("label").alias("label"))
        )
        hooked = cut_lineage(hooked, "labels")
        roots = hooked.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = lookup_join(hooked, roots, ["label"], how="inner").select("node", "label", "root")
        jumped = cut_lineage(jumped, "labels")
        before = labels.select("node", F.col("label").alias("was"))
        moved = jumped.join(before, "node").where("root <> was").limit(1).count()
        labels = jumped.select("node", F.col("root").alias("label"))
        if not moved:
            return labels.withColumnRenamed("label", "component")


def _entity(name: str) -> Column:
    return F.concat(F.lit(f"{name}="), F.col(name).cast("string"))


def tangled_groups(sources: DataFrame, names: tuple[str, ...] = NAMES) -> DataFrame:
    """``*names, identity_group`` of every distinct row that shares a name with another row: its group is named
    by the smallest shared name in it. Nulls link nothing; rows with names of their own are left out."""
    rows = cut_lineage(sources.select(*names).distinct(), "identities")
    shared = None
    for name in names:
        often = rows.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        found = often.select(_entity(name).alias("entity"))
        shared = found if shared is None else shared.unionByName(found)
    shared = cut_lineage(shared, "shared")
    entities = F.array_compact(F.array(*(_entity(name) for name in names)))
    links = lookup_join(rows.select(*names, F.explode(entities).alias("entity")), shared, ["entity"], how="inner")
    # A row is named by all its names, told apart from shared names by its sign.
    row_name = F.concat(F.lit("~"), F.to_json(F.struct(*names)))
    links = cut_lineage(links.select(*names, "entity", row_name.alias("row_name")), "links")
    linked = components(links.select(F.col("entity").alias("a"), F.col("row_name").alias("b")))
    grouped = links.select(*names, "row_name").distinct()
    found = lookup_join(grouped, linked.withColumnRenamed("node", "row_name"), ["row_name"], how="inner")
    return found.select(*names, F.col("component").alias("identity_group"))


def group_facts(groups: DataFrame, names: tuple[str, ...] = NAMES) -> DataFrame:
    """Per group: rows, and how many paths, URIs and digests hang together."""
    return groups.groupBy("identity_group").agg(
        F.count(F.lit(1)).alias("rows"), *(F.count_distinct(name).alias(f"{name}s") for name in names)
    )


def describe_first(groups: DataFrame, names: tuple[str, ...] = NAMES, most: int = 50) -> str:
    """The first group in words: its size, and its rows, up to ``most`` of them by name."""
    first = groups.agg(F.min("identity_group")).first()[0]
    own = groups.where(F.col("identity_group") == first)
    listed = own.orderBy(*names).limit(most).collect()
    text = ", ".join("/".join(str(r[name]) for name in names) for r in listed)
    return f"{own.count()} rows hang together ({first}): {text}"


def require_untangled(sources: DataFrame, names: tuple[str, ...] = ("path", "source_uri")) -> None:
    """Refuse sources of which any shares a name with another, naming the whole group of the first."""
    groups = cut_lineage(tangled_groups(sources, names), "groups")
    if not groups.isEmpty():
        total = groups.select("identity_group").distinct().count()
        raise Refused(f"source_identities_are_untangled: {describe_first(groups, names)}; {total} groups in all")


def linked_cells(cells: DataFrame, axes: list[str], low: list[str], high: list[str], size: float, gap: float) -> DataFrame:
    """``cell, component`` of grid cells: neighbours whose extents are at most ``gap`` apart on every axis are linked.

    ``cells`` has one row per cell: ``cell`` (a name), its integer ``axes`` and the extent of its members. Each
    cell looks up its neighbours by key, half of them, so no pair is met twice and none is made in vain.
    """
    if not 0 <= gap < size:
        raise ValueError("the gap must be below the size of a cell")
    reach = [(dx, dy, dz) for dx in (-1, 0, 1) for dy in (-1, 0, 1) for dz in (-1, 0, 1) if (dx, dy, dz) > (0, 0, 0)]
    steps = F.array(*(F.struct(*(F.lit(d).alias(f"d{i}") for i, d in enumerate(step))) for step in reach))
    asks = cells.withColumn("step", F.explode(steps)).select(
        "cell", *low, *high, *((F.col(axis) + F.col(f"step.d{i}")).alias(axis) for i, axis in enumerate(axes))
    )
    others = cells.select(*axes, F.col("cell").alias("other"), *(F.col(n).alias(f"o_{n}") for n in (*low, *high)))
    apart = [F.greatest(F.col(f"o_{a}") - F.col(b), F.col(a) - F.col(f"o_{b}")) for a, b in zip(low, high)]
    near = reduce(Column.__and__, (distance <= gap for distance in apart))
    edges = lookup_join(asks, others, list(axes), how="inner").where(near)
    linked = components(edges.select(F.col("cell").alias("a"), F.col("other").alias("b")))
    return cells.select("cell").join(linked.withColumnRenamed("node", "cell"), "cell", "left").select(
        "cell", F.coalesce("component", "cell").alias("component")
    )
