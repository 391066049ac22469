"""Pattern queries over a property graph in two tables.

``nodes(id, labels, props)`` and ``edges(edge_id, src, dst, type)``. Patterns
are equi-joins on node ids after the label and type filters; which side is
broadcast and which skewed key is split is left to the optimizer, which knows
the sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.session import materialize

NODES_SCHEMA = "id bigint, labels array<string>, props map<string,string>"
EDGES_SCHEMA = "edge_id bigint, src bigint, dst bigint, type string"


def nodes_of(nodes: DataFrame, label: str | None = None) -> DataFrame:
    """Nodes with a label, or all of them."""
    return nodes if label is None else nodes.where(F.array_contains("labels", label))


def edges_of(edges: DataFrame, types: Sequence[str] = ()) -> DataFrame:
    """Edges of one of the types, or all of them."""
    return edges.where(F.col("type").isin(*types)) if types else edges


def _named(nodes: DataFrame, side: str, label: str | None, *more: Column) -> DataFrame:
    return nodes_of(nodes, label).select(
        F.col("id").alias(side), F.col("props")["name"].alias(f"{side}_name"), *more
    )


def match_hop(
    nodes: DataFrame,
    edges: DataFrame,
    src_label: str | None = None,
    types: Sequence[str] = (),
    dst_label: str | None = None,
) -> DataFrame:
    """``src, src_name, type, dst, dst_name`` of every matching edge."""
    return (
        edges_of(edges, types)
        .select("src", "type", "dst")
        .join(_named(nodes, "src", src_label), "src")
        .join(_named(nodes, "dst", dst_label), "dst")
        .select("src", "src_name", "type", "dst", "dst_name")
    )


def match_any(nodes: DataFrame, edges: DataFrame, edge_type: str) -> DataFrame:
    """Edges of one type between nodes of any label."""
    return match_hop(nodes, edges, types=[edge_type])


def match_path(
    nodes: DataFrame, edges: DataFrame, labels: Sequence[str | None], types: Sequence[str]
) -> DataFrame:
    """Paths through fixed edge types, ``labels[i] -types[i]-> labels[i+1]``.

    Returns ``src, src_name, dst, dst_name``, one row per path. Labels filter
    the ends and the middle nodes before the next hop is joined. The name of the start is carried along, so few
    and hot starts are not joined back to their paths.
    """
    if len(labels) != len(types) + 1:
        raise ValueError("a path needs one label more than edge types")
    paths = _named(nodes, "src", labels[0]).withColumn("_at", F.col("src"))
    used: list[str] = []
    for hop, edge_type in enumerate(types):
        edge = f"_e{hop}"
        step = edges_of(edges, [edge_type]).select(
            F.col("src").alias("_at"), F.col("dst").alias("_to"), F.col("edge_id").alias(edge)
        )
        paths = paths.join(step, "_at")
        for earlier in used:
            paths = paths.where(F.col(earlier) != F.col(edge))
        paths = paths.drop("_at").withColumnRenamed("_to", "_at")
        used.append(edge)
        if labels[hop + 1] is not None and hop + 1 < len(types):
            allowed = nodes_of(nodes, labels[hop + 1]).select(F.col("id").alias("_at"))
            paths = paths.join(allowed, "_at", "left_semi")
    ends = paths.select("src", "src_name", F.col("_at").alias("dst"))
    return ends.join(_named(nodes, "dst", labels[-1]), "dst").select("src", "src_name", "dst", "dst_name")


def match_var_length(
    nodes: DataFrame, edges: DataFrame, src_label: str | None = None, max_hops: int = 2
) -> DataFrame:
    """``src, src_name, hops, dst, dst_name, dst_labels``, one row per path of 1..max_hops.

    An edge is used at most once in a path. The number of hops is fixed by the
    caller, so the plan has ``max_hops`` joins and no loop over data.
    """
    if max_hops < 1:
        raise ValueError("a path has at least one hop")
    steps = edges.select(F.col("src").alias("_at"), F.col("dst").alias("_to"), "edge_id")
    level = _named(nodes, "src", src_label).select(
        "src", "src_name", F.col("src").alias("_at"), F.array().cast("array<bigint>").alias("_used")
    )
    levels = []
    for hop in range(1, max_hops + 1):
        joined = level.join(steps, "_at")
        if hop > 1:
            joined = joined.where(~F.array_contains("_used", F.col("edge_id")))
        level = joined.select("src", "src_name", F.col("_to").alias("_at"), F.array_append("_used", F.col("edge_id")).alias("_used"))
        levels.append(level.select("src", "src_name", F.lit(hop).alias("hops"), F.col("_at").alias("dst")))
    return (
        union_paths(*levels)
        .join(_named(nodes, "dst", None, F.col("labels").alias("dst_labels")), "dst")
        .select("src", "src_name", "hops", "dst", "dst_name", "dst_labels")
    )


def union_paths(*paths: DataFrame) -> DataFrame:
    """Paths of several lengths as one bag."""
    merged = paths[0]
    for more in paths[1:]:
        merged = merged.unionByName(more)
    return merged


def distinct_services(
    nodes: DataFrame, edges: DataFrame, src_label: str | None = None, max_hops: int = 2
) -> DataFrame:
    """Distinct ``labels`` reachable from the labelled nodes in 1..max_hops.

    Walks sets of nodes instead of paths: every level is de-duplicated before
    the next join, so the work follows the nodes and edges and not the number
    of paths. A path may not repeat an edge, which only forbids a second turn
    around a loop and so reaches no other node. Steps and every level are scratch tables, so a hop reads its two
    inputs once, however nodes and edges are made.
    """
    steps = materialize(edges.select(F.col("src").alias("_at"), F.col("dst").alias("_to")), "graph-steps")
    frontier = nodes_of(nodes, src_label).select(F.col("id").alias("_at"))
    reached = []
    for _ in range(max_hops):
        frontier = steps.join(frontier, "_at", "left_semi").select(F.col("_to").alias("_at")).distinct()
        frontier = materialize(frontier, "graph-frontier")
        reached.append(frontier.select(F.col("_at").alias("id")))
    return nodes.join(union_paths(*reached), "id", "left_semi").select("labels").distinct()


def _memberships(nodes: DataFrame, edges: DataFrame, edge_type: str, hub_label: str | None) -> DataFrame:
    links = edges_of(edges, [edge_type]).select("src", "dst")
    if hub_label is not None:
        links = links.join(nodes_of(nodes, hub_label).select(F.col("id").alias("dst")), "dst", "left_semi")
    return links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links"))


def overlapping_membership(
    nodes: DataFrame, edges: DataFrame, edge_type: str = "PURCHASES_FROM", hub_label: str | None = None
) -> DataFrame:
    """Hubs with more than one member: ``hub, hub_name, members, pairs``.

    ``pairs`` counts the edge pairs ``a < b`` that meet in the hub. The pairs
    themselves grow with the square of a hub's members and are not listed; see
    :func:`shared_hubs` for given pairs and :func:`co_members` for given
    members.
    """
    grouped = (
        _memberships(nodes, edges, edge_type, hub_label)
        .groupBy("dst")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.sum("links").cast("decimal(19,0)").alias("_links"),
            F.sum(F.col("links").cast("decimal(19,0)") * F.col("links")).alias("_squares"),
        )
        .where("members > 1")
    )
    # Decimal: the square of a large hub does not fit a bigint.
    pairs = ((F.col("_links") * F.col("_links") - F.col("_squares")) / 2).cast("decimal(38,0)")
    return grouped.join(_named(nodes, "dst", None), "dst").select(
        F.col("dst").alias("hub"), F.col("dst_name").alias("hub_name"), "members", pairs.alias("pairs")
    )


def shared_hubs(
    nodes: DataFrame,
    edges: DataFrame,
    pairs: DataFrame,
    edge_type: str = "PURCHASES_FROM",
    hub_label: str | None = None,
) -> DataFrame:
    """For given pairs ``org1, org2`` of node ids: the hubs both are linked to.

    Returns ``org1_name, org2_name, hub_name, paths`` for the pairs with
    ``org1 < org2``; ``paths`` counts pairs of parallel edges.
    """
    member = _memberships(nodes, edges, edge_type, hub_label)
    first = member.select(F.col("src").alias("org1"), F.col("dst").alias("hub"), F.col("links").alias("_n1"))
    second = member.select(F.col("src").alias("org2"), F.col("dst").alias("hub"), F.col("links").alias("_n2"))
    name = F.col("props")["name"]
    return (
        pairs.where("org1 < org2")
        .join(first, "org1")
        .join(second, ["org2", "hub"])
        .join(nodes.select(F.col("id").alias("org1"), name.alias("org1_name")), "org1")
        .join(nodes.select(F.col("id").alias("org2"), name.alias("org2_name")), "org2")
        .join(nodes.select(F.col("id").alias("hub"), name.alias("hub_name")), "hub")
        .select("org1_name", "org2_name", "hub_name", (F.col("_n1") * F.col("_n2")).alias("paths"))
    )


def co_members(
    nodes: DataFrame, edges: DataFrame, edge_type: str = "PURCHASES_FROM", hub_label: str | None = None
) -> DataFrame:
    """``org, org_name, hub, hub_name, others``: each membership and how many others share it."""
    member = _memberships(nodes, edges, edge_type, hub_label).select("src", "dst")
    hubs = member.groupBy("dst").agg(F.count(F.lit(1)).alias("_members")).join(_named(nodes, "dst", None), "dst")
    return (
        member.join(hubs, "dst")
        .join(_named(nodes, "src", None), "src")
        .select(
            F.col("src").alias("org"),
            F.col("src_name").alias("org_name"),
            F.col("dst").alias("hub"),
            F.col("dst_name").alias("hub_name"),
            (F.col("_members") - 1).alias("others"),
        )
    )


def connect_matching(
    nodes: DataFrame,
    wanted: DataFrame,
    edge_type: str,
    src_label: str | None = None,
    dst_label: str | None = None,
    prop: str = "name",
) -> DataFrame:
    """New edges ``src, dst, type`` for ``wanted(src_value, dst_value)``.

    Every pair of nodes whose property ``prop`` equals the two wanted values is
    linked. Both lookups are equi-joins, so one call serves any number of
    wanted relationships.
    """
    value = F.col("props")[prop]
    sources = nodes_of(nodes, src_label).select(F.col("id").alias("src"), value.alias("src_value"))
    targets = nodes_of(nodes, dst_label).select(F.col("id").alias("dst"), value.alias("dst_value"))
    return (
        wanted.select("src_value", "dst_value")
        .distinct()
        .join(sources, "src_value")
        .join(targets, "dst_value")
        .select("src", "dst", F.lit(edge_type).alias("type"))
    )


def add_edges(edges: DataFrame, new_edges: DataFrame) -> DataFrame:
    """Append edges; those without ``edge_id`` get ids above the present ones.

    New ids start after the highest one and are unique, with gaps between the
    partitions they were made in.
    """
    if "edge_id" not in new_edges.columns:
        highest = edges.agg(F.coalesce(F.max("edge_id"), F.lit(-1))).first()[0]
        new_edges = new_edges.withColumn("edge_id", F.lit(highest + 1) + F.monotonically_increasing_id())
    return edges.unionByName(new_edges.select(*edges.columns))
