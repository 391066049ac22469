"""Patterns on the small care network with known answers, and against brute force."""

from __future__ import annotations

import itertools
import random

import pytest

from tallyloom.operators import graph

NODES = [
    (1, "IDN", "Regional Healthcare Network"), (2, "Hospital", "Central Medical Center"),
    (3, "PhysicianGroup", "Metropolitan Physicians Alliance"), (4, "Clinic", "Community Health Clinic"),
    (5, "SurgeryCenter", "Advanced Surgery Center"), (6, "ImagingCenter", "Precision Imaging"),
    (7, "GPO", "Healthcare Supply Alliance"), (8, "Doctor", "Dr. Sarah Johnson"),
]
EDGES = [
    (1, 2, "OPERATES"), (1, 3, "PARTNERS_WITH"), (1, 4, "MANAGES"), (1, 5, "AFFILIATES_WITH"), (1, 7, "CONTRACTS_WITH"),
    (2, 8, "EMPLOYS"), (2, 6, "REFERS_TO"), (2, 7, "PURCHASES_FROM"),
    (3, 2, "PRIVILEGES_AT"), (3, 4, "OPERATES"), (8, 3, "MEMBER_OF"),
    (5, 7, "CONTRACTS_WITH"), (5, 6, "REFERS_TO"),
]


def build(spark, nodes, edges):
    return (
        spark.createDataFrame([(i, [label], {"name": name}) for i, label, name in nodes], graph.NODES_SCHEMA),
        spark.createDataFrame([(k, a, b, t) for k, (a, b, t) in enumerate(edges)], graph.EDGES_SCHEMA),
    )


@pytest.fixture(scope="module")
def network(spark):
    return build(spark, NODES, EDGES)


def pairs(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def test_hops(network):
    assert graph.match_hop(*network, src_label="IDN").count() == 5
    assert pairs(graph.match_hop(*network, types=["PURCHASES_FROM", "CONTRACTS_WITH"], dst_label="GPO"), "src_name") == [
        ("Advanced Surgery Center",), ("Central Medical Center",), ("Regional Healthcare Network",),
    ]
    assert pairs(graph.match_any(*network, "REFERS_TO"), "src_name", "dst_name") == [
        ("Advanced Surgery Center", "Precision Imaging"), ("Central Medical Center", "Precision Imaging"),
    ]
    assert pairs(graph.match_hop(*network, types=["OPERATES"], dst_label="Clinic"), "src_name") == [
        ("Metropolitan Physicians Alliance",)
    ]


def test_paths(network):
    path = graph.match_path(*network, ["Doctor", "PhysicianGroup", "Hospital"], ["MEMBER_OF", "PRIVILEGES_AT"])
    assert pairs(path, "src_name", "dst_name") == [("Dr. Sarah Johnson", "Central Medical Center")]
    hops = [row["hops"] for row in graph.match_var_length(*network, "IDN", 2).collect()]
    assert (hops.count(1), hops.count(2)) == (5, 7)
    services = {row["labels"][0] for row in graph.distinct_services(*network, "IDN", 2).collect()}
    assert services == {"Hospital", "PhysicianGroup", "Clinic", "SurgeryCenter", "GPO", "Doctor", "ImagingCenter"}


def test_no_shared_purchasing_in_the_network(network):
    assert graph.overlapping_membership(*network, hub_label="GPO").isEmpty()


def test_owns_edge(spark, network):
    wanted = spark.createDataFrame([("Central Medical Center", "Precision Imaging")], "src_value string, dst_value string")
    owns = graph.connect_matching(network[0], wanted, "OWNS", "Hospital", "ImagingCenter")
    edges = graph.add_edges(network[1], owns)
    assert edges.count() == 14 and edges.select("edge_id").distinct().count() == 14
    assert pairs(edges.where("type = 'OWNS'"), "src", "dst") == [(2, 6)]
    assert graph.connect_matching(network[0], wanted, "OWNS", "Clinic", "ImagingCenter").isEmpty()


def test_against_brute_force(spark):
    rng = random.Random(3)
    nodes = [(i, rng.choice("ABC"), f"n{i}") for i in range(12)]
    edges = [(rng.randrange(12), rng.choice([0, rng.randrange(12)]), rng.choice("xy")) for _ in range(60)]
    frames = build(spark, nodes, edges)
    label = {i: l for i, l, _ in nodes}
    numbered = list(enumerate(edges))
    starts = [(k, e) for k, e in numbered if label[e[0]] == "A"]
    expected = [(e[0], 1, e[1]) for _, e in starts]
    for (k1, e1), (k2, e2) in itertools.product(starts, numbered):
        if e1[1] == e2[0] and k1 != k2:
            expected.append((e1[0], 2, e2[1]))
            for k3, e3 in numbered:
                if e2[1] == e3[0] and k3 not in (k1, k2):
                    expected.append((e1[0], 3, e3[1]))
    assert pairs(graph.match_var_length(*frames, "A", 3), "src", "hops", "dst") == sorted(expected)
    reached = {label[dst] for _, _, dst in expected}
    assert {r["labels"][0] for r in graph.distinct_services(*frames, "A", 3).collect()} == reached

    linked = [e for e in edges if e[2] == "x"]
    met = [(a[0], b[0], a[1]) for a in linked for b in linked if a[1] == b[1] and a[0] < b[0]]
    hubs = {r["hub"]: int(r["pairs"]) for r in graph.overlapping_membership(*frames, "x").collect()}
    assert hubs == {hub: sum(1 for m in met if m[2] == hub) for hub in {m[2] for m in met}}
    wanted = spark.createDataFrame(list(itertools.combinations(range(12), 2)), "org1 bigint, org2 bigint")
    shared = {(r["org1_name"], r["org2_name"], r["hub_name"]): r["paths"] for r in graph.shared_hubs(*frames, wanted, "x").collect()}
    assert shared == {
        (f"n{a}", f"n{b}", f"n{h}"): met.count((a, b, h)) for a, b, h in set(met)
    }
    others = {(r["org"], r["hub"]): r["others"] for r in graph.co_members(*frames, "x").collect()}
    assert others == {
        (a, h): len({s for s, d, _ in linked if d == h}) - 1 for a, h, _ in linked
    }
