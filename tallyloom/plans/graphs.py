"""Patterns over the care graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.operators import graph
from tallyloom.plans.inputs import GRAPH_SQL, care_edges, care_nodes
from tallyloom.plans.registry import query
from tallyloom.session import scratch_path
from tallyloom.sources.files import read_table


def _graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return care_nodes(spark, folder), care_edges(spark, folder)


def _hop_sql(condition: str) -> str:
    return f"""{GRAPH_SQL}
      select a.name as src_name, e.type, b.name as dst_name
      from edges e join nodes a on a.id = e.src join nodes b on b.id = e.dst where {condition}"""


_NAMES = ["src_name", "type", "dst_name"]


@query(_hop_sql("a.label = 'IDN'"))
def facilities_of_networks(spark: SparkSession, folder: str) -> DataFrame:
    return graph.match_hop(*_graph(spark, folder), src_label="IDN").select(*_NAMES)


@query(_hop_sql("e.type = 'OPERATES' and b.label = 'Clinic'"))
def operators_of_clinics(spark: SparkSession, folder: str) -> DataFrame:
    return graph.match_hop(*_graph(spark, folder), types=["OPERATES"], dst_label="Clinic").select(*_NAMES)


@query(_hop_sql("e.type in ('PURCHASES_FROM', 'CONTRACTS_WITH') and b.label = 'IDN'"))
def purchases_and_contracts(spark: SparkSession, folder: str) -> DataFrame:
    types = ["PURCHASES_FROM", "CONTRACTS_WITH"]
    return graph.match_hop(*_graph(spark, folder), types=types, dst_label="IDN").select(*_NAMES)


@query(_hop_sql("e.type = 'REFERS_TO'"))
def referrals(spark: SparkSession, folder: str) -> DataFrame:
    return graph.match_any(*_graph(spark, folder), "REFERS_TO").select(*_NAMES)


@query(f"""{GRAPH_SQL}
select a.name as src_name, c.name as dst_name
from edges e1 join edges e2 on e2.src = e1.dst
join nodes a on a.id = e1.src join nodes b on b.id = e1.dst join nodes c on c.id = e2.dst
where e1.type = 'MEMBER_OF' and e2.type = 'PRIVILEGES_AT'
  and a.label = 'PhysicianGroup' and b.label = 'Hospital' and c.label = 'IDN'
""")
def groups_with_privileges(spark: SparkSession, folder: str) -> DataFrame:
    labels = ["PhysicianGroup", "Hospital", "IDN"]
    paths = graph.match_path(*_graph(spark, folder), labels, ["MEMBER_OF", "PRIVILEGES_AT"])
    return paths.select("src_name", "dst_name")


PATHS_SQL = """
  select src as start, dst as stop, 1 as hops from edges
  union all
  select e1.src, e2.dst, 2 from edges e1 join edges e2 on e2.src = e1.dst where e1.edge_id <> e2.edge_id
"""


@query(f"""{GRAPH_SQL}
select a.name as src_name, p.hops, b.name as dst_name, b.label as dst_label
from ({PATHS_SQL}) p join nodes a on a.id = p.start join nodes b on b.id = p.stop where a.label = 'IDN'
""")
def care_network_paths(spark: SparkSession, folder: str) -> DataFrame:
    paths = graph.match_var_length(*_graph(spark, folder), "IDN", 2)
    return paths.select("src_name", "hops", "dst_name", F.col("dst_labels")[0].alias("dst_label"))


@query(f"""{GRAPH_SQL}
select distinct b.label from ({PATHS_SQL}) p join nodes a on a.id = p.start join nodes b on b.id = p.stop
where a.label = 'IDN'
""")
def services_in_network(spark: SparkSession, folder: str) -> DataFrame:
    return graph.distinct_services(*_graph(spark, folder), "IDN", 2).select(F.col("labels")[0].alias("label"))


@query(f"""{GRAPH_SQL}
select h.name as hub_name, count(distinct e.src) as members, pairs
from edges e join nodes h on h.id = e.dst
join (select a.dst, count(*)::decimal(38, 0) as pairs from edges a join edges b on a.dst = b.dst and a.src < b.src
      where a.type = 'PURCHASES_FROM' and b.type = 'PURCHASES_FROM' group by 1) p on p.dst = e.dst
where e.type = 'PURCHASES_FROM' group by e.dst, h.name, pairs having count(distinct e.src) > 1
""")
def overlapping_memberships(spark: SparkSession, folder: str) -> DataFrame:
    return graph.overlapping_membership(*_graph(spark, folder)).select("hub_name", "members", "pairs")


@query(f"""{GRAPH_SQL}
select a.name as org1_name, b.name as org2_name, h.name as hub_name, count(*) as paths
from edges e1 join edges e2 on e1.dst = e2.dst and e2.src = e1.src + 4
join nodes a on a.id = e1.src join nodes b on b.id = e2.src join nodes h on h.id = e1.dst
where e1.type = 'PURCHASES_FROM' and e2.type = 'PURCHASES_FROM' group by 1, 2, 3
""")
def hubs_shared_by_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Which suppliers with consecutive keys purchase from the same hub."""
    nodes, edges = _graph(spark, folder)
    groups = graph.nodes_of(nodes, "PhysicianGroup").select(F.col("id").alias("org1"), (F.col("id") + 4).alias("org2"))
    return graph.shared_hubs(nodes, edges, groups)


@query(f"""{GRAPH_SQL}
select a.name as org_name, h.name as hub_name, count(*) over (partition by e.dst) - 1 as others
from edges e join nodes a on a.id = e.src join nodes h on h.id = e.dst where e.type = 'PURCHASES_FROM'
""")
def co_members_of_hubs(spark: SparkSession, folder: str) -> DataFrame:
    return graph.co_members(*_graph(spark, folder)).select("org_name", "hub_name", "others")


@query(f"""{GRAPH_SQL}
select type, count(*) as edges, count(distinct edge_id) as ids
from (select type, edge_id from edges
      union all select 'OWNS', -1 - n_nationkey - s_suppkey * 100 from supplier join nation on s_nationkey = n_nationkey)
group by 1
""")
def edges_with_ownership(spark: SparkSession, folder: str) -> DataFrame:
    """OWNS edges between suppliers and hospitals found by name, added to the graph."""
    nodes, edges = _graph(spark, folder)
    names = read_table(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    wanted = read_table(spark, folder, "supplier").join(names, "s_nationkey").select(
        F.col("s_name").alias("src_value"), F.col("n_name").alias("dst_value")
    )
    owns = graph.connect_matching(nodes, wanted, "OWNS", "PhysicianGroup", "Hospital")
    path = scratch_path(spark, "edges")
    graph.add_edges(edges, owns).write.parquet(path)
    stored = spark.read.schema(graph.EDGES_SCHEMA).parquet(path)
    return stored.groupBy("type").agg(F.count(F.lit(1)).alias("edges"), F.count_distinct("edge_id").alias("ids"))
