"""Named queries. Each takes a session and a data folder, reads whole tables, and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plenum.catalogue.roles import ballots, communities, community_vertices, members, network, parties, table
from plenum.operators import attributes, centrality, community, distribution, graph, metrics, profile, votes
from plenum.plans.chain import StepStore, run_chain
from plenum.plans.report import RANKED, rank_vertices, vertex_report
from plenum.session import materialize, scratch_path
from plenum.sources import manifest, sinks, tables

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
DIGITS = 9
DATABASE = "plenum_check"


def query(function: Query) -> Query:
    """Register under the function's name; doubles are rounded, as in the SQL twin."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(function(spark, sf_dir))

    _queries[function.__name__] = run
    return run


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    doubles = {f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    return df.select(*[F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns])


def all_queries() -> dict[str, Query]:
    return dict(_queries)


# ---- sources and sinks ----------------------------------------------------------------------------------------


@query
def file_names(spark, sf_dir):
    return manifest.manifest_files(table(spark, sf_dir, "pages")).select("page_id", "url", "filename")


@query
def table_names(spark, sf_dir):
    pages = manifest.manifest_files(table(spark, sf_dir, "pages"))
    listed = pages.filter(F.col("url").startswith("https:")).select(
        "filename", F.concat(F.lit("TB_"), F.col("page_id").cast("string")).alias("nome_banco_dados")
    )
    files = pages.select("page_id", "filename")
    return manifest.resolve_table_names(files, listed, suffix=".html", own_output="99")


@query
def varchar_widths(spark, sf_dir):
    return tables.varchar_widths(table(spark, sf_dir, "customer"))


@query
def raw_table(spark, sf_dir):
    """Supplier exported as CSV, then loaded through the manifest rule as an all-text table."""
    folder = scratch_path(spark, "raw")
    supplier = table(spark, sf_dir, "supplier")
    supplier.write.option("header", True).csv(f"{folder}/supplier.xlsx")
    files = spark.createDataFrame([("supplier.xlsx",)], "filename string")
    listed = files.select("filename", F.lit("tb_depu").alias("nome_banco_dados"))
    resolved = manifest.resolve_table_names(files, listed)
    loaded = tables.load_tables(spark, resolved, folder, "csv", DATABASE, f"{folder}/stored", header="true")
    return loaded[0][1]


@query
def raw_table_of_files(spark, sf_dir):
    """Orders exported as two files, by year as in the manifest, that become one table."""
    folder = scratch_path(spark, "raw-years")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    for name, chosen in (("votes-odd.xlsx", F.col("o_orderkey") % 2 == 1), ("votes-even.xlsx", F.col("o_orderkey") % 2 == 0)):
        orders.filter(chosen).write.option("header", True).csv(f"{folder}/{name}")
    files = spark.createDataFrame([("votes-odd.xlsx",), ("votes-even.xlsx",)], "filename string")
    resolved = manifest.resolve_table_names(files, files.select("filename", F.lit("tb_voto").alias("nome_banco_dados")))
    loaded = tables.load_tables(spark, resolved, folder, "csv", DATABASE, f"{folder}/stored", header="true")
    audit = tables.load_audit(loaded).select("rows_loaded", "rows_source", "ok")
    return loaded[0][1].crossJoin(F.broadcast(audit))  # the audit of one table is one row


@query
def manifest_scan(spark, sf_dir):
    """The pages as a manifest file, written and read again."""
    path = scratch_path(spark, "manifest")
    listed = table(spark, sf_dir, "pages").select(
        "url", F.concat(F.lit("TB_"), F.col("page_id").cast("string")).alias("nome_banco_dados"), F.lit(" pages").alias("descricao"))
    listed.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return manifest.manifest_files(manifest.read_manifest(spark, path))


@query
def load_audit(spark, sf_dir):
    tables.create_database(spark, DATABASE)
    place = scratch_path(spark, "audit")
    loaded = []
    for name in ("nation", "region", "supplier", "customer"):
        source = table(spark, sf_dir, name)
        loaded.append((name, tables.load_table(source, f"{DATABASE}.audit_{name}", f"{place}/{name}", True), source))
    return tables.load_audit(loaded)


@query
def load_audit_named(spark, sf_dir):
    """Three tables exported as files, one of them split; the manifest names two, the third takes its file's name."""
    folder = scratch_path(spark, "raw-named")
    for name, source, parts in (("depu", "supplier", 1), ("voto", "orders", 3), ("part", "nation", 1)):
        rows = table(spark, sf_dir, source)
        for part in range(parts):
            some = rows.filter(F.pmod(F.xxhash64(rows.columns[0]), F.lit(parts)) == part)
            some.write.option("header", True).csv(f"{folder}/{name}_{part}.xlsx")
    files = [("depu_0.xlsx",), *[(f"voto_{i}.xlsx",) for i in range(3)], ("part_0.xlsx",), ("voto_REDE.xlsx",)]
    listed = [("depu_0.xlsx", "tb_depu"), *[(f"voto_{i}.xlsx", "tb_voto") for i in range(3)]]
    resolved = manifest.resolve_table_names(
        spark.createDataFrame(files, "filename string"), spark.createDataFrame(listed, "filename string, nome_banco_dados string"))
    loaded = tables.load_tables(spark, resolved, folder, "csv", DATABASE, f"{folder}/stored", header="true")
    return tables.load_audit(loaded, naming=True)


def _saved(spark: SparkSession, df: DataFrame, name: str) -> str:
    tables.create_database(spark, DATABASE)
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("path", path).saveAsTable(f"{DATABASE}.{name}")
    return f"{DATABASE}.{name}"


@query
def edge_scan(spark, sf_dir):
    edges = network(spark, sf_dir).edges.toDF("SOURCE", "TARGET", "WEIGHT")
    return tables.read_edges(spark, _saved(spark, edges, "tb_arestas"))


@query
def vertex_scan(spark, sf_dir):
    vertices = network(spark, sf_dir).vertices.drop("has_attrs").withColumnRenamed("id", "ID")
    return tables.read_vertices(spark, _saved(spark, vertices, "tb_vertices"))


@query
def vertex_sink(spark, sf_dir):
    path = scratch_path(spark, "vertex-sink")
    sinks.write_vertices(network(spark, sf_dir).vertices.drop("has_attrs"), path)
    return spark.read.parquet(path)


@query
def edge_sink(spark, sf_dir):
    path = scratch_path(spark, "edge-sink")
    sinks.write_edges(network(spark, sf_dir).edges, path, "csv", header="true")
    return spark.read.csv(path, header=True, schema="weight bigint, Origem bigint, Destino bigint")


def _exported(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    net = network(spark, sf_dir)
    path = scratch_path(spark, "graph-xml")
    sinks.export_graph_xml(net.vertices, net.edges, path)
    return sinks.read_graph_xml(spark, path)


@query
def graph_xml_attributes(spark, sf_dir):
    """Attribute values of the exported vertices and edges under their names and types."""
    net = network(spark, sf_dir)
    path = scratch_path(spark, "graph-attributes")
    sinks.export_graph_xml(net.vertices, net.edges, path)
    return sinks.read_attributes(spark, path)


@query
def graph_xml_nodes(spark, sf_dir):
    return _exported(spark, sf_dir)[0]


@query
def graph_xml(spark, sf_dir):
    return _exported(spark, sf_dir)[1].withColumn("weight", F.col("weight").cast("bigint"))


# ---- vote network ---------------------------------------------------------------------------------------------


@query
def relevant_votings(spark, sf_dir):
    return votes.relevant_votings(materialize(ballots(spark, sf_dir), "ballots"))


@query
def agreement_edges(spark, sf_dir):
    return votes.agreement_edges(materialize(ballots(spark, sf_dir), "ballots"), min_minority=1)


@query
def durable_edges(spark, sf_dir):
    agreements = votes.agreement_edges(materialize(ballots(spark, sf_dir), "ballots"), min_minority=1)
    return votes.durable_edges(materialize(agreements, "agreements"))


@query
def durable_edges_fixed(spark, sf_dir):
    agreements = votes.agreement_edges(materialize(ballots(spark, sf_dir), "ballots"), min_minority=1)
    return votes.durable_edges(agreements, min_weight=5)


@query
def labelled_vertices(spark, sf_dir):
    return votes.label_vertices(members(spark, sf_dir), parties(spark, sf_dir))


# ---- graph ----------------------------------------------------------------------------------------------------


def _raw_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier and part numbers as end points: repeated and reversed pairs and self-loops occur."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"),
        F.col("l_linenumber").cast("bigint").alias("weight"), F.col("l_orderkey").alias("placed"),
    )


@query
def canonical_edges(spark, sf_dir):
    return graph.canonical_edges(_raw_pairs(spark, sf_dir))


@query
def canonical_edges_last(spark, sf_dir):
    return graph.canonical_edges(_raw_pairs(spark, sf_dir), order_col="placed")


@query
def vertex_ids(spark, sf_dir):
    return graph.vertex_ids(network(spark, sf_dir).edges)


@query
def symmetric_edges(spark, sf_dir):
    return graph.symmetric_edges(network(spark, sf_dir).edges)


@query
def graph_size(spark, sf_dir):
    net = network(spark, sf_dir)
    return graph.graph_size(net.vertices, net.edges)


@query
def network_vertices(spark, sf_dir):
    return network(spark, sf_dir).vertices


@query
def induced_edges(spark, sf_dir):
    net = network(spark, sf_dir)
    return graph.induced_edges(net.edges, net.vertices, "ideologia")


# ---- metrics --------------------------------------------------------------------------------------------------


@query
def louvain_communities(spark, sf_dir):
    return communities(spark, sf_dir)


@query
def louvain_modularity(spark, sf_dir):
    net = network(spark, sf_dir)
    return metrics.modularity(net.edges, communities(spark, sf_dir), "modularidade")


@query
def community_check(spark, sf_dir):
    """What must hold for communities, whatever they are: all vertices labelled, labels by size, a score above others'."""
    net, found = network(spark, sf_dir), communities(spark, sf_dir)
    sizes = found.groupBy("modularidade").agg(F.count(F.lit(1)).alias("n"))
    labels = sizes.agg(F.count(F.lit(1)).alias("k"), F.min("modularidade").alias("lo"), F.max("modularidade").alias("hi")).first()
    after = sizes.select((F.col("modularidade") + 1).alias("modularidade"), F.col("n").alias("before"))
    ordered = sizes.join(after, "modularidade").filter("n > before").isEmpty()

    def score(members: DataFrame, label: str) -> float:
        return metrics.modularity(net.edges, members, label).first()["modularity"]

    q = score(found, "modularidade")
    alone = score(found.withColumn("modularidade", F.col("id")), "modularidade")
    unlabelled = net.vertices.join(found, "id", "left").agg(
        F.count(F.lit(1)).alias("n_vertices"), F.count_if(F.col("modularidade").isNull()).alias("n_unlabelled"))
    return unlabelled.select(
        "n_vertices", "n_unlabelled", F.lit(labels.lo == 0 and labels.hi == labels.k - 1).alias("consecutive"),
        F.lit(ordered).alias("by_size"), F.lit(q > alone).alias("beats_single"),
        F.lit(q > score(net.vertices, "ideologia")).alias("beats_ideology"))


@query
def community_optimality(spark, sf_dir):
    """No vertex gains by moving, no two communities by merging, by exact arithmetic from the stored labels alone."""
    net = network(spark, sf_dir)
    return community.optimality(net.edges, communities(spark, sf_dir), "modularidade").drop("n_groups")


@query
def ideology_optimality(spark, sf_dir):
    """The same certificate of the partition by ideology, whose counts SQL can find as well."""
    net = network(spark, sf_dir)
    return community.optimality(net.edges, net.vertices, "ideologia")


@query
def community_modularity(spark, sf_dir):
    net = network(spark, sf_dir)
    return metrics.modularity(net.edges, net.vertices, "ideologia")


@query
def weighted_density(spark, sf_dir):
    net = network(spark, sf_dir)
    return metrics.weighted_density(net.vertices, net.edges)


@query
def weighted_density_by_group(spark, sf_dir):
    net = network(spark, sf_dir)
    return metrics.weighted_density_by(net.vertices, net.edges, "ideologia")


@query
def weighted_density_by_community(spark, sf_dir):
    net = network(spark, sf_dir)
    return metrics.weighted_density_by(community_vertices(spark, sf_dir), net.edges, "modularidade")


@query
def strength(spark, sf_dir):
    return metrics.strength(network(spark, sf_dir).edges)


@query
def betweenness(spark, sf_dir):
    return centrality.betweenness(network(spark, sf_dir).edges)


@query
def betweenness_inverse(spark, sf_dir):
    """Strong agreement as nearness: path lengths are sums of reciprocal weights."""
    return centrality.betweenness(network(spark, sf_dir).edges, distance="inverse")


@query
def betweenness_by_sources(spark, sf_dir):
    """The betweenness summed over three disjoint sets of sources, each in two passes kept in a folder."""
    net = network(spark, sf_dir)
    folder, parts = scratch_path(spark, "passes"), []
    rows = max(1, net.vertices.count() ** 2 // 5)
    for part in range(3):
        some = net.vertices.select("id").filter(F.pmod("id", F.lit(3)) == part)
        parts.append(centrality.betweenness(net.edges, sources=some, state_rows=rows, resume=folder))
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.groupBy("id").agg(F.sum("Centralidade_Intermediacao").alias("Centralidade_Intermediacao"))


@query
def bridging_coefficient(spark, sf_dir):
    return metrics.bridging_coefficient(network(spark, sf_dir).edges)


@query
def bridging_centrality(spark, sf_dir):
    return centrality.bridging_centrality(network(spark, sf_dir).edges)


# ---- distribution ---------------------------------------------------------------------------------------------


def _bridges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices with their bridging coefficient, rounded so that both engines label equal numbers.

    Finer than results are rounded: one and a half times a number of nine decimals would often be a tie.
    """
    net = network(spark, sf_dir)
    coefficient = rounded(metrics.bridging_coefficient(net.edges), DIGITS + 3)
    return materialize(net.vertices.join(coefficient, "id"), "bridges")


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), "s_acctbal")


@query
def quartiles(spark, sf_dir):
    return distribution.quartiles(_bridges(spark, sf_dir), "coef_ponte")


@query
def quartiles_accounts(spark, sf_dir):
    return distribution.quartiles(_accounts(spark, sf_dir), "s_acctbal")


@query
def quartiles_prices(spark, sf_dir):
    return distribution.quartiles(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@query
def iqr_fences(spark, sf_dir):
    return distribution.iqr_fences(_bridges(spark, sf_dir), "coef_ponte")


@query
def quartile_label(spark, sf_dir):
    labelled = distribution.quartile_label(_bridges(spark, sf_dir), "coef_ponte")
    return labelled.select("id", "coef_ponte", "Quartil")


@query
def quartile_label_accounts(spark, sf_dir):
    return distribution.quartile_label(_accounts(spark, sf_dir), "s_acctbal")


@query
def outlier_label(spark, sf_dir):
    labelled = distribution.outlier_label(_bridges(spark, sf_dir), "coef_ponte")
    return labelled.select("id", "coef_ponte", "Outlier")


@query
def outlier_label_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return distribution.outlier_label(orders, "o_totalprice")


@query
def quartile_counts(spark, sf_dir):
    return distribution.quartile_counts(distribution.quartile_label(_bridges(spark, sf_dir), "coef_ponte"))


@query
def outlier_counts(spark, sf_dir):
    return distribution.outlier_counts(distribution.outlier_label(_bridges(spark, sf_dir), "coef_ponte"))


@query
def boxplot_stats(spark, sf_dir):
    return distribution.boxplot_stats(_bridges(spark, sf_dir), "coef_ponte")


def _bridging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices with their bridging centrality, the metric that the reports rank."""
    net = network(spark, sf_dir)
    return materialize(net.vertices.join(centrality.bridging_centrality(net.edges), "id"), "bridging")


@query
def quartile_counts_bridging(spark, sf_dir):
    return distribution.quartile_counts(distribution.quartile_label(_bridging(spark, sf_dir), RANKED))


@query
def outlier_counts_bridging(spark, sf_dir):
    return distribution.outlier_counts(distribution.outlier_label(_bridging(spark, sf_dir), RANKED))


@query
def boxplot_stats_bridging(spark, sf_dir):
    return distribution.boxplot_stats(_bridging(spark, sf_dir), RANKED)


@query
def vertex_metrics_report(spark, sf_dir):
    """The vertex report without communities, which no SQL can repeat."""
    return vertex_report(network(spark, sf_dir))


@query
def vertex_report_full(spark, sf_dir):
    return vertex_report(network(spark, sf_dir), communities(spark, sf_dir))


@query
def vertex_ranks(spark, sf_dir):
    return rank_vertices(_bridges(spark, sf_dir).select("id", "coef_ponte"), "coef_ponte")


# ---- profiles -------------------------------------------------------------------------------------------------


@query
def attribute_distribution(spark, sf_dir):
    return profile.attribute_distribution(network(spark, sf_dir).vertices, "ideologia")


@query
def attribute_distribution_community(spark, sf_dir):
    return profile.attribute_distribution(community_vertices(spark, sf_dir), "modularidade")


@query
def cross_share(spark, sf_dir):
    return profile.cross_share(network(spark, sf_dir).vertices, "ideologia", "partido")


@query
def cross_share_community(spark, sf_dir):
    return profile.cross_share(community_vertices(spark, sf_dir), "ideologia", "modularidade")


@query
def dominant_category(spark, sf_dir):
    return profile.dominant_category(network(spark, sf_dir).vertices, "ideologia", "partido")


@query
def dominant_category_community(spark, sf_dir):
    return profile.dominant_category(community_vertices(spark, sf_dir), "ideologia", "modularidade")


@query
def category_shares(spark, sf_dir):
    return profile.category_shares(network(spark, sf_dir).vertices, "ideologia")


@query
def group_shares(spark, sf_dir):
    return profile.group_shares(network(spark, sf_dir).vertices, "ideologia")


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices with attributes from two sources; the second knows only vertices with a neighbour of a higher number."""
    net = network(spark, sf_dir)
    above = net.edges.groupBy(F.col("src").alias("id")).agg(
        F.when(F.count(F.lit(1)) > 1, F.max("weight")).alias("maior_peso"))
    labels = net.vertices.filter("has_attrs").select("id", "nome", "partido", "ideologia")
    return attributes.attach_maps(net.vertices.select("id"), [labels, above])


@query
def attribute_presence(spark, sf_dir):
    return attributes.field_presence(_mapped(spark, sf_dir), ["nome", "ideologia", "maior_peso", "idade"])


@query
def attribute_distribution_by_presence(spark, sf_dir):
    """Missing and NULL are one group."""
    return profile.attribute_distribution(attributes.with_fields(_mapped(spark, sf_dir), {"maior_peso": "bigint"}), "maior_peso")


@query
def category_shares_by_presence(spark, sf_dir):
    """Shares among the vertices that have the field, be it NULL."""
    return profile.category_shares(attributes.with_fields(_mapped(spark, sf_dir), {"maior_peso": "bigint"}), "maior_peso")


@query
def group_shares_by_presence(spark, sf_dir):
    return profile.group_shares(attributes.with_fields(_mapped(spark, sf_dir), {"maior_peso": "bigint"}), "maior_peso")


@query
def strip_points(spark, sf_dir):
    """The jitter is a hash of Spark's own: only its range is compared."""
    points = profile.strip_points(_bridges(spark, sf_dir), "coef_ponte", "ideologia")
    return points.withColumn("x_in_range", F.abs("x") <= profile.JITTER).drop("x")


@query
def strip_points_bridging(spark, sf_dir):
    """Points of the ranked metric with the titles of their axes."""
    net = network(spark, sf_dir)
    ranked = centrality.bridging_centrality(net.edges).join(net.vertices.select("id", "ideologia"), "id")
    points = profile.strip_chart(ranked, RANKED, "ideologia")
    return points.withColumn("x_in_range", F.abs("x") <= profile.JITTER).drop("x", "log_y")


@query
def agreement_edges_pruned(spark, sf_dir):
    """Agreements of a fixed weight, where members who can't reach it are left out before any pair is made."""
    return votes.agreement_edges(materialize(ballots(spark, sf_dir), "ballots"), min_minority=1, min_weight=5)


@query
def chain_report(spark, sf_dir):
    """The report of the whole chain, run twice: the second run finds every step, and the graph file has the same size."""
    folder = scratch_path(spark, "chain")
    stored = [materialize(role(spark, sf_dir), "role") for role in (ballots, members, parties)]
    run_chain(*stored, folder)
    store = StepStore(spark, folder)
    out = run_chain(*stored, folder, store=store)
    sizes = [out[name].agg(F.count(F.lit(1))).scalar() for name in ("graph_nodes", "graph_edges")]
    return out["report"].drop("modularidade").withColumns(
        {"n_nodes": sizes[0], "n_edges": sizes[1], "steps_made_again": F.lit(len(store.made)).cast("bigint")})
