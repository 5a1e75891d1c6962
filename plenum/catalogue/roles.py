"""Test tables in the roles of the domain: suppliers vote, order keys are votings, nations are parties."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenum.operators.community import louvain
from plenum.operators.votes import ballots_from
from plenum.plans.chain import files_fingerprint
from plenum.plans.network import Network, build_network
from plenum.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ballots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ballots_from(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey", "l_returnflag")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, "s_nationkey", "left")
        .select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nome"), F.col("n_name").alias("partido"))
    )


def parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return (
        table(spark, sf_dir, "nation")
        .join(region, "n_regionkey", "left")
        .select(F.col("n_name").alias("partido"), F.col("r_name").alias("ideologia"))
    )


_networks: dict[tuple[str, str], Network] = {}
_communities: dict[tuple[str, str], DataFrame] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Application, and fingerprint of the files: changed data are another network."""
    told = [files_fingerprint(table(spark, sf_dir, name)) for name in ("lineitem", "supplier", "nation", "region")]
    return spark.sparkContext.applicationId, "".join(told)


def network(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> Network:
    """The network of one data folder. It is a pair of stored tables: built once per application, then read."""
    key = _key(spark, sf_dir)
    if rebuild or key not in _networks:
        _networks[key] = build_network(ballots(spark, sf_dir), members(spark, sf_dir), parties(spark, sf_dir))
        _communities.pop(key, None)
    return _networks[key]


def communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Community of each vertex of the network, a stored table as well."""
    key, net = _key(spark, sf_dir), network(spark, sf_dir)
    if key not in _communities:
        _communities[key] = materialize(louvain(net.edges), "communities")
    return _communities[key]


def community_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Network vertices with attributes and community."""
    return network(spark, sf_dir).vertices.join(communities(spark, sf_dir), "id")
