"""The whole analysis as one chain of stored steps, which goes on where an earlier run has ended.

A step is stored under its name and a fingerprint of what it is made from: the files of the sources, the parameters and
the fingerprints of the steps before it. A step whose result is there is read, not made again; changed sources or
parameters give other fingerprints, and so new results, for the steps that depend on them and no others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession

from plenum.operators import community, profile
from plenum.operators.centrality import bridging_centrality
from plenum.operators.distribution import boxplot_stats, outlier_counts, quartile_counts
from plenum.operators.graph import attach_attributes, vertex_ids
from plenum.operators.votes import agreement_edges, durable_edges, label_vertices
from plenum.plans.report import RANKED, rank_vertices
from plenum.sources.sinks import edge_report, export_graph_xml, read_graph_xml


def _status(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getFileStatus(place) if system.exists(place) else None


def files_fingerprint(source: DataFrame) -> str:
    """Of the files a frame reads, its columns and its plan: names, sizes, times of change."""
    told = [source._jdf.queryExecution().analyzed().canonicalized().toString(), str(source.schema)]
    for path in sorted(source.inputFiles()):
        status = _status(source.sparkSession, path)
        told.append(f"{path} {status.getLen()} {status.getModificationTime()}")
    return sha256("\n".join(told).encode()).hexdigest()


@dataclass
class StepStore:
    """Results below ``folder``, which all executors reach; ``made`` and ``found`` name the steps of this run."""

    spark: SparkSession
    folder: str
    made: list[str] = field(default_factory=list)
    found: list[str] = field(default_factory=list)

    def place(self, name: str, *inputs: object) -> tuple[str, str]:
        """Fingerprint and path of a step made from ``inputs``: values, fingerprints or frames of earlier steps."""
        told = [getattr(x, "fingerprint", x) for x in inputs]
        mark = sha256(repr((name, told)).encode()).hexdigest()[:24]
        return mark, f"{self.folder.rstrip('/')}/{name}-{mark}"

    def step(self, name: str, make: Callable[[], DataFrame], *inputs: object) -> DataFrame:
        """The stored table of a step; Spark marks it as complete only when all of it is written."""
        mark, path = self.place(name, *inputs)
        if _status(self.spark, f"{path}/_SUCCESS") is None:
            make().write.mode("overwrite").parquet(path)
            self.made.append(name)
        else:
            self.found.append(name)
        stored = self.spark.read.parquet(path)
        stored.fingerprint, stored.stored_in = mark, path
        return stored


def run_chain(
    ballots: DataFrame, members: DataFrame, parties: DataFrame, folder: str, field1: str = "ideologia",
    min_minority: int = 1, min_weight: int | None = None, quantile: float = 0.75, resolution: float = 1.0,
    store: StepStore | None = None,
) -> dict[str, DataFrame]:
    """From votes to the network, its communities, their comparison, bridge metrics, chart tables and graph file.

    Returns the stored tables by name: ``edges, vertices, communities, members_by_community, field_counts,
    cross_share, dominant, centrality, report, edge_report, quartile_counts, outlier_counts, box, strip, shares,
    colours`` and, as read back from the graph file of the analysed network, ``graph_nodes`` and ``graph_edges``.
    A run that was cut off goes on after its last complete step when it is started with the same sources and folder.
    """
    spark = ballots.sparkSession
    store = store or StepStore(spark, folder)
    sources = [files_fingerprint(x) for x in (ballots, members, parties)]

    agreed = store.step("agreements", lambda: agreement_edges(ballots, min_minority, min_weight), sources[0], min_minority, min_weight)
    edges = store.step("edges", lambda: durable_edges(agreed, min_weight, quantile), agreed, min_weight, quantile)
    vertices = store.step(
        "vertices", lambda: attach_attributes(vertex_ids(edges), label_vertices(members, parties)), edges, *sources[1:])
    groups = store.step("communities", lambda: community.louvain(edges, resolution), edges, resolution)
    placed = store.step("placed", lambda: vertices.join(groups, "id", "left"), vertices, groups)
    out = {"edges": edges, "vertices": vertices, "communities": groups}

    def made(name: str, make: Callable[[], DataFrame], *inputs: object) -> DataFrame:
        out[name] = store.step(name, make, *inputs)
        return out[name]

    made("members_by_community", lambda: profile.attribute_distribution(placed, "modularidade"), placed)
    made("field_counts", lambda: profile.attribute_distribution(placed, field1), placed, field1)
    made("cross_share", lambda: profile.cross_share(placed, field1, "modularidade"), placed, field1)
    made("dominant", lambda: profile.dominant_category(placed, field1, "modularidade"), placed, field1)
    metrics = made("centrality", lambda: bridging_centrality(edges), edges)
    report = made("report", lambda: placed.drop("has_attrs").join(rank_vertices(metrics), "id").withColumnRenamed("id", "ID"), placed, metrics)
    made("edge_report", lambda: edge_report(edges), edges)
    made("quartile_counts", lambda: quartile_counts(report), report)
    made("outlier_counts", lambda: outlier_counts(report), report)
    made("box", lambda: boxplot_stats(report, RANKED), report)
    made("strip", lambda: profile.strip_chart(report.withColumnRenamed("ID", "id"), RANKED, field1), report, field1)
    made("shares", lambda: profile.category_shares(placed, field1), placed, field1)
    made("colours", lambda: profile.group_shares(placed, "modularidade"), placed)

    # the file holds the metrics too, but not the labels of the ranking
    _, path = store.place("graph", report, edges)
    if _status(spark, f"{path}/attributes/_SUCCESS") is None:  # written last
        export_graph_xml(report.drop("Quartil", "Outlier").withColumnRenamed("ID", "id"), edges, path)
        store.made.append("graph")
    else:
        store.found.append("graph")
    out["graph_nodes"], out["graph_edges"] = read_graph_xml(spark, path)
    return out
