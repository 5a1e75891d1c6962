"""The vertex report: attributes, communities, centralities and their labels."""

from __future__ import annotations

from pyspark.sql import DataFrame

from plenum.operators.centrality import bridging_centrality
from plenum.operators.distribution import iqr_fences, outlier_label, quartile_label
from plenum.plans.network import Network
from plenum.session import materialize

RANKED = "Centralidade_Ponte"  # fixed name of the column that is ranked


def rank_vertices(metrics: DataFrame, column: str = RANKED) -> DataFrame:
    """Add quartile and outlier label of one column; its quartiles are found once."""
    limits = iqr_fences(metrics, column).first()
    return outlier_label(quartile_label(metrics, column, limits), column, limits)


def vertex_report(network: Network, communities: DataFrame | None = None) -> DataFrame:
    """One row per vertex: attributes, community, centralities, ``Quartil``, ``Outlier`` and ``ID``.

    ``communities`` is the result of community detection on the network's edges; without it the column is left out.
    """
    metrics = materialize(bridging_centrality(network.edges), "centrality")
    rows = network.vertices.drop("has_attrs")
    if communities is not None:
        rows = rows.join(communities, "id", "left")
    return rows.join(rank_vertices(metrics), "id").withColumnRenamed("id", "ID")
