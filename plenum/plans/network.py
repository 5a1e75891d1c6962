"""From ballots, members and parties to the stored network."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from plenum.operators.graph import attach_attributes, vertex_ids
from plenum.operators.votes import agreement_edges, durable_edges, label_vertices
from plenum.session import materialize


@dataclass(frozen=True)
class Network:
    """Durable agreement network: canonical edges, and their vertices with attributes."""

    vertices: DataFrame
    edges: DataFrame


def build_network(
    ballots: DataFrame,
    members: DataFrame,
    parties: DataFrame,
    min_minority: int = 1,
    min_weight: int | None = None,
    quantile: float = 0.75,
) -> Network:
    """Relevant votings, agreements, durable agreements, labelled vertices; both tables are written.

    Ballots and all agreements are written too, because each is read more than once.
    """
    agreements = agreement_edges(ballots, min_minority, min_weight)
    if min_weight is None:
        agreements = materialize(agreements, "agreements")
    edges = materialize(durable_edges(agreements, min_weight, quantile), "edges")
    vertices = attach_attributes(vertex_ids(edges), label_vertices(members, parties))
    return Network(materialize(vertices, "vertices"), edges)
