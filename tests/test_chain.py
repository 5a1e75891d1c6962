"""The chain of stored steps: what is made, found again, and made anew."""

import pytest
from pyspark.sql import functions as F

from plenum.operators import community, graph, metrics, profile
from plenum.plans import chain
from plenum.plans.chain import StepStore, run_chain
from plenum.session import materialize
from tests.conftest import rows


@pytest.fixture
def votes(spark):
    """Two blocs of five that vote alike inside, with a member between them; the parties of each bloc."""
    cast = [(v, m, "Y" if (m <= 5) == (v % 2 == 0) or (m == 6 and v % 3 == 0) else "N") for v in range(30) for m in range(1, 12)]
    ballots = spark.createDataFrame(cast, "voting bigint, member bigint, vote string")
    members = spark.createDataFrame([(m, f"m{m}", "A" if m <= 5 else "B") for m in range(1, 12)], "id bigint, nome string, partido string")
    parties = spark.createDataFrame([("A", "left"), ("B", None)], "partido string, ideologia string")
    return [materialize(x, "votes") for x in (ballots, members, parties)]


def test_chain_goes_on_after_a_lost_step(spark, votes, tmp_path, monkeypatch):
    folder = str(tmp_path / "steps")

    def lost(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(chain.community, "louvain", lost)
    first = StepStore(spark, folder)
    with pytest.raises(RuntimeError):
        run_chain(*votes, folder, quantile=0.3, store=first)
    assert first.made == ["agreements", "edges", "vertices"]
    monkeypatch.undo()

    second = StepStore(spark, folder)
    out = run_chain(*votes, folder, quantile=0.3, store=second)
    assert second.found == first.made and second.made[0] == "communities" and second.made[-1] == "graph"
    third = StepStore(spark, folder)
    again = run_chain(*votes, folder, quantile=0.3, store=third)
    assert not third.made and {k: rows(v) for k, v in again.items()} == {k: rows(v) for k, v in out.items()}

    # each output is what its operator gives
    edges, placed = out["edges"], out["vertices"].join(out["communities"], "id")
    assert rows(out["vertices"].select("id")) == rows(graph.vertex_ids(edges))
    assert community.optimality(edges, out["communities"], "modularidade").first()["n_gaining_moves"] == 0
    assert rows(out["cross_share"]) == rows(profile.cross_share(placed, "ideologia", "modularidade"))
    assert rows(out["dominant"]) == rows(profile.dominant_category(placed, "ideologia", "modularidade"))
    assert rows(out["shares"]) == rows(profile.category_shares(placed, "ideologia"))
    assert rows(out["colours"]) == rows(profile.group_shares(placed, "modularidade"))
    report = out["report"]
    assert report.count() == out["strip"].count() == out["graph_nodes"].count() == placed.count()
    assert rows(out["edge_report"].select("Origem", "Destino")) == rows(edges.select("src", "dst"))
    assert out["graph_edges"].count() == edges.count()
    assert sum(r.n for r in out["quartile_counts"].collect()) == report.count() and out["box"].count() == 1
    assert out["outlier_counts"].count() == 1 and out["strip"].first().y_title == "Centralidade ponte"
    assert rows(out["centrality"].select("id", "coef_ponte")) == rows(metrics.bridging_coefficient(edges))

    # other data, other results; what doesn't depend on them stays
    changed = votes[1].withColumn("partido", F.when(F.col("id") == 1, "B").otherwise(F.col("partido")))
    fourth = StepStore(spark, folder)
    run_chain(votes[0], materialize(changed, "votes"), votes[2], folder, quantile=0.3, store=fourth)
    assert {"agreements", "edges", "communities", "centrality"} <= set(fourth.found) and "vertices" in fourth.made
