"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local threads. Every query is computed in
full and its rows are thrown away. ``network_build`` runs the chain from ballots to the stored network; the queries
after it read those tables, and ``louvain_communities`` is computed once and read by the comparisons after it.
"""

from __future__ import annotations

import json
import os
import sys
import time

# tasks in Python import the package too
os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(os.path.abspath(__file__)), os.environ.get("PYTHONPATH", "")])
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plenum.catalogue.queries import all_queries  # noqa: E402
from plenum.catalogue.roles import community_vertices, network  # noqa: E402
from plenum.operators.profile import cross_share  # noqa: E402
from plenum.session import get_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "load_audit", "relevant_votings", "agreement_edges", "durable_edges", "canonical_edges", "weighted_density",
    "weighted_density_by_group", "community_modularity", "strength", "bridging_coefficient", "quartile_label",
    "outlier_label_orders", "boxplot_stats", "category_shares", "dominant_category", "graph_xml",
    "bridging_centrality", "louvain_communities",
]


def main() -> None:
    spark = get_session(
        "bench", f"local[{CPUS}]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=CPUS, spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = all_queries()
    spark.range(1000).groupBy("id").count().write.format("noop").mode("overwrite").save()  # start-up

    seconds = {}

    def timed(name, run):
        start = time.time()
        run().write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)

    timed("network_build", lambda: network(spark, FOLDER, rebuild=True).vertices)
    for name in HEADLINE:
        timed(name, lambda: runs[name](spark, FOLDER))
    timed("cross_share_community", lambda: cross_share(community_vertices(spark, FOLDER), "ideologia", "modularidade"))
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
