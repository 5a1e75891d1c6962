import math
import random
from fractions import Fraction
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plenum.operators import centrality, community, graph, metrics, near_communities, near_paths, packed
from plenum.operators.near_communities import settle_packed
from plenum.session import materialize
from tests.conftest import EDGES, T1, T2, T3, T4, pairs, rows


def brute_betweenness(edge_rows):
    """Share of shortest paths through each vertex, counting paths by increasing distance."""
    near = {}
    for a, b, w in edge_rows:
        near.setdefault(a, {})
        near.setdefault(b, {})
        if a != b:
            near[a][b] = near[b][a] = w
    def paths(s):
        dist = {s: 0}
        for _ in near:
            for u in list(dist):
                for v, w in near[u].items():
                    if dist[u] + w < dist.get(v, 1 << 60):
                        dist[v] = dist[u] + w
        count = {s: 1}
        for v in sorted(dist, key=dist.get):
            if v != s:
                count[v] = sum(count[u] for u, w in near[v].items() if u in dist and dist[u] + w == dist[v])
        return dist, count
    all_paths = {s: paths(s) for s in near}
    n, result = len(near), {v: 0.0 for v in near}
    for s in near:
        dist, count = all_paths[s]
        for t in dist:
            for v in dist:
                if len({s, t, v}) == 3 and t in all_paths[v][0] and dist[v] + all_paths[v][0][t] == dist[t]:
                    result[v] += count[v] * all_paths[v][1][t] / count[t]
    return {v: b / ((n - 1) * (n - 2)) if n > 2 else 0.0 for v, b in result.items()}


def test_canonical_edges(spark):
    raw = spark.createDataFrame(
        [(2, 1, 5, 1), (1, 2, 3, 2), (3, 3, 1, 1), (None, 1, 9, 1)], "src bigint, dst bigint, weight bigint, at bigint"
    )
    assert rows(graph.canonical_edges(raw)) == [(1, 2, 5), (3, 3, 1)]
    assert rows(graph.canonical_edges(raw, "at")) == [(1, 2, 3), (3, 3, 1)]


def test_symmetric_edges_and_ids(edges):
    net = edges([(1, 2, 4), (3, 3, 1)])
    assert rows(graph.symmetric_edges(net)) == [(1, 2, 4), (2, 1, 4), (3, 3, 1)]
    assert rows(graph.vertex_ids(net)) == [(1,), (2,), (3,)]
    assert rows(graph.graph_size(graph.vertex_ids(net), net)) == [(3, 2)]


def test_attributes_only_for_network_vertices(spark, edges):
    ids = graph.vertex_ids(edges(T1))
    attrs = spark.createDataFrame(
        [("1", "b", 1), ("1", "a", 2), ("2", None, 1), ("9", "z", 1)], "id string, nome string, at int"
    )
    assert rows(graph.attach_attributes(ids, attrs.drop("at"))) == [(1, "a", True), (2, None, True), (3, None, False)]
    assert rows(graph.attach_attributes(ids, attrs, "at"))[0] == (1, "a", True)


def test_induced_edges_with_and_without_split_hub(spark, edges):
    star = edges([(0, i, 1) for i in range(1, 30)] + [(1, 2, 7)])
    groups = spark.createDataFrame([(i, "a" if i < 10 else "b") for i in range(30)], "id bigint, g string")
    expected = sorted([(0, i, 1, "a") for i in range(1, 10)] + [(1, 2, 7, "a")])
    assert sorted(rows(graph.induced_edges(star, groups, "g"))) == expected
    assert sorted(rows(graph.induced_edges(star, groups, "g", floor=3))) == expected


@pytest.mark.parametrize("net, density", [(T1, 2 / 3), (T2, 7 / 15), (T3, 5 / 3), ([(1, 1, 4)], 0.0)])
def test_density(edges, net, density):
    net = edges(net)
    assert metrics.weighted_density(graph.vertex_ids(net), net).first()["density"] == pytest.approx(density)


def test_density_of_groups(spark, edges):
    groups = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 1), (5, 1), (6, 1), (7, 2), (8, None)], "id bigint, g int")
    found = pairs(metrics.weighted_density_by(groups, edges(T2), "g"), "g", "density")
    assert found == {0: 1.0, 1: 1.0, 2: 0.0}


def test_strength_and_bridging_coefficient(edges):
    assert pairs(metrics.strength(edges(T2)), "id", "strength") == {1: 2, 2: 2, 3: 3, 4: 3, 5: 2, 6: 2}
    assert pairs(metrics.strength(edges([(1, 1, 5), (1, 2, 1)])), "id", "strength") == {1: 6, 2: 1}
    assert pairs(metrics.bridging_coefficient(edges(T1))) == {1: 0.5, 2: 2.0, 3: 0.5}
    expected = {1: 5 / 6, 2: 5 / 6, 3: 4 / 3, 4: 4 / 3, 5: 5 / 6, 6: 5 / 6}
    for floor in (100, 1):
        assert pairs(metrics.bridging_coefficient(edges(T2), floor)) == pytest.approx(expected)
    assert pairs(metrics.bridging_coefficient(edges([(1, 2, 0)]))) == {1: 0.0, 2: 0.0}


def test_modularity(spark, edges):
    halves = spark.createDataFrame([(i, i > 3) for i in range(1, 7)], "id bigint, g boolean")
    assert metrics.modularity(edges(T2), halves, "g").first()["modularity"] == pytest.approx(6 / 7 - 1 / 2)
    planted = spark.createDataFrame([(i, i // 8) for i in range(32)], "id bigint, g int")
    assert metrics.modularity(edges(T4), planted, "g").first()["modularity"] == pytest.approx(0.746441281)
    one = spark.createDataFrame([(i, None) for i in range(1, 7)], "id bigint, g int")
    assert metrics.modularity(edges(T2), one, "g").first()["modularity"] == pytest.approx(0.0)


@pytest.mark.parametrize(
    "net, expected",
    [
        (T1, {1: 0.0, 2: 1.0, 3: 0.0}),
        (T2, {1: 0, 2: 0, 3: 0.6, 4: 0.6, 5: 0, 6: 0}),
        (T3, {1: 0.0, 2: 1.0, 3: 0.0}),
        (T3[:2] + [(1, 3, 2)], {1: 0.0, 2: 0.5, 3: 0.0}),
        ([(1, 2, 1)], {1: 0.0, 2: 0.0}),
        ([(1, 2, 1), (3, 4, 2), (4, 5, 2), (6, 6, 1)], {1: 0, 2: 0, 3: 0, 4: 0.1, 5: 0, 6: 0}),
        ([], {}),
    ],
)
def test_betweenness(edges, net, expected):
    assert pairs(centrality.betweenness(edges(net))) == pytest.approx(expected)


def test_bridging_centrality(edges):
    found = pairs(centrality.bridging_centrality(edges(T2)), "id", "Centralidade_Ponte")
    assert found == pytest.approx({1: 0, 2: 0, 3: 0.8, 4: 0.8, 5: 0, 6: 0})


@pytest.mark.parametrize("seed", [1, 2])
def test_betweenness_against_brute_force(edges, seed):
    rng = random.Random(seed)
    net = {tuple(sorted((rng.randrange(12), rng.randrange(12)))): rng.randint(1, 4) for _ in range(24)}
    net = [(a, b, w) for (a, b), w in net.items()]
    expected = brute_betweenness(net)
    # one pass next to broadcast edges; then two passes, edges shuffled instead, hubs split
    options = {} if seed == 1 else {"broadcast_edges": 0, "state_rows": 80, "floor": 2}
    assert pairs(centrality.betweenness(edges(net), **options)) == pytest.approx(expected)


def test_betweenness_of_a_chain(edges):
    chain = [(i, i + 1, 1) for i in range(9)]
    assert pairs(centrality.betweenness(edges(chain))) == pytest.approx(brute_betweenness(chain))


def test_betweenness_needs_exact_positive_weights(spark, edges):
    with pytest.raises(ValueError):
        centrality.betweenness(edges([(1, 2, 0), (2, 3, 1)]))
    with pytest.raises(ValueError):
        centrality.betweenness(spark.createDataFrame([(1, 2, 0.5)], "src bigint, dst bigint, weight double"))
    tenths = spark.createDataFrame([(1, 2, 1), (2, 3, 2), (1, 3, 3)], EDGES).selectExpr(
        "src", "dst", "cast(weight / 10.0 as decimal(10, 1)) as weight"
    )
    assert pairs(centrality.betweenness(tenths)) == {1: 0.0, 2: 0.5, 3: 0.0}


def test_betweenness_with_strong_ties_as_near(spark, edges):
    """Lengths are sums of reciprocals, compared exactly: 1/3 + 1/6 = 1/2 ties, as doubles need not."""
    found = pairs(centrality.betweenness(edges([(1, 2, 3), (2, 3, 6), (1, 3, 2)]), distance="inverse"))
    assert found == {1: 0.0, 2: 0.5, 3: 0.0}
    net = [(i, j, w) for i, j, w in random_net(14, 0.4, seed=5, low=1, high=12)]
    scale = math.lcm(*(w for *_, w in net))
    brute = brute_betweenness([(a, b, scale // w) for a, b, w in net])
    found = pairs(centrality.betweenness(edges(net), distance="inverse"))
    assert found == pytest.approx(brute) and set(found) == set(brute)
    tenths = edges(net).withColumn("weight", (F.col("weight") / 10).cast("decimal(10,1)"))
    assert pairs(centrality.betweenness(tenths, distance="inverse")) == pytest.approx(brute)
    primes = [(i, i + 1, p) for i, p in enumerate(p for p in range(100, 400) if all(p % q for q in range(2, p)))]
    with pytest.raises(ValueError, match="common denominator"):
        centrality.betweenness(edges(primes), distance="inverse")
    with pytest.raises(ValueError, match="positive"):
        centrality.betweenness(edges([(1, 2, 0)]), distance="inverse")
    big = [(1, 2, 999_999_999_989), (2, 3, 999_999_999_961), (1, 3, 499_999_999_000)]  # lengths beyond 64 bits
    assert pairs(centrality.betweenness(edges(big), distance="inverse")) == {1: 0.0, 2: 1.0, 3: 0.0}
    assert pairs(centrality.betweenness(edges([]), distance="inverse")) == {}


def test_betweenness_goes_on_after_a_lost_pass(spark, edges, tmp_path, monkeypatch):
    """Sources in passes, one of which fails: the rerun computes that one and those after it only."""
    net = materialize(edges(random_net(15, 0.3, seed=9)), "net")
    whole, folder = pairs(centrality.betweenness(net)), str(tmp_path / "passes")
    done, shortest = [], centrality._shortest

    def watched(walks, mine):
        done.append(1)
        if len(done) == 3:
            raise RuntimeError("driver lost")
        return shortest(walks, mine)

    monkeypatch.setattr(centrality, "_shortest", watched)
    with pytest.raises(RuntimeError):
        centrality.betweenness(net, state_rows=60, resume=folder)
    found = pairs(centrality.betweenness(net, state_rows=60, resume=folder))
    assert found == pytest.approx(whole) and len(done) == 3 + 4 - 2
    assert pairs(centrality.betweenness(net, state_rows=60, resume=folder)) == found and len(done) == 5
    other = materialize(net.withColumn("weight", F.col("weight") + 1), "other")  # not the same network: nothing is reused
    assert pairs(centrality.betweenness(other, state_rows=60, resume=folder)) == pytest.approx(pairs(centrality.betweenness(other)))


def test_betweenness_of_sources(spark, edges):
    net = materialize(edges(random_net(15, 0.3, seed=9) + [(50, 51, 1), (60, 60, 1)]), "net")
    whole = pairs(centrality.betweenness(net))
    parts = [pairs(centrality.betweenness(net, sources=spark.createDataFrame(rows, "id bigint")))
             for rows in ([(1,), (2,), (2,), (None,), (777,)], [(i,) for i in (0, *range(3, 61))], [])]
    assert {v: sum(p[v] for p in parts) for v in whole} == pytest.approx(whole)
    assert set(parts[2].values()) == {0.0} and any(parts[0].values())


@pytest.mark.parametrize("floor", [100_000, 1])
def test_louvain_finds_planted_groups(spark, edges, floor):
    found = pairs(community.louvain(materialize(edges(T4), "t4"), floor=floor))
    assert found == {i: i // 8 for i in range(32)}


def test_louvain_small_and_disconnected(edges):
    assert pairs(community.louvain(edges(T2))) == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1, 6: 1}
    found = pairs(community.louvain(edges([(1, 2, 1), (3, 4, 1), (4, 5, 1), (3, 5, 1), (9, 9, 2)])))
    assert found == {3: 0, 4: 0, 5: 0, 1: 1, 2: 1, 9: 2}
    assert pairs(community.louvain(edges([]))) == {}


def test_louvain_does_not_depend_on_row_order(spark, edges):
    net = sorted({(min(a, b), max(a, b), 1 + a * b % 3) for a in range(12) for b in (a * 7 % 12, a + 1) if a != b})
    one = pairs(community.louvain(materialize(edges(net), "a")))
    two = pairs(community.louvain(materialize(edges(net[::-1]).repartition(5), "b")))
    assert one == two and set(one) == {v for a, b, _ in net for v in (a, b)}
    q = metrics.modularity(edges(net), spark.createDataFrame(list(one.items()), "id bigint, g int"), "g").first()
    alone = spark.createDataFrame([(v, v) for v in one], "id bigint, g bigint")
    assert q["modularity"] > metrics.modularity(edges(net), alone, "g").first()["modularity"]


HEAVY = [(3 * i + a, 3 * i + b, 1) for i in range(60) for a, b in ((0, 1), (1, 2), (0, 2))]


@pytest.mark.parametrize("heavy", [1000, 10**15])
def test_louvain_of_a_heavy_network(edges, heavy):
    """One edge of any weight leaves the triangles around it whole."""
    net = materialize(edges([*HEAVY, (9000, 9001, heavy)]), "heavy")
    found = community.louvain(net)
    groups = pairs(found)
    assert len(set(groups.values())) == 61
    assert all(groups[a] == groups[b] for a, b, _ in HEAVY)
    assert community.optimality(net, found, "modularidade").first() == (182, 61, 0, 0)


def random_net(n, share, seed=3, low=1, high=4):
    rng = random.Random(seed)
    return [(i, j, rng.randint(low, high)) for i in range(n) for j in range(i + 1, n) if rng.random() < share]


@pytest.mark.parametrize("floor", [community.HOT_FLOOR, 12])
def test_louvain_keeps_weights_as_a_recount_finds_them(spark, edges, floor):
    """After any moves the kept weights, strengths and score equal those counted anew from all edges; hubs too."""
    rows = random_net(40, 0.15) + [(100, i, 1) for i in range(40)] + [(5, 5, 3), (100, 100, 2)]
    net = community.whole_weights(materialize(edges(rows), "net"))
    level = community.Level(net, community._numbers(net, 1.0), floor, group=10)
    assert level.groups > 1 and (level.hubs is not None) == (floor == 12)
    near = level.count(level.nodes.select("id", F.col("id").alias("label")))
    for turn in range(3):
        moves, count = level.moves(near, turn % 2, 2)
        if floor == 12 and turn == 2:
            moves, count = level._some_hubs(near, 1)
        near = level.update(near, moves)
        anew = level.count(near.labels())
        for one, two in ((near.rows(), anew.rows()), (near.groups, anew.groups)):
            assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
        assert near.score == anew.score and (turn or count)


@pytest.mark.parametrize("kind, floor", [("bigint", 12), ("decimal(12,2)", community.HOT_FLOOR), ("double", 12), ("decimal(30,0)", 12)])
def test_louvain_ends_where_no_move_and_no_merge_pays(spark, edges, kind, floor):
    rows = random_net(50, 0.12) + [(200, i, 1) for i in range(0, 50, 2)] + [(7, 7, 5), (300, 301, 2), (400, 400, 1)]
    scale = {"decimal(30,0)": 10**15}.get(kind, 1)
    net = materialize(edges(rows).withColumn("weight", (F.col("weight") * F.lit(scale).cast("decimal(20,0)")).cast(kind)), "net")
    found = community.louvain(net, floor=floor)
    proof = community.optimality(net, found, "modularidade").first()
    assert (proof.n_vertices, proof.n_gaining_moves, proof.n_gaining_merges) == (54, 0, 0)
    alone = community.optimality(net, found.withColumn("modularidade", F.col("id")), "modularidade").first()
    assert alone.n_groups == 54 and alone.n_gaining_moves > 40 and alone.n_gaining_merges > 40
    q = metrics.modularity(net, found, "modularidade").first()["modularity"]
    assert q > metrics.modularity(net, found.withColumn("modularidade", F.col("id") % 4), "modularidade").first()["modularity"]


def test_certificate_sees_what_would_gain(edges):
    net = materialize(edges(T2), "t2")
    members = net.sparkSession.createDataFrame([(i, "a" if i < 4 else None) for i in range(1, 7)], "id bigint, g string")
    assert community.optimality(net, members, "g").first() == (6, 2, 0, 0)
    wrong = net.sparkSession.createDataFrame([(i, i % 2) for i in range(1, 7)], "id bigint, g bigint")
    assert community.optimality(net, wrong, "g").first()["n_gaining_moves"] == 4
    assert community.optimality(edges([]), members, "g").first() == (0, 0, 0, 0)


def counted(monkeypatch, module, *names):
    """A list that grows with each table the module stores."""
    made = []
    for name in names:
        monkeypatch.setattr(module, name, lambda *a, f=getattr(module, name): made.append(1) or f(*a))
    return made


def test_betweenness_of_a_long_chain_takes_few_steps(edges, monkeypatch):
    """Its paths are as long as the chain, and one stored round per edge of a path took minutes."""
    made = counted(monkeypatch, centrality, "materialize")
    n = 40
    found = pairs(centrality.betweenness(edges([(i, i + 1, 1) for i in range(n - 1)])))
    assert found == pytest.approx({i: 2 * i * (n - 1 - i) / ((n - 1) * (n - 2)) for i in range(n)})
    assert len(made) < 12


@pytest.mark.parametrize("near_edges", [30, 1_000])
def test_betweenness_of_parts_equals_that_in_rounds(edges, monkeypatch, near_edges):
    """Components dealt to parts, large ones in blocks of sources, and those beyond the bound in rounds."""
    monkeypatch.setattr(centrality, "ONE_PART", 0)
    monkeypatch.setattr(centrality, "BLOCK_WORK", 200)
    rows = random_net(14, 0.3, seed=4) + [(i + 100, j + 100, w) for i, j, w in random_net(6, 0.6, seed=8)]
    rows += [(3 * i + 200, 3 * i + 201 + k, 2) for i in range(5) for k in (0, 1)] + [(300, 300, 1), (5, 5, 2)]
    net = materialize(edges(rows), "net")
    assert pairs(centrality.betweenness(net, near_edges=near_edges)) == pytest.approx(brute_betweenness(rows))


def test_louvain_of_small_components_takes_few_steps(edges, monkeypatch):
    """Components that fit a group are settled at once, instead of in a dozen stored turns of all groups."""
    rows = [(i + 100 * c, j + 100 * c, w) for c in range(3) for i, j, w in random_net(30, 0.2, seed=c)]
    net = materialize(edges(rows), "net")
    made = counted(monkeypatch, community, "materialize", "store_bucketed")
    found = community.louvain(net, near_rows=400)
    assert len(made) < 6
    assert community.optimality(net, found, "modularidade").first()[2:] == (0, 0)


@pytest.mark.parametrize("kind, near_rows", [("bigint", 0), ("decimal(12,2)", 60), ("double", 10**6)])
def test_louvain_of_components_of_all_sizes(edges, kind, near_rows):
    """In turns, partly in turns and without any, nothing gains; loops, lone vertices and weights of 0 and NULL count."""
    rows = random_net(30, 0.2) + [(i + 100, j + 100, w) for i, j, w in random_net(7, 0.7, seed=2)]
    rows += [(200, 201, 2), (300, 300, 3), (400, 401, 0), (3, 3, 2), (100, 100, 1), (500, 501, None)]
    net = materialize(edges(rows).withColumn("weight", F.col("weight").cast(kind)), "net")
    found = materialize(community.louvain(net, near_rows=near_rows), "found")
    proof = community.optimality(net, found, "modularidade").first()
    vertices = graph.vertex_ids(net).count()
    assert (proof.n_vertices, proof.n_gaining_moves, proof.n_gaining_merges) == (vertices, 0, 0)
    assert found.count() == vertices and found.filter("modularidade IS NULL").isEmpty()
    label = pairs(found)
    assert label[200] == label[201] and label[400] != label[401] and label[500] != label[501]
    sizes = [row["count"] for row in found.groupBy("modularidade").count().orderBy("modularidade").collect()]
    assert sizes == sorted(sizes, reverse=True)


def random_parts():
    """Components of all sizes, a self-loop on a vertex of its own and one inside a component."""
    rows = random_net(14, 0.3, seed=4) + [(i + 100, j + 100, w) for i, j, w in random_net(6, 0.6, seed=8)]
    return rows + [(3 * i + 200, 3 * i + 201 + k, 2) for i in range(5) for k in (0, 1)] + [(300, 300, 1), (5, 5, 2)]


@pytest.mark.parametrize("few, star_rows", [(10**6, 4), (10**6, 10**6), (0, 7)])
def test_components_from_links_left_by_tasks(edges, monkeypatch, few, star_rows):
    """Components were found in rounds even where a few links are left: eight stored tables and more."""
    monkeypatch.setattr(near_paths, "STAR_ROWS", star_rows)
    rows = random_parts()
    made = counted(monkeypatch, graph, "materialize")
    found = pairs(graph.components(edges(rows).repartition(3), few=few))
    parent = {v: v for a, b, _ in rows for v in (a, b)}
    for _ in parent:
        for a, b, _ in rows:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert found == parent
    assert few == 0 or len(made) == 2
    assert graph.components(edges([])).isEmpty()


@pytest.mark.parametrize("most, bounds", [(2, 32), (1000, 32), (1000, 3)])
def test_paths_in_a_task_follow_few_edges(monkeypatch, most, bounds):
    """Each source went over all edges of its component several times; the sums are those of the sweeps over all edges."""
    monkeypatch.setattr(near_paths, "BOUNDS", bounds)
    rng = np.random.default_rng(3)
    n = 400
    ends = np.unique(np.sort(rng.integers(0, n, (n * 20, 2)), axis=1), axis=0)
    ends = np.unique(np.concatenate([ends[ends[:, 0] < ends[:, 1]], [(i, i + 1) for i in range(n - 1)]]), axis=0)
    w = rng.integers(1, most + 1, len(ends))
    s, t, w = np.append(*ends.T), np.append(*ends.T[::-1]), np.append(w, w)
    order = np.lexsort((w, t))
    part = near_paths.Component(n, s[order], t[order], w[order])
    followed, useful = [], part.useful
    monkeypatch.setattr(part, "useful", lambda *a: followed.append(x := useful(*a)) or x)
    for at in range(0, n, 40):
        d, steps = np.full(n, 1 << 40), 0
        d[at] = 0
        while (new := np.minimum(d, np.minimum.reduceat(d[part.src] + part.w, part.start))).tolist() != d.tolist():
            d, steps = new, steps + 1
        assert part.distances(at).tolist() == d.tolist()
        tight, paths, got = d[part.src] + part.w == d[part.tgt], (np.arange(n) == at) * 1.0, np.zeros(n)
        for level in np.unique(d)[1:]:
            here = tight & (d[part.tgt] == level)
            np.add.at(paths, part.tgt[here], paths[part.src[here]])
        for level in np.unique(d)[:0:-1]:
            here = tight & (d[part.tgt] == level)
            a, b = part.src[here], part.tgt[here]
            np.add.at(got, a, paths[a] / paths[b] * (1 + got[b]))
        got[at] = 0
        assert part.dependencies(at) == pytest.approx(got)
    sizes = [len(part.src) if x is None else len(x[0]) for x in followed]
    assert sum(sizes) < 0.45 * len(part.src) * len(sizes)


@pytest.mark.parametrize("sources", [1, 5])
def test_betweenness_of_blocks_of_few_sources(edges, monkeypatch, sources):
    """A block has at least so many sources, as each gets all edges of its component."""
    for name, value in (("ONE_PART", 0), ("BLOCK_WORK", 200), ("BLOCK_SOURCES", sources)):
        monkeypatch.setattr(centrality, name, value)
    rows = random_parts() + [(400 + i, 401 + i, 10 ** (2 + 2 * i)) for i in range(6)]
    net = materialize(edges(rows), "net")
    walks = centrality._Walks(net, "weight", 10, 10, 1_000)
    assert walks.places.groupBy("part").agg(F.first("blocks").alias("b"), F.count("u").alias("n")).filter(
        F.col("b") > F.ceil(F.col("n") / sources)).isEmpty()
    assert pairs(centrality.betweenness(net, near_edges=1_000)) == pytest.approx(brute_betweenness(rows))


def test_louvain_of_a_component_beyond_a_group_takes_few_steps(spark, monkeypatch):
    """A component of over 500,000 directed edges went through dozens of stored turns; a task holds it, packed."""
    ends = spark.range(720).toDF("src").crossJoin(spark.range(720).toDF("dst")).filter("src < dst")
    net = materialize(ends.withColumn("weight", F.when(F.expr("src % 4 = dst % 4"), 10).otherwise(1).cast("bigint")), "net")
    made = counted(monkeypatch, community, "materialize", "store_bucketed")
    found = community.louvain(net)
    assert len(made) < 6
    assert pairs(found) == {i: i % 4 for i in range(720)}


@pytest.mark.parametrize("low, high", [(1, 1), (0, 3), (-2, 5), (1, 10**6)])
def test_packed_components_settle_as_others(low, high):
    """Packed edges keep all numbers, and lead to the communities that plain ones do."""
    for seed in range(12):
        rows = [(7 * i - 50, 7 * j - 50, w) for i, j, w in random_net(40, 0.15, seed, low, high)] + [(6, 6, 3), (900, 900, 2)]
        plain = pd.DataFrame(rows, columns=["src", "dst", "weight"])
        numbers = community._Numbers(T.LongType(), T.LongType(), Fraction(seed % 3 + 1, 2))
        twice_m = 2 * max(1, int(plain["weight"].sum()))
        parts = [packed.pack(g.set_axis(["u", "v", "w"], axis=1)) for _, g in plain.groupby(plain["src"] % 3)]
        found = settle_packed(parts, numbers.resolution.denominator * twice_m, numbers.resolution.numerator)
        assert found.values.tolist() == community.settle_components(plain, numbers, twice_m).values.tolist()


@pytest.mark.parametrize("ids", [[-(2**63), -1, 0, 5, 2**63 - 1], list(range(0, 3000, 7)), [4]])
def test_packed_edges_come_back(ids):
    rng = np.random.default_rng(2)
    rows = pd.DataFrame({"u": rng.choice(ids, 500), "v": rng.choice(ids, 500), "w": rng.choice([1, 2, 2**62, -3], 500)})
    net = packed.Packed([packed.pack(rows[:300]), packed.pack(rows[300:])])
    got = [row for u, v, w in net.edges() for row in zip(net.ids[u].tolist(), net.ids[v].tolist(), net.weights[w].tolist())]
    assert sorted(got) == sorted(map(tuple, rows.values.tolist())) and net.many == 500
    starts, ends, codes = net.both_ways()
    both = [(a, b, c) for u, v, c in got if u != v for a, b in ((u, v), (v, u)) if a != b]
    vertex = net.ids[np.repeat(np.arange(len(net.ids)), np.diff(starts))]
    rows = list(zip(vertex.tolist(), net.weights[codes].tolist(), net.ids[ends].tolist()))
    assert rows == sorted((a, c, b) for a, b, c in both)


def test_turns_go_on_while_groups_of_a_class_have_moved(monkeypatch):
    """Groups of a class move at once, so one may gain by what another has done; the turns ended before it was asked again."""
    level, asked = object.__new__(community.Level), []
    level.groups, level.numbers = 4, community._Numbers(T.LongType(), T.LongType(), Fraction(1))
    script = iter([1, 0, 1, 0, 0])
    state = lambda score: SimpleNamespace(score=score, hot=None, discard=lambda: None)
    monkeypatch.setattr(level, "count", lambda start: state(0), raising=False)
    monkeypatch.setattr(level, "moves", lambda near, turn, classes: asked.append(turn) or (None, next(script)), raising=False)
    monkeypatch.setattr(level, "update", lambda near, moves: state(near.score + 1), raising=False)
    near, moved = level.settle(None)
    assert asked == [0, 1, 0, 1, 0] and moved and near.score == 2


@pytest.mark.parametrize("span, star_rows, share", [(5, 50, 0.02), (1 << 17, 1 << 21, 0.02), (200, 70, 0.3), (1 << 17, 1 << 21, 0.6)])
def test_paths_by_length_are_those_by_rounds(monkeypatch, span, star_rows, share):
    """Vertices reached by one length at a time have the distances, and the sums, of sweeps that know no lengths."""
    monkeypatch.setattr(near_paths, "SPAN_EDGES", span)
    for seed, most in enumerate([1, 2, 5]):
        n = 150
        rows = {(i, j): w for i, j, w in [*random_net(n, share, seed, 1, most), *((i, i + 1, 1 + i % most) for i in range(0, n - 1))]}
        data = pd.DataFrame([(i + 1000, j + 1000, w) for (i, j), w in rows.items()], columns=["u", "v", "w"])
        net = packed.Packed([packed.pack(data)])
        starts, ends, codes = net.both_ways()
        part = near_paths._component(n, starts, ends, codes, net.weights)
        assert isinstance(part, near_paths.Layers)
        monkeypatch.setattr(near_paths, "FEW_LENGTHS", 0)
        other = near_paths._component(n, starts, ends, codes, net.weights)
        monkeypatch.undo()
        monkeypatch.setattr(near_paths, "SPAN_EDGES", span)
        assert isinstance(other, near_paths.Component)
        for at in range(0, n, 7):
            d = np.full(n, -1)
            for x, some in part.reach(at)[1].items():
                d[some] = x
            assert d.tolist() == other.distances(at).tolist()
            assert part.dependencies(at) == pytest.approx(other.dependencies(at))
    assert not part.sums.any() and not part.some.any()


def test_betweenness_of_a_large_component_of_few_lengths_stays_in_tasks(edges, monkeypatch):
    """A component beyond what a task holds went in rounds, with a row for each source and vertex."""
    monkeypatch.setattr(centrality, "NEAR_EDGES", 100)
    monkeypatch.setattr(centrality, "ONE_PART", 0)
    made = counted(monkeypatch, centrality, "materialize")
    rows = random_net(40, 0.2, low=1, high=2)
    net = edges(rows)
    assert len(rows) > 100
    assert pairs(centrality.betweenness(net)) == pytest.approx(brute_betweenness(rows))
    assert len(made) < 8
    monkeypatch.setattr(centrality, "in_layers", lambda *a: F.lit(False))
    assert pairs(centrality.betweenness(net)) == pytest.approx(brute_betweenness(rows))


def test_blocks_of_a_pass_are_as_many_as_its_sources_need(edges, monkeypatch):
    """Each pass over a few sources sent all edges to as many tasks as a pass over all sources."""
    for name, value in (("ONE_PART", 0), ("BLOCK_WORK", 200), ("BLOCK_SOURCES", 1), ("CORE_BLOCKS", 6)):
        monkeypatch.setattr(centrality, name, value)
    rows = random_net(40, 0.3)
    net = materialize(edges(rows), "net")
    walks = centrality._Walks(net, "weight", 10, 10)
    walks.cores = 2
    sent, whole = [], centrality.summed_dependencies
    many = walks.places.agg(F.max("blocks")).first()[0]
    assert many == 40 or many == 6 * net.sparkSession.sparkContext.defaultParallelism
    told = net.sparkSession.sparkContext.accumulator(0)
    monkeypatch.setattr(centrality, "summed_dependencies", lambda *a: told.add(1) or whole(*a))
    for share, most in ((1.0, many), (0.1, math.ceil(many * 0.1)), (0.0, 2)):
        before = told.value
        walks.near_sums(lambda rows: rows, share)
        sent.append((told.value - before, most))
    assert all(0 < got <= most for got, most in sent)


def test_few_communities_settle_as_many_do(monkeypatch):
    """Vertices that stay were asked one by one in each pass; looked at together, they lead to the same labels."""
    asked = []
    monkeypatch.setattr(near_communities, "_descend_few", lambda *a, f=near_communities._descend_few: asked.append(1) or f(*a))
    for seed in range(6):
        rows = pd.DataFrame([*random_net(300, 0.05, seed, 1, 1 + seed), (7, 7, 3), (900, 900, 2)], columns=["u", "v", "w"])
        found = []
        for few in (0, 64):
            monkeypatch.setattr(near_communities, "FEW_LABELS", few)
            found.append(near_communities.settle_packed([packed.pack(rows)], 2 * int(rows["w"].sum()), 1))
            assert bool(asked) == bool(few)
        asked.clear()
        assert found[0].equals(found[1])


def test_sources_of_a_pass_are_dealt_to_all_blocks(edges, monkeypatch):
    """Passes and blocks were dealt by the same hash, so in one of two passes every second block had no sources."""
    for name, value in (("ONE_PART", 0), ("BLOCK_WORK", 200), ("BLOCK_SOURCES", 1)):
        monkeypatch.setattr(centrality, name, value)
    net = materialize(edges(random_net(40, 0.3)), "net")
    walks = centrality._Walks(net, "weight", 10, 10)
    walks.cores, whole = 4, centrality.summed_dependencies
    used = net.sparkSession.sparkContext.accumulator(0)
    monkeypatch.setattr(centrality, "summed_dependencies", lambda rows, sources, one: used.add(len(sources) > 0) or whole(rows, sources, one))
    walks.near_sums(lambda rows: rows.filter(F.pmod(F.xxhash64("s"), F.lit(2)) == 0), 0.0)
    assert used.value == 4
