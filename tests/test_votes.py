import random
from collections import Counter
from itertools import combinations

import pytest

from plenum.operators import votes
from plenum.session import materialize
from tests.conftest import rows

BALLOTS = "voting bigint, member bigint, vote string"


def brute_force(ballots, min_minority=None):
    by_voting, weight = {}, Counter()
    for voting, member, vote in ballots:
        by_voting.setdefault(voting, []).append((member, vote))
    for cast in by_voting.values():
        counts = Counter(vote for _, vote in cast)
        if min_minority is not None and len(cast) - max(counts.values()) < min_minority:
            continue
        for (a, va), (b, vb) in combinations(sorted(cast, key=lambda c: c[0]), 2):
            if va is not None and va == vb:
                weight[a, b] += 1
    return sorted((a, b, w) for (a, b), w in weight.items())


@pytest.fixture(scope="module")
def uneven(spark):
    """One voting holds a third of all ballots, one is unanimous and large, most are small."""
    rng = random.Random(3)
    data = [(0, m, rng.choice("YYYN")) for m in range(120)] + [(1, m, "Y") for m in range(60)]
    for voting in range(2, 40):
        data += [(voting, m, rng.choice(["Y", "N", "A", None])) for m in rng.sample(range(120), 5)]
    data += [(voting, m, rng.choice("YN")) for voting in range(40, 140) for m in rng.sample(range(120), 3)]
    return data, materialize(spark.createDataFrame(data, BALLOTS), "uneven")


def test_only_contested_votings_count(spark):
    data = [(1, 1, "Y"), (1, 2, "Y"), (1, 3, "N"), (2, 1, "Y"), (2, 2, "Y"), (2, 3, "Y"), (3, 1, "N"), (3, 2, "N"), (3, 3, "N")]
    ballots = spark.createDataFrame(data, BALLOTS)
    assert rows(votes.relevant_votings(ballots)) == [(1, 1, "Y"), (1, 2, "Y"), (1, 3, "N")]
    assert rows(votes.agreement_edges(ballots, 1)) == [(1, 2, 1)]
    assert rows(votes.agreement_edges(votes.relevant_votings(ballots))) == [(1, 2, 1)]


@pytest.mark.parametrize(
    "options",
    [
        {},  # all groups light
        {"tile": 4, "floor": 4},  # member tiles, hot votings split
        {"tile": 16, "dense_from": 8},  # dense groups as bits, the rest light
        {"tile": 4, "dense_from": 30, "floor": 4},  # all three ways at once
        {"tile": 1000, "dense_from": 2},
    ],
)
def test_every_way_counts_all_agreements(uneven, options):
    data, ballots = uneven
    assert rows(votes.agreement_edges(ballots, 1, **options)) == sorted(brute_force(data, 1), key=repr)


def test_words_of_more_than_64_groups(spark, monkeypatch):
    monkeypatch.setattr(votes, "WORDS_PER_BIN", 2)
    rng = random.Random(5)
    data = [(v, m, rng.choice("YN")) for v in range(150) for m in range(9)]
    ballots = materialize(spark.createDataFrame(data, BALLOTS), "dense")
    found = votes.agreement_edges(ballots, tile=3, dense_from=2)
    assert rows(found) == sorted(brute_force(data), key=repr)


def test_relevant_votings_with_hot_voting(uneven):
    data, ballots = uneven
    kept = {r["voting"] for r in votes.relevant_votings(ballots, 2, floor=3).select("voting").distinct().collect()}
    counts = {}
    for voting, _, vote in data:
        counts.setdefault(voting, Counter())[vote] += 1
    assert kept == {v for v, c in counts.items() if sum(c.values()) - max(c.values()) >= 2}
    assert votes.relevant_votings(ballots, 2, floor=3).count() == sum(sum(counts[v].values()) for v in kept)


def test_repeated_ballots_become_one(spark):
    raw = spark.createDataFrame([(1, 7, "A"), (1, 7, "N"), (1, 8, "A")], "o bigint, s bigint, f string")
    assert rows(votes.ballots_from(raw, "o", "s", "f")) == [(1, 7, "N"), (1, 8, "A")]


def test_durable_edges(edges):
    net = edges([(1, 2, 1), (1, 3, 2), (1, 4, 3), (2, 3, 4), (2, 4, 9)])
    assert rows(votes.durable_edges(net, min_weight=3)) == [(1, 4, 3), (2, 3, 4), (2, 4, 9)]
    assert rows(votes.durable_edges(net)) == [(2, 3, 4), (2, 4, 9)]
    assert rows(votes.durable_edges(net, quantile=0.0)) == rows(net)
    assert rows(votes.durable_edges(edges([]))) == []


def test_unknown_party_has_no_ideology(spark):
    members = spark.createDataFrame([(1, "a", "P"), (2, "b", "?"), (3, "c", None)], "id bigint, nome string, partido string")
    parties = spark.createDataFrame([("P", "left")], "partido string, ideologia string")
    expected = [(1, "a", "P", "left"), (2, "b", "?", None), (3, "c", None, None)]
    assert rows(votes.label_vertices(members, parties)) == expected
    many = members.union(spark.createDataFrame([(10 + i, "m", "P" if i % 2 else None) for i in range(40)], members.schema))
    labelled = rows(votes.label_vertices(many, parties, floor=5))
    assert len(labelled) == 43 and sum(r[3] == "left" for r in labelled) == 21


LANES = [{}, {"tile": 4, "floor": 4}, {"tile": 16, "dense_from": 8}]


@pytest.mark.parametrize("options", LANES)
def test_ballots_without_member_or_voting_count_in_no_lane(spark, options):
    data = [(1, m, "Y") for m in range(12)] + [(1, None, "Y"), (1, 99, "N"), (None, 1, "Y"), (None, 2, "Y")]
    found = rows(votes.agreement_edges(spark.createDataFrame(data, BALLOTS), 1, **options))
    assert found == sorted(((a, b, 1) for a, b in combinations(range(12), 2)), key=repr)


@pytest.mark.parametrize("options", LANES)
def test_repeated_ballots_count_once_in_every_lane(spark, options):
    data = [(1, m, "Y") for m in range(6)] + [(1, 0, "Y"), (1, 1, "A"), (1, 99, "N")]
    found = rows(votes.agreement_edges(spark.createDataFrame(data, BALLOTS), 1, **options))
    assert found == sorted(((a, b, 1) for a, b in combinations(range(6), 2)), key=repr)


@pytest.mark.parametrize("options", LANES)
def test_least_weight_is_the_same_before_and_after_pairing(uneven, options):
    data, ballots = uneven
    expected = [e for e in brute_force(data, 1) if e[2] >= 2]
    assert expected and rows(votes.agreement_edges(ballots, 1, 2, **options)) == sorted(expected, key=repr)


def test_ballots_are_summed_by_hash(spark):
    data = spark.createDataFrame([(1, 1, "Y"), (1, 1, "Z"), (1, 2, None), (2, 1, "Ä"), (2, 1, "z")], BALLOTS)
    reduced = votes.ballots_from(data, "voting", "member", "vote")
    assert rows(reduced) == [(1, 1, "Z"), (1, 2, None), (2, 1, "Ä")]
    assert "SortAggregate" not in reduced._jdf.queryExecution().toString()


def test_ballots_are_dealt_by_their_number_and_reduced_once(spark, monkeypatch):
    """What a task holds doesn't grow with the rows, and a frame that is reduced isn't reduced a second time."""
    monkeypatch.setattr(votes, "BALLOT_ROWS", 20)
    data = [(v, m, x) for v in range(40) for m in range(5) for x in ("N", "Y")[: 1 + (v + m) % 2]] + [(1, 2, None), (None, 1, "Y"), (50, 1, None)]
    reduced = votes.ballots_from(spark.createDataFrame(data, BALLOTS), "voting", "member", "vote")
    expected = [(v, m, "NY"[(v + m) % 2]) for v in range(40) for m in range(5)] + [(50, 1, None)]
    assert rows(reduced) == sorted(expected, key=repr)
    assert reduced.rdd.getNumPartitions() >= (len(data) - 1) / 20
    monkeypatch.setattr(votes, "ballots_from", None)
    assert rows(votes.agreement_edges(reduced)) == sorted(brute_force(expected), key=repr)
