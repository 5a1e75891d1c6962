"""Communities by maximising modularity.

The Louvain scheme of Blondel et al. (2008) in parallel. Vertices are dealt into groups of bounded size. A turn lets
the vertices of some groups move, one after the other inside a group and all these groups at once, while all others
stand still. What a vertex needs to know, its weight towards each community around it, is kept from turn to turn and
changed only by the edges of vertices that have moved; edges and these weights are bucketed, so neither is shuffled.
Whole and decimal weights are compared exactly: a move counts if it raises the modularity at all.

A vertex gains nothing by a community it has no edge to, so components are settled apart from each other: those that a
task can hold inside tasks, packed if their weights are whole numbers (:mod:`plenum.operators.near_communities`), only
larger ones in turns.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plenum.functions.numbering import number_rows
from plenum.operators.graph import components, symmetric_edges, vertex_ids
from plenum.operators.near_communities import settle_packed
from plenum.operators.packed import CHUNK_EDGES, chunk, packed
from plenum.session import discard, materialize, store_bucketed
from plenum.skew import HOT_FLOOR, hot_keys, salted_join

# Directed edges per bucket on a large network, and the fewest that make a bucket of their own.
BUCKET_EDGES, LEAST_EDGES = 2_000_000, 60_000
# Communities whose strengths every task gets (three numbers each); more of them are joined by shuffle.
BROADCAST_GROUPS = 1_000_000
# Vertices, and weights towards communities, of one group, about; one task holds a group.
GROUP, GROUP_ROWS = 500, 500_000
# Directed edges of a component that one task settles packed, with whole weights (some 15 bytes each at the peak).
PACKED_ROWS = 48_000_000
# Weights that aren't exact: part of two gains by which rounding may let them differ.
ROUNDING = 1e-12


@dataclass(frozen=True)
class _Numbers:
    """How weights are counted: the type of weights, that of products, and the resolution as a fraction."""

    weight: T.DataType
    product: T.DataType
    resolution: Fraction

    @property
    def exact(self) -> bool:
        return not isinstance(self.product, T.DoubleType)

    def gain(self, inner: Column, k: Column, total: Column, twice_m) -> Column:
        """What a vertex of strength ``k`` adds to a community of strength ``total``, times (2m)^2 over 2 and a constant."""
        p, q = self.resolution.numerator, self.resolution.denominator
        if not self.exact:
            return inner * F.lit(float(twice_m)) - F.lit(float(self.resolution)) * k * total
        whole = self.product
        return (inner.cast(whole) * F.lit(Decimal(q * twice_m)).cast(whole)).cast(whole) - (
            (k.cast(whole) * F.lit(Decimal(p)).cast(whole)).cast(whole) * total.cast(whole)).cast(whole)

    def above(self, a: Column, b: Column) -> Column:
        return a > b if self.exact else a - b > ROUNDING * (F.abs(a) + F.abs(b))

    def score(self, inner, squares, twice_m):
        """Modularity times (2m)^2 and a constant."""
        if not self.exact:
            return float(inner) * twice_m - float(self.resolution) * float(squares)
        return self.resolution.denominator * int(inner) * twice_m - self.resolution.numerator * int(squares)

    def rises(self, after, before) -> bool:
        return after > before if self.exact else after - before > ROUNDING * (abs(after) + abs(before))


def whole_weights(edges: DataFrame) -> DataFrame:
    """``src, dst, weight`` with decimal weights as whole multiples of their last digit; others as they are."""
    kind = edges.schema["weight"].dataType
    weight = F.col("weight")
    if isinstance(kind, T.DecimalType):
        weight = (weight * F.lit(Decimal(10**kind.scale))).cast("decimal(38,0)")
    elif isinstance(kind, T.IntegralType):
        weight = weight.cast("bigint")
    return edges.select("src", "dst", weight.alias("weight"))


def _numbers(edges: DataFrame, resolution: float) -> _Numbers:
    """Whole numbers if all products fit them, else decimals, else doubles with a bound on their rounding."""
    ratio = Fraction(str(resolution))
    if not isinstance(edges.schema["weight"].dataType, (T.LongType, T.DecimalType)):
        return _Numbers(T.DoubleType(), T.DoubleType(), ratio)
    total = edges.agg(F.sum(F.abs(F.col("weight").cast("decimal(38,0)")))).first()[0] or 0
    largest = 4 * int(total) ** 2 * max(ratio.numerator, ratio.denominator)
    if largest < 1 << 62:
        return _Numbers(T.LongType(), T.LongType(), ratio)
    if largest < 10**37:
        return _Numbers(T.DecimalType(38, 0), T.DecimalType(38, 0), ratio)
    return _Numbers(T.DoubleType(), T.DoubleType(), ratio)


def _strengths(edges: DataFrame) -> DataFrame:
    """Per vertex: strength ``k`` with self-loops twice, weight of its own ``loop``, and ``degree`` in rows."""
    loop, kind = F.col("src") == F.col("dst"), edges.schema["weight"].dataType
    return (
        symmetric_edges(edges)
        .groupBy(F.col("src").alias("id"))
        .agg(
            F.sum(F.when(loop, F.col("weight") * 2).otherwise(F.col("weight"))).cast(kind).alias("k"),
            F.sum(F.when(loop, F.col("weight")).otherwise(0)).cast(kind).alias("loop"),
            F.count(F.lit(1)).alias("degree"),
        )
    )


def _counted(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows stored, and their number, found on the way."""
    seen = Observation()
    stored = materialize(rows.observe(seen, F.count(F.lit(1)).alias("rows")), "moves")
    return stored, seen.get["rows"]


def _descend(near: dict, total: dict, home: dict, strength: dict, inside: dict, numbers: _Numbers, twice_m) -> None:
    """Move vertices one after the other until none gains; ``near``, ``total`` and ``home`` change with each move."""
    p, q = numbers.resolution.numerator, numbers.resolution.denominator
    scale = q * twice_m if numbers.exact else float(twice_m)
    cost = p if numbers.exact else float(numbers.resolution)
    moving = True
    while moving:
        moving = False
        for i in sorted(home):
            here, k = home[i], strength[i]
            price = cost * k
            stay = scale * near[i].get(here, 0) - price * (total[here] - k)
            best, there = stay, here
            for label, weight in near[i].items():
                if label != here and weight:
                    gain = scale * weight - price * total[label]
                    if gain > best or (gain == best and there != here and label < there):
                        best, there = gain, label
            if there == here or not numbers.rises(best, stay):
                continue
            home[i] = there
            total[here] -= k
            total[there] += k
            for j, weight in inside.get(i, ()):
                sums = near[j]
                sums[here] = sums.get(here, 0) - weight
                sums[there] = sums.get(there, 0) + weight
            moving = True


def settle_group(rows: pd.DataFrame, links: pd.DataFrame, numbers: _Numbers, twice_m) -> pd.DataFrame:
    """Moves ``id, k, label, new_label`` after which no vertex of a group gains by moving, given all others.

    ``rows`` are ``id, label, weight, own, k, total`` per vertex and community around it, ``links`` the edges inside
    the group. One vertex after the other goes where it gains most, of equal gains to the smallest label, if it gains
    by going at all; each move raises the modularity, which ends it. Whole numbers are Python's, of any size.
    """
    number = int if numbers.exact else float
    near: dict[int, dict[int, object]] = {}
    total: dict[int, object] = {}
    home, strength = {}, {}
    for i, label, weight, own, k, whole in zip(*(rows[c].tolist() for c in ("id", "label", "weight", "own", "k", "total"))):
        near.setdefault(i, {})[label] = number(weight)
        total[label] = number(whole)
        if own:
            home[i], strength[i] = label, number(k)
    inside: dict[int, list] = {}
    for i, j, weight in zip(*(links[c].tolist() for c in ("src", "dst", "weight"))):
        inside.setdefault(i, []).append((j, number(weight)))
    first = dict(home)
    _descend(near, total, home, strength, inside, numbers, twice_m)
    moved = [(i, strength[i], first[i], label) for i, label in sorted(home.items()) if label != first[i]]
    return pd.DataFrame(moved, columns=["id", "k", "label", "new_label"])


def _settled(around: dict[int, dict], strength: dict, start: dict, numbers: _Numbers, twice_m) -> dict:
    """Labels of all vertices after which none gains by moving, from the labels ``start``."""
    near, total, home = {}, {}, dict(start)
    for i, label in start.items():
        total[label] = total.get(label, 0) + strength[i]
        sums = near[i] = {}
        for j, weight in around[i].items():
            sums[start[j]] = sums.get(start[j], 0) + weight
    _descend(near, total, home, strength, {i: list(ends.items()) for i, ends in around.items()}, numbers, twice_m)
    return home


def _contracted(around: dict[int, dict], strength: dict, labels: dict) -> tuple[dict, dict]:
    """Network of communities: the weights between them, and their strengths."""
    upper, sums = {c: {} for c in sorted(set(labels.values()))}, {}
    for i, home in labels.items():
        sums[home] = sums.get(home, 0) + strength[i]
        ends = upper[home]
        for j, weight in around[i].items():
            if labels[j] != home:
                ends[labels[j]] = ends.get(labels[j], 0) + weight
    return upper, sums


def settle_components(links: pd.DataFrame, numbers: _Numbers, twice_m) -> pd.DataFrame:
    """``id, label`` of whole components, from their edges ``src, dst, weight``, after which no vertex gains by moving
    and no community by joining another, as :func:`louvain` has it.
    """
    number = int if numbers.exact else float
    around, strength = {}, {}
    links = links.sort_values(["src", "dst", "weight"])
    for i, j, weight in zip(*(links[c].tolist() for c in ("src", "dst", "weight"))):
        weight = number(weight)
        for one, two in ((i, j), (j, i)):
            strength[one] = strength.get(one, 0) + weight  # a self-loop counts twice
            ends = around.setdefault(one, {})
            if i != j:
                ends[two] = ends.get(two, 0) + weight
    labels, rising = {i: i for i in sorted(around)}, True
    while rising:
        labels, rising = _settled(around, strength, labels, numbers, twice_m), False
        upper, sums = _contracted(around, strength, labels)
        while True:
            start = {c: c for c in upper}
            found = _settled(upper, sums, start, numbers, twice_m)
            if found == start:
                break
            rising, labels = True, {i: found[c] for i, c in labels.items()}
            upper, sums = _contracted(upper, sums, found)
    return pd.DataFrame(sorted(labels.items()), columns=["id", "label"])


class Near:
    """What vertices know: ``id, label, weight, own, k``, a row for each vertex and community around it or its own.

    ``weight`` leads from the vertex to the community, ``own`` is 1 in the row of the vertex's own community, which
    also holds its strength ``k``, and 0 elsewhere. ``cold`` is bucketed by vertex; ``hot`` holds the rows of hubs,
    whose sums are spread by vertex and community. ``groups`` has ``label, total, size`` of each community.
    """

    def __init__(self, cold: DataFrame, hot: DataFrame | None, groups: DataFrame, score):
        self.cold, self.hot, self.groups, self.score = cold, hot, groups, score

    def rows(self) -> DataFrame:
        return self.cold if self.hot is None else self.cold.unionByName(self.hot)

    def labels(self) -> DataFrame:
        """``id, label, k`` of each vertex."""
        return self.rows().filter("own = 1").select("id", "label", "k")

    def discard(self) -> None:
        discard(self.cold, self.hot, self.groups)


class Level:
    """One network of the hierarchy: its edges, and the sums that do not change while vertices move."""

    def __init__(self, edges: DataFrame, numbers: _Numbers, floor: int, group: int = GROUP, twice_m=None):
        self.numbers, self.floor = numbers, floor
        self.number = int if numbers.exact else float
        self.edges = edges.select("src", "dst", F.col("weight").cast(numbers.weight).alias("weight"))
        self.nodes = materialize(_strengths(self.edges), "level-nodes")
        self.n, strength, loops, rows = self.nodes.agg(
            F.count(F.lit(1)), F.sum("k"), F.sum("loop"), F.sum("degree")).first()
        # of a part of a network it is that of all
        self.twice_m, self.loops = self.number(strength or 0) if twice_m is None else twice_m, self.number(loops or 0)
        self.hubs = hot_keys(self.nodes, ["id"], "degree", floor)
        rows = int(rows or 0)
        parallel = self.nodes.sparkSession.sparkContext.defaultParallelism
        self.buckets = max(1, min(50_000, max(rows // BUCKET_EDGES, min(parallel, rows // LEAST_EDGES))))
        self.groups = max(1, -(-self.n // group), -(-rows // GROUP_ROWS))
        both = symmetric_edges(self.edges).filter("src <> dst")
        to_cold, to_hubs = self.apart(both, "dst")
        self.by_dst = store_bucketed(to_cold.repartition(self.buckets, "dst"), "level-edges", "dst", self.buckets)
        self.to_hubs = None if to_hubs is None else materialize(to_hubs, "level-hub-edges")

    def apart(self, rows: DataFrame, end: str) -> tuple[DataFrame, DataFrame | None]:
        """Rows whose ``end`` is no hub, and the others. The list of hubs is short: each has its share of all edges."""
        if self.hubs is None:
            return rows, None
        hubs = F.broadcast(self.hubs.select(F.col("id").alias(end)))
        return rows.join(hubs, end, "left_anti"), rows.join(hubs, end, "left_semi")

    def discard(self) -> None:
        discard(self.nodes, self.by_dst, self.to_hubs, self.hubs)

    def across(self, values: DataFrame) -> DataFrame:
        """Directed edges ``src, dst, weight`` with the columns of ``values`` for ``dst``; edges to others are left out."""
        values = values.withColumnRenamed("id", "dst")
        seen = self.by_dst.join(values, "dst")
        if self.to_hubs is not None:
            some = values.join(F.broadcast(self.hubs.select(F.col("id").alias("dst"))), "dst", "left_semi")
            seen = seen.unionByName(self.to_hubs.join(F.broadcast(some), "dst"))
        return seen

    def _row(self, label: str, vertex: str, weight: Column, own: int, k: Column) -> Column:
        wide = self.numbers.weight
        return F.struct(F.col(vertex).alias("id"), F.col(label).alias("label"), weight.cast(wide).alias("weight"),
                        F.lit(own).cast("long").alias("own"), k.cast(wide).alias("k"))

    def _summed(self, before: Near | None, more: DataFrame) -> Near:
        """State after rows ``id, label, weight, own, k`` have come in; only these rows are shuffled.

        Two jobs write the weights and the strengths of communities, and tell the score on the way.
        """
        wide, product = self.numbers.weight, self.numbers.product
        inner, squares = [], Observation()

        def total(rows: DataFrame) -> DataFrame:
            found = rows.groupBy("id", "label").agg(
                F.sum("weight").cast(wide).alias("weight"), F.sum("own").alias("own"), F.sum("k").cast(wide).alias("k"))
            inner.append(Observation())
            return found.filter((F.col("weight") != 0) | (F.col("own") != 0)).observe(
                inner[-1], F.sum(F.when(F.col("own") == 1, F.col("weight")).cast(product)).alias("inner"))

        cold, hot = self.apart(more, "id")
        cold = cold.repartition(self.buckets, "id")
        if before is not None:
            cold = before.cold.unionByName(cold)
            hot = None if hot is None else before.hot.unionByName(hot)
        near = Near(store_bucketed(total(cold), "near", "id", self.buckets),
                    None if hot is None else materialize(total(hot), "near-hubs"), None, None)
        groups = near.rows().filter("own = 1").groupBy("label").agg(F.sum("k").cast(wide).alias("total"), F.count(F.lit(1)).alias("size"))
        square = (F.col("total").cast(product) * F.col("total").cast(product)).cast(product)
        near.groups = materialize(groups.observe(squares, F.sum(square).alias("squares")), "groups")
        near.groups.many = self.n > BROADCAST_GROUPS
        weights = sum(self.number(seen.get["inner"] or 0) for seen in inner)
        near.score = self.numbers.score(weights + 2 * self.loops, squares.get["squares"] or 0, self.twice_m)
        return near

    def count(self, labels: DataFrame) -> Near:
        """State for ``labels`` (``id, label``), counted anew from all edges."""
        placed = labels.select("id", "label").join(self.nodes.select("id", "k"), "id")
        w, none = F.col("weight"), F.lit(0)
        around = self.across(labels.select("id", "label")).select(F.inline(F.array(self._row("label", "src", w, 0, none))))
        return self._summed(None, around.unionByName(placed.select(F.inline(F.array(self._row("label", "id", none, 1, F.col("k")))))))

    def update(self, near: Near, moves: DataFrame) -> Near:
        """State after ``moves`` (``id, k, label, new_label``): the edges of these vertices change side."""
        w, k, none = F.col("weight"), F.col("k"), F.lit(0)
        edges = self.across(moves.select("id", "label", "new_label")).select(
            F.inline(F.array(self._row("label", "src", -w, 0, none), self._row("new_label", "src", w, 0, none))))
        homes = moves.select(F.inline(F.array(self._row("label", "id", none, -1, -k), self._row("new_label", "id", none, 1, k))))
        return self._summed(near, edges.unionByName(homes))

    def with_totals(self, rows: DataFrame, near: Near) -> DataFrame:
        """Rows with the strength of their community. It is sent to all tasks, or joined by shuffle with hot labels split."""
        totals = near.groups.select("label", "total")
        if not near.groups.many:
            return rows.join(F.broadcast(totals), "label")
        return salted_join(rows, totals, ["label"], spread=["id"], floor=self.floor)

    def moves(self, near: Near, turn: int, classes: int) -> tuple[DataFrame, int]:
        """``id, k, label, new_label``: how the groups of one class settle while all else stands still; stored and counted.

        """
        numbers, twice_m, wide = self.numbers, self.twice_m, self.numbers.weight

        def dealt(end: str) -> Column:
            return F.pmod(F.xxhash64(end), F.lit(self.groups)).cast("int")

        some = near.cold.withColumn("g", dealt("id")).filter(F.pmod("g", F.lit(classes)) == turn)
        rows = self.with_totals(some, near)
        links = self.by_dst.withColumn("g", dealt("src")).filter(
            (F.pmod("g", F.lit(classes)) == turn) & (F.col("g") == dealt("dst")))

        def settle(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
            found = settle_group(one, two, numbers, twice_m)
            if isinstance(wide, T.DecimalType):
                found["k"] = found["k"].map(Decimal)
            return found

        schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("k", wide),
                               T.StructField("label", T.LongType()), T.StructField("new_label", T.LongType())])
        return _counted(rows.groupBy("g").cogroup(links.groupBy("g")).applyInPandas(settle, schema))

    def _hub_moves(self, near: Near) -> DataFrame:
        """Moves of hubs, whose many rows no task need hold: each goes where it gains most."""
        numbers = self.numbers
        own = self.with_totals(near.hot.filter("own = 1"), near).select(
            "id", "k", F.col("label").alias("home"), (F.col("total") - F.col("k")).alias("rest"), F.col("weight").alias("inner"))
        stay = numbers.gain(F.col("inner"), F.col("k"), F.col("rest"), self.twice_m)
        there = self.with_totals(near.hot.filter("own = 0").drop("k"), near).join(F.broadcast(own), "id")
        gain = numbers.gain(F.col("weight"), F.col("k"), F.col("total"), self.twice_m)
        best = there.withColumn("gain", gain).withColumn("stay", stay).filter(numbers.above(F.col("gain"), F.col("stay"))).groupBy("id").agg(
            F.max(F.struct("gain", (-F.col("label")).alias("minus_label"))).alias("best"))
        return best.join(F.broadcast(own), "id").select(
            "id", "k", F.col("home").alias("label"), (-F.col("best.minus_label")).alias("new_label"))

    def settle(self, start: DataFrame) -> tuple[Near, bool]:
        """Move vertices from the labels ``start`` until no move pays: the state then, and whether any has moved.

        Classes of groups take turns; at first every second group moves. Moves that don't raise the modularity
        together are taken back and there are twice as many classes from then on. At the finest a class is one group,
        whose moves do raise it. When every class has had its turn and nothing has moved since, no move pays. The
        modularity rises with each turn that counts and there are finitely many partitions: that ends it, not a limit
        on turns.
        """
        near, moved = self.count(start), False
        classes = min(2, self.groups)
        hub_parts, turn, quiet = 1, 0, 0
        while quiet < classes + (near.hot is not None):
            if turn == classes and near.hot is not None:
                moves, count = self._some_hubs(near, hub_parts)
            else:
                moves, count = self.moves(near, turn, classes)
            after = self.update(near, moves) if count else None
            discard(moves)
            if after is not None and not self.numbers.rises(after.score, near.score):
                after.discard()
                if turn == classes:
                    hub_parts *= 2
                else:
                    classes, turn, quiet = min(2 * classes, self.groups), 0, 0
                continue
            hub_turn, hub_parts = turn == classes, 1
            if after is not None:
                near.discard()
                near, moved = after, True
                quiet = 0
            # a group that has settled stays so until others move: others of its class have, if it has any; hubs have moved once only
            quiet += not count or not hub_turn and classes == self.groups
            turn = 0 if hub_turn and not count else turn if hub_turn else (turn + 1) % (classes + (near.hot is not None))
        return near, moved

    def _some_hubs(self, near: Near, parts: int) -> tuple[DataFrame, int]:
        """Moves of hubs, stored and counted; of ``parts`` parts only that of the smallest hub that gains, the hub alone in the end."""
        moves, count = _counted(self._hub_moves(near))
        if parts == 1:
            return moves, count
        share = F.pmod(F.xxhash64("id"), F.lit(parts))
        first = moves.agg(F.min(F.struct("id", share.alias("part")))).first()[0]
        one = _counted(moves.filter((share == first["part"]) & ((F.lit(parts) < 1 << 20) | (F.col("id") == first["id"]))))
        discard(moves)
        return one

    def contract(self, near: Near) -> DataFrame:
        """Network of communities: weights between them summed, inner weights as self-loops. No edge is shuffled."""
        kind = self.numbers.weight

        def home(rows: DataFrame) -> DataFrame:
            return rows.filter("own = 1").select("id", F.col("label").alias("home"))

        pairs = near.cold.join(home(near.cold), "id")
        if near.hot is not None:
            pairs = pairs.unionByName(near.hot.join(F.broadcast(home(near.hot)), "id"))
        summed = pairs.filter(F.col("home") <= F.col("label")).groupBy("home", "label").agg(F.sum("weight").cast(kind).alias("weight"))
        # an inner edge has been met from both of its ends, one between two communities once on this side
        inner = F.expr("weight div 2").cast(kind) if self.numbers.exact else F.col("weight") / 2
        links = summed.select(F.col("home").alias("src"), F.col("label").alias("dst"),
                              F.when(F.col("home") == F.col("label"), inner).otherwise(F.col("weight")).alias("weight"))
        own = near.labels().select("id", "label")
        loops = self.nodes.filter("loop <> 0").join(own, "id").groupBy("label").agg(F.sum("loop").cast(kind).alias("weight")).select(
            F.col("label").alias("src"), F.col("label").alias("dst"), "weight")
        return materialize(links.unionByName(loops).groupBy("src", "dst").agg(F.sum("weight").cast(kind).alias("weight")), "contracted")


def _merge_communities(level: Level, near: Near) -> DataFrame | None:
    """``label, upper``: what communities become when they move as vertices of ever smaller networks; None if none moves."""
    members = None
    edges = level.contract(near)
    while True:
        upper = Level(edges, level.numbers, level.floor, twice_m=level.twice_m)
        found, moved = upper.settle(upper.nodes.select("id", F.col("id").alias("label")))
        after = None
        if moved:
            step = found.labels()
            if members is None:
                grown = step.select(F.col("id").alias("label"), F.col("label").alias("upper"))
            else:
                inner = step.select(F.col("id").alias("upper"), F.col("label").alias("next"))
                sizes = members.groupBy("upper").agg(F.count(F.lit(1)).alias("_rows"))
                grown = salted_join(members, inner, ["upper"], sizes=sizes, floor=level.floor).select("label", F.col("next").alias("upper"))
            grown = materialize(grown, "members")
            discard(members)
            members, after = grown, upper.contract(found)
        found.discard()
        upper.discard()
        discard(edges)
        if not moved:
            return members
        edges = after


def _settle_near(edges: DataFrame, numbers: _Numbers, twice_m, near_rows: int, floor: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Labels of the components of at most ``near_rows`` directed edges, stored, and the stored edges of the others.

    Components are dealt to parts of about a fourth of ``GROUP_ROWS``, larger ones to parts of their own, each settled in one
    task. Either is None if there is none.
    """
    links, part_rows = edges.count(), min(near_rows, GROUP_ROWS)
    rows, placed = 2 * links, None
    if rows <= part_rows:
        near, far, n_parts = edges.withColumn("part", F.lit(0).cast("bigint")).withColumn("_rows", F.lit(links)), None, 1
    else:
        ends = edges.filter("src <> dst")
        roots = components(ends)
        placed = salted_join(edges, roots.toDF("src", "root"), ["src"], "left", spread=["dst"], floor=floor)
        placed = materialize(placed.select("src", "dst", "weight", F.coalesce("root", "src").alias("root")), "placed")
        held = placed.groupBy("root").agg(F.count(F.lit(1)).alias("_rows"))
        small = F.col("_rows") * 8 <= part_rows
        held = materialize(held.withColumn("near", F.col("_rows") * 2 <= near_rows).withColumn("small", small), "held")
        rows, small_rows, n_own, n_far = held.agg(
            F.sum(F.when(F.col("near"), F.col("_rows") * 2)), F.sum(F.when(F.col("near") & F.col("small"), F.col("_rows") * 2)),
            F.count_if(F.col("near") & ~F.col("small")), F.count_if(~F.col("near"))).first()
        parts = max(1, -(-4 * (small_rows or 0) // max(1, part_rows)))
        n_parts = parts + n_own
        part = F.when(F.col("small"), -1 - F.pmod(F.xxhash64("root"), F.lit(parts))).otherwise(F.col("root"))
        # packed rows of a small component are those of a part
        listed = held.select("root", "near", part.alias("part"), F.when(F.col("small"), 1).otherwise(F.col("_rows")).alias("held_rows"))
        marked = salted_join(placed, listed, ["root"], sizes=held, spread=["src", "dst"], floor=floor)
        near, far = marked.filter("near").withColumnRenamed("held_rows", "_rows"), None
        if n_far:
            far = materialize(marked.filter("not near").select("src", "dst", "weight"), "far-edges")
        discard(roots)
    labels = None
    if rows:
        labels = materialize(_settled_parts(near, n_parts, rows, numbers, twice_m), "near-labels")
    if placed is not None:
        discard(placed, held)
    return labels, far


def _settled_parts(near: DataFrame, n_parts: int, rows: int, numbers: _Numbers, twice_m) -> DataFrame:
    """``id, label`` from edges with their ``part``, and ``_rows``, the edges of the part if they may be many."""
    # more tasks than parts, so that hashes seldom deal two parts to one
    tasks = max(1, min(4 * n_parts, 20_000))
    if not isinstance(numbers.product, T.LongType):
        dealt = near.select("part", "src", "dst", "weight").repartition(tasks, "part")
        return dealt.groupBy("part").applyInPandas(
            lambda some: settle_components(some, numbers, twice_m), "id bigint, label bigint")
    scale, cost = numbers.resolution.denominator * twice_m, numbers.resolution.numerator
    chunked = near.select("part", F.col("src").alias("u"), F.col("dst").alias("v"), F.col("weight").alias("w"), "_rows").withColumn(
        "chunk", chunk(F.col("_rows")))
    rows = packed(chunked, ["part"], 4 * (n_parts + rows // CHUNK_EDGES)).select("part", "edges")
    return rows.repartition(tasks, "part").groupBy("part").applyInPandas(
        lambda some: settle_packed(some["edges"], scale, cost), "id bigint, label bigint")


def _settle_far(edges: DataFrame, numbers: _Numbers, twice_m, floor: int) -> DataFrame:
    """Labels, stored, of components that are settled in turns."""
    level = Level(edges, numbers, floor, twice_m=twice_m)
    labels, made = level.nodes.select("id", F.col("id").alias("label")), None
    while True:
        near, _ = level.settle(labels)
        merged = _merge_communities(level, near)
        found = near.labels().select("id", "label")
        if merged is not None:
            found = salted_join(found, merged, ["label"], spread=["id"], floor=floor).select("id", F.col("upper").alias("label"))
        labels = materialize(found, "labels")
        near.discard()
        discard(merged, made)
        made = labels
        if merged is None:
            break
    level.discard()
    return labels


def louvain(
    edges: DataFrame,
    resolution: float = 1.0,
    floor: int = HOT_FLOOR,
    near_rows: int | None = None,
) -> DataFrame:
    """Community ``modularidade`` of each vertex: 0 is the largest, ties in size by smallest vertex.

    ``edges`` are canonical, weighted and stored. Vertices move, then communities as a whole, and then vertices again,
    until neither the move of a vertex nor that of a community to another one raises the modularity. The result does
    not depend on row order or partitioning. Components of at most ``near_rows`` directed edges are settled inside tasks,
    by default as many as a task holds.
    """
    whole = whole_weights(edges)
    numbers = _numbers(whole, resolution)
    if near_rows is None:
        near_rows = PACKED_ROWS if isinstance(numbers.product, T.LongType) else GROUP_ROWS
    whole = whole.select("src", "dst", F.coalesce("weight", F.lit(0)).cast(numbers.weight).alias("weight"))
    number = int if numbers.exact else float
    twice_m = 2 * number(whole.agg(F.sum("weight")).first()[0] or 0)
    if not twice_m:  # no edge, or no weight: every vertex stays alone
        alone = vertex_ids(whole).select("id", F.col("id").alias("label"))
        return number_rows(alone, [F.col("id")], "modularidade").select("id", F.col("modularidade").cast("int").alias("modularidade"))
    near, far = _settle_near(whole, numbers, twice_m, near_rows, floor)
    labels = near
    if far is not None:
        labels = _settle_far(far, numbers, twice_m, floor)
        labels = labels if near is None else labels.unionByName(near)
        discard(far)
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("_rows"), F.min("id").alias("first"))
    ranked = number_rows(sizes, [F.col("_rows").desc(), F.col("first")], "modularidade")
    lookup = ranked.select("label", F.col("modularidade").cast("int").alias("modularidade"))
    return salted_join(labels, lookup, ["label"], sizes=ranked, floor=floor).select("id", "modularidade")


def optimality(edges: DataFrame, membership: DataFrame, label: str, resolution: float = 1.0, floor: int = HOT_FLOOR) -> DataFrame:
    """A certificate of a partition, one row, from its labels alone: ``n_vertices``, ``n_groups``, ``n_gaining_moves``,
    ``n_gaining_merges``.

    The latter two count the vertices that would raise the modularity by going to a community around them, and the
    pairs of linked communities that would by merging; pairs without a link never do. Whole and decimal weights are
    compared exactly. Vertices with a NULL label form one group.
    """
    whole = whole_weights(edges)
    numbers = _numbers(whole, resolution)
    level = Level(whole, numbers, floor)
    # labels of any type, numbered by their smallest vertex
    named = level.nodes.select("id").join(membership.select("id", F.col(label).alias("_name")), "id", "left")
    roots = named.groupBy("_name").agg(F.min("id").alias("label"))
    labels = materialize(named.join(roots, named["_name"].eqNullSafe(roots["_name"])).select("id", "label"), "certified")
    near = level.count(labels)
    own = level.with_totals(near.rows().filter("own = 1"), near).select(
        "id", F.col("label").alias("home"), F.col("k").alias("strength"), F.col("weight").alias("inner"), F.col("total").alias("home_total"))
    around = near.rows().filter("own = 0").select("id", "label", "weight")
    there = level.with_totals(salted_join(around, own, ["id"], spread=["id", "label"], floor=floor), near)
    gain = numbers.gain(F.col("weight"), F.col("strength"), F.col("total"), level.twice_m)
    stay = numbers.gain(F.col("inner"), F.col("strength"), F.col("home_total") - F.col("strength"), level.twice_m)
    moves = there.withColumn("gain", gain).withColumn("stay", stay).groupBy("id").agg(
        F.max(numbers.above(F.col("gain"), F.col("stay"))).alias("gains")).agg(F.count_if("gains").alias("n_gaining_moves"))
    pairs = there.filter(F.col("home") < F.col("label")).groupBy("home", "label").agg(
        F.sum("weight").cast(numbers.weight).alias("weight"), F.first("home_total").alias("one"), F.first("total").alias("two"))
    zero = F.lit(0).cast(numbers.product)
    merge = numbers.gain(F.col("weight"), F.col("one"), F.col("two"), level.twice_m)
    merges = pairs.withColumn("gain", merge).agg(F.count_if(numbers.above(F.col("gain"), zero)).alias("n_gaining_merges"))
    return near.groups.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n_vertices"), F.count(F.lit(1)).alias("n_groups")).select(
        "n_vertices", "n_groups", moves.scalar().alias("n_gaining_moves"), merges.scalar().alias("n_gaining_merges"))
