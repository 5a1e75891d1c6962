"""Betweenness over weighted shortest paths, and bridging centrality.

Components of bounded size are near: blocks of their sources meet the edges of the component, packed, in one task each
(:mod:`plenum.operators.near_paths`); the bound is larger where edges have few different lengths. Components beyond it
follow Brandes (2001) with one relation of (source, vertex) rows instead of one search per source. Walks are extended one
edge per round for all sources at once; dependencies flow back one depth per round. Every round is a join with the edges
and a grouped sum, written to the shared folder, so only row counts reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal
from functools import reduce
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plenum.operators.graph import components, symmetric_edges
from plenum.operators.metrics import bridging_coefficient
from plenum.operators.near_paths import FEW_LENGTHS, SUMS, in_layers, summed_dependencies
from plenum.operators.packed import CHUNK_EDGES, chunk, packed
from plenum.session import discard, materialize
from plenum.skew import HOT_FLOOR, salted_join

# The edges are broadcast only up to this many directed rows of three numbers (well below 100 MB).
BROADCAST_EDGES = 1_000_000
# Directed edges of a component that one task may hold (some 60 bytes each at the peak).
NEAR_EDGES = 12_000_000
# The same of a component whose edges have few different lengths (some 15 bytes each at the peak).
LAYER_EDGES = 48_000_000
# Sources times edges of one task, about; components below a share of it are packed several to a part.
BLOCK_WORK, PACK_SHARE = 500_000_000, 16
# Sources of one task at least, as each task gets all edges of its component, and blocks of a component for each core at most.
BLOCK_SOURCES, CORE_BLOCKS = 512, 4
# A network of at most so many sources times edges is one part: finding its components costs more.
ONE_PART = 1_000_000_000
# Rows that one task pushes along edges, about.
PUSH_ROWS = 500_000
# (source, vertex) rows worked on at a time; more sources than that are taken in several passes.
STATE_ROWS = 20_000_000_000
# Different weights whose reciprocals are brought to one denominator; more have none that fits 38 digits.
MOST_WEIGHTS = 200_000


def inverse_lengths(edges: DataFrame, weight: str = "weight") -> DataFrame:
    """``src, dst, weight`` with one over the weight as length, in whole multiples of one over a common multiple.

    Sums of reciprocals are thus compared exactly. Weights must be positive and whole or decimal. BIGINT where a path
    of all vertices fits it, else DECIMAL(38, 0); a network whose lengths fit neither is refused.
    """
    kind = edges.schema[weight].dataType
    if not isinstance(kind, (T.IntegralType, T.DecimalType)):
        raise ValueError("reciprocals are compared for equality: cast the weight to BIGINT or DECIMAL")
    scale = kind.scale if isinstance(kind, T.DecimalType) else 0
    whole = (F.col(weight) * F.lit(Decimal(10**scale))).cast("decimal(38,0)")
    rows = edges.select("src", "dst", whole.alias("weight"))
    found = rows.filter("weight IS NOT NULL").select("weight").distinct().limit(MOST_WEIGHTS + 1).collect()
    weights = sorted(int(row.weight) for row in found)
    if weights and weights[0] <= 0:
        raise ValueError("weights are inverted to distances and must be positive")
    common, ends = 1, rows.count() + 1  # a shortest path has no more steps than there are edges
    for w in weights if len(weights) <= MOST_WEIGHTS else ():
        common = math.lcm(common, w)
        if common * ends >= 10**38:
            break
    if len(weights) > MOST_WEIGHTS or common * ends >= 10**38:
        raise ValueError("the reciprocals of these weights have no common denominator of 38 digits")
    lengths = edges.sparkSession.createDataFrame(
        [(Decimal(w), Decimal(common // w)) for w in weights], "weight decimal(38,0), length decimal(38,0)")
    exact = F.col("length").cast("bigint" if common * ends < 1 << 62 else "decimal(38,0)")
    # at most MOST_WEIGHTS rows on the right
    return rows.join(F.broadcast(lengths), "weight").select("src", "dst", exact.alias("weight"))


class _Walks:
    """Edges prepared once: packed where components are near, else for pushing (source, vertex) rows from a vertex ``u``
    to its neighbours ``v``.

    ``node`` has all vertices; ``far`` those of components that are not near, with the ``size`` of their component, and
    ``edges`` theirs.
    """

    def __init__(self, edges: DataFrame, weight: str, broadcast_edges: int, floor: int, near_edges: int | None = None):
        kind = edges.schema[weight].dataType
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            raise ValueError("path lengths are compared for equality: cast the weight to BIGINT or DECIMAL")
        self.d_type = T.LongType() if isinstance(kind, T.IntegralType) else T.DecimalType(38, kind.scale)
        both = symmetric_edges(edges.select("src", "dst", F.col(weight).cast(self.d_type).alias("weight")))
        self.both = both = materialize(both.toDF("u", "v", "w"), "walk-edges")
        step = F.col("u") != F.col("v")  # a self-loop is on no shortest path, but its vertex counts
        length = F.when(step, F.col("w"))
        self.all_edges = self.edges = both.filter(step)
        self.node = materialize(
            both.groupBy("u").agg(F.count_if(step).alias("_rows"), F.min(length).alias("nearest"), F.max(length).alias("longest")),
            "walk-nodes",
        )
        self.n, n_edges, least, most = self.node.agg(
            F.count(F.lit(1)), F.sum("_rows"), F.min("nearest"), F.max("longest")).first()
        if least is not None and least <= 0:
            raise ValueError("weights are distances and must be positive")
        self.mean_degree = (n_edges or 0) / max(self.n, 1)
        self.broadcast = (n_edges or 0) <= broadcast_edges
        self.floor = floor
        self.far, self.places, self.packed, self.groups = self.node.withColumn("size", F.lit(self.n)), None, None, 0
        whole = 10 ** (self.d_type.scale if isinstance(self.d_type, T.DecimalType) else 0)
        self.cores = self.node.sparkSession.sparkContext.defaultParallelism
        if n_edges and near_edges != 0 and int(most * whole) * self.n < 1 << 62:
            self._pack(n_edges, near_edges, whole)

    def _pack(self, n_edges: int, near_edges: int | None, whole: int) -> None:
        """Deal near components to parts and blocks, and pack their edges with lengths as whole numbers."""
        linked, more = self.node.filter("_rows > 0"), F.lit(False)
        if near_edges is None:
            near_edges = NEAR_EDGES
            if n_edges > near_edges:
                lengths = self.all_edges.select("w").distinct().limit(FEW_LENGTHS + 1).count()
                more = (F.col("held") <= LAYER_EDGES) & in_layers(F.lit(lengths), F.col("size"), F.col("held"))
        one = n_edges <= near_edges and n_edges * self.n <= ONE_PART
        roots = linked.select("u", F.lit(-1).cast("bigint").alias("root")) if one else components(
            self.all_edges.filter("u < v"), "u", "v").toDF("u", "root")
        held = linked.join(roots, "u")
        sizes = held.groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.sum("_rows").alias("held"))
        work, near = F.col("size") * F.col("held").cast("double"), (F.col("held") <= near_edges) | more
        small = near & (work * PACK_SHARE < BLOCK_WORK)
        blocks = F.ceil(F.least(work / BLOCK_WORK, F.col("size") / BLOCK_SOURCES, F.lit(CORE_BLOCKS * self.cores))).cast("int")
        sizes = materialize(sizes.withColumn("small", small).withColumn("blocks", F.when(near, blocks)), "walk-parts")
        blocks, packed_work, packed_edges, n_far = sizes.agg(
            F.sum(F.when(~F.col("small"), F.col("blocks"))), F.sum(F.when(F.col("small"), work)),
            F.sum(F.when(F.col("small"), F.col("held"))), F.count_if(F.col("blocks").isNull())).first()
        parts = max(1, math.ceil((packed_work or 0) / BLOCK_WORK), math.ceil((packed_edges or 0) / (near_edges / 4)))
        part = F.when(F.col("small"), -1 - F.pmod(F.xxhash64("root"), F.lit(parts))).otherwise(F.col("root"))
        # packed rows of a small component are those of a part
        edges = F.when(F.col("small"), 1).otherwise(F.col("held") / 2)
        places = materialize(held.join(sizes.withColumn("edges", edges), "root").select(
            "u", "_rows", "nearest", "size", "blocks", part.alias("part"), "edges"), "walk-places")
        near = places.filter("blocks IS NOT NULL").select("u", "part", "blocks", "edges")
        length = (F.col("w") * F.lit(whole)).cast("bigint").alias("w")
        ends = self.all_edges.filter("u < v").join(F.broadcast(near) if self.n <= BROADCAST_EDGES else near, "u")
        rows = ends.select("part", "blocks", "u", "v", length, chunk(F.col("edges")).alias("chunk"))
        self.places, self.groups = near.drop("edges"), int(blocks or 0) + (parts if packed_edges else 0)
        self.packed = materialize(packed(rows, ["part", "blocks"], 4 * (self.groups + n_edges // (2 * CHUNK_EDGES))), "walk-packed")
        self.far = places.filter("blocks IS NULL").select("u", "_rows", "nearest", "size") if n_far else None
        self.edges = self.all_edges.join(self.far.select("u"), "u", "left_semi") if n_far else None

    def near_sums(self, mine: Callable[[DataFrame], DataFrame], share: float = 1.0) -> DataFrame | None:
        """``id, raw`` of the sources that ``mine`` picks in near components, about a ``share`` of all; None without such
        components.

        Each block of sources meets all edges of its part, so fewer sources make fewer blocks. There are more tasks than blocks,
        so that hashes seldom deal two blocks to one.
        """
        if self.packed is None:
            return None
        fewer = F.least(F.col("blocks"), F.greatest(F.ceil(F.col("blocks") * share), F.lit(self.cores))).cast("int")
        # by another hash than that of passes, or a pass would leave blocks without sources
        block = F.pmod(F.xxhash64("u", F.lit(1)), fewer).cast("int").alias("block")
        begun = mine(self.places.withColumn("s", F.col("u"))).select("part", block, "u")
        none = F.lit(None).cast("binary")
        sources = begun.mapInPandas(_sources, "part bigint, block int, sources binary").withColumn("edges", none)
        edges = self.packed.select("part", F.explode(F.sequence(F.lit(0), fewer - 1)).alias("block"), none.alias("sources"), "edges")
        dealt = edges.unionByName(sources).repartition(max(1, min(4 * self.groups, 20_000)), "part", "block")
        sums = dealt.groupBy("part", "block").applyInPandas(lambda some: summed_dependencies(
            some["edges"].dropna(), some["sources"].dropna(), some["part"].iloc[0] >= 0), SUMS)
        return materialize(sums.groupBy("id").agg(F.sum("raw").alias("raw")), "near-sums")

    def tasks(self, rows: int) -> int:
        """Partitions for pushing ``rows`` rows: few rows may become many, so their own size is no guide.

        Rows are dealt by source, so there are never more partitions than sources.
        """
        return max(1, min(self.n, math.ceil(rows * self.mean_degree / PUSH_ROWS)))

    def push(self, rows: DataFrame, tasks: int) -> DataFrame:
        """Rows at ``u`` repeated for each edge of ``u``.

        Next to broadcast edges, rows are kept together by source, and all that is pushed for a source and a vertex
        is summed where it arises. Otherwise rows meet the edges of ``u``, and those of a hub are split by source.
        """
        if self.broadcast:
            return rows.repartition(tasks, "s").join(F.broadcast(self.edges), "u")
        return salted_join(rows, self.edges, ["u"], sizes=self.node, spread=["s"], floor=self.floor)


def _sources(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows ``part, block, u``, each batch of them as one row per part and block, with the vertices as bytes."""
    for batch in batches:
        made = [(*key, some.to_numpy(np.int64).tobytes()) for key, some in batch.groupby(["part", "block"])["u"]]
        yield pd.DataFrame(made, columns=["part", "block", "sources"])


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _open(walks: _Walks, state: DataFrame, last: DataFrame) -> DataFrame:
    """Walks of ``last`` that one more edge may still turn into a shortest path.

    Once a source has reached every vertex of its component, a walk is done if even the shortest edge at its end makes
    it longer than the largest distance known from that source.
    """
    reach = state.groupBy("s").agg(F.count(F.lit(1)).alias("reached"), F.max("d").alias("furthest"))
    nearest = walks.far.select(F.col("u").alias("v"), "nearest", "size")
    return (
        last.join(reach, "s").join(nearest, "v")
        .filter((F.col("reached") < F.col("size")) | (F.col("d") + F.col("nearest") <= F.col("furthest")))
        .select("s", "v", "d", "paths")
    )


def _merge(known: DataFrame, longer: DataFrame, hops: int) -> DataFrame:
    """The state ``s, v, d, paths, depth, fresh`` after walks of ``hops`` edges have joined what is known.

    ``fresh`` counts the paths among these walks; where something shorter is known it is 0.
    """
    old = known.select("s", "v", "d", "paths", "depth", F.lit(0.0).alias("fresh"))
    # summed where the walks arise, before rows move
    new = longer.groupBy("s", "v", "d").agg(F.sum("paths").alias("paths")).select(
        "s", "v", "d", "paths", F.lit(hops).alias("depth"), F.col("paths").alias("fresh"))
    return (
        old.unionByName(new).repartition("s", "v")
        .groupBy("s", "v", "d")
        .agg(F.sum("paths").alias("paths"), F.max("depth").alias("depth"), F.sum("fresh").alias("fresh"))
        .groupBy("s", "v")
        .agg(F.min("d").alias("d"), *[F.min_by(c, "d").alias(c) for c in ("paths", "depth", "fresh")])
    )


def _shortest(walks: _Walks, mine: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
    """Per source and vertex: distance ``d``, number of shortest paths ``paths`` and largest hop count ``depth``.

    Only of components that are not near; None without any.

    ``mine`` picks the rows of this pass's sources. Walks of no edge and of one edge are the vertices and the edges
    themselves. One state is kept, and each round replaces it: it is read once per round, and only the walks that are
    new in it are extended.
    """
    if walks.far is None:
        return None
    one = F.lit(1.0).alias("paths")
    none = walks.far.select(
        F.col("u").alias("s"), F.col("u").alias("v"), F.lit(0).cast(walks.d_type).alias("d"), one, F.lit(0).alias("depth"))
    single = walks.edges.select(F.col("u").alias("s"), "v", F.col("w").alias("d"), one)
    hops = 1
    state = materialize(_merge(mine(none), mine(single), hops), "walks")
    while True:
        last = state.filter("fresh > 0").select("s", "v", "d", F.col("fresh").alias("paths"))
        rows = last.count()
        if not rows:
            return state
        hops += 1
        longer = walks.push(_open(walks, state, last).withColumnRenamed("v", "u"), walks.tasks(rows)).select(
            "s", "v", (F.col("d") + F.col("w")).cast(walks.d_type).alias("d"), "paths"
        )
        after = materialize(_merge(state, longer, hops), "walks")
        discard(state)
        state = after


def _dependencies(walks: _Walks, state: DataFrame) -> DataFrame | None:
    """``id, raw``: the dependencies of all sources on each vertex, summed; None without any.

    From the deepest level up, a level's vertices hand their shares to those before them. The state then holds what
    they have received and drops the level, so it shrinks as levels go by.
    """
    deepest = state.agg(F.max("depth")).first()[0] or 0
    left, total = state.select("s", "v", "d", "paths", "depth", F.lit(0.0).alias("received")), None
    for level in range(deepest, 1, -1):
        rows = left.filter(F.col("depth") == level)
        share = ((1 + F.col("received")) / F.col("paths")).alias("share")
        sent = (
            walks.push(rows.select("s", F.col("v").alias("u"), "d", share), walks.tasks(rows.count()))
            .select("s", "v", (F.col("d") - F.col("w")).cast(walks.d_type).alias("d"), "share")
            .filter("d > 0")  # only vertices between the source and the end
            .groupBy("s", "v", "d")
            .agg(F.sum("share").alias("share"))
        )
        more = F.col("received") + F.col("paths") * F.coalesce("share", F.lit(0.0))
        before = left.filter((F.col("depth") > 0) & (F.col("depth") < level))
        after = materialize(
            before.join(sent, ["s", "v", "d"], "left").select("s", "v", "d", "paths", "depth", more.alias("received")), "levels")
        # what the next level up has received is complete now
        done = after.filter(F.col("depth") == level - 1).groupBy(F.col("v").alias("id")).agg(F.sum("received").alias("raw"))
        if total is not None:
            done = total.unionByName(done).groupBy("id").agg(F.sum("raw").alias("raw"))
        summed = materialize(done, "dependencies")
        discard(left, total)
        left, total = after, summed
    discard(left)
    return total


def _fingerprint(walks: _Walks, sources: DataFrame | None, passes: int) -> str:
    """What the sums of a pass depend on: edges, lengths, sources, and how these are dealt to passes."""
    def digest(rows: DataFrame) -> tuple:
        row = F.xxhash64(*rows.columns).cast("decimal(38,0)")
        return tuple(rows.agg(F.count(F.lit(1)), F.sum(row), F.sum(row * F.lit(31) % F.lit(1_000_003))).first())

    told = (digest(walks.all_edges.union(walks.node.select("u", "u", F.lit(0).cast(walks.d_type)))),
            None if sources is None else digest(sources), passes, walks.d_type.simpleString())
    return sha256(repr(told).encode()).hexdigest()[:24]


def _stored_sums(spark: SparkSession, path: str) -> DataFrame | None:
    """The sums of a finished pass, if there are any."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    return spark.read.schema("id bigint, raw double").parquet(path)


def betweenness(
    edges: DataFrame,
    weight: str = "weight",
    broadcast_edges: int = BROADCAST_EDGES,
    state_rows: int = STATE_ROWS,
    floor: int = HOT_FLOOR,
    distance: str = "weight",
    sources: DataFrame | None = None,
    resume: str | None = None,
    near_edges: int | None = None,
) -> DataFrame:
    """Share of shortest paths through each vertex.

    The weight is the distance, or with ``distance="inverse"`` one over the weight, so that strong ties are short.
    Exact: the weight must be positive and of an exact type, and reciprocals are compared as whole numbers. End points
    do not count and values are divided by (n - 1)(n - 2).

    ``sources``, a column ``id``, restricts the paths to those that begin at these vertices; ids that are not in the
    network, nulls and repeated ids change nothing. The results of disjoint sets of sources add up to that of their
    union, and that of k sources times n / k estimates the whole (Brandes and Pich 2007).

    Sources are taken in passes of at most ``state_rows`` pairs, which bounds the space in use and changes no result.
    With ``resume``, a folder all executors reach, the sums of each finished pass are kept there under its number and a
    fingerprint of the network, so a driver that starts anew goes on with the next pass. Components of at most
    ``near_edges`` directed edges are walked inside tasks, by default as many as a task holds.
    """
    if distance not in ("weight", "inverse"):
        raise ValueError("distance is weight or inverse")
    spark = edges.sparkSession
    if distance == "inverse":
        edges, weight = materialize(inverse_lengths(edges, weight), "lengths"), "weight"
    walks = _Walks(edges, weight, broadcast_edges, floor, near_edges)
    if distance == "inverse":
        discard(edges)
    begun = walks.n
    if sources is not None:
        ids = sources.select(F.col("id").cast("bigint").alias("s")).distinct()
        sources = materialize(ids.join(walks.node.select(F.col("u").alias("s")), "s", "left_semi"), "sources")
        begun = sources.count()
    passes = max(1, math.ceil(begun * walks.n / state_rows))
    folder = None if resume is None else f"{resume.rstrip('/')}/{_fingerprint(walks, sources, passes)}"

    def pick(rows: DataFrame, turn: int) -> DataFrame:
        some = rows if sources is None else rows.join(sources, "s", "left_semi").select(*rows.columns)
        return some.filter(F.pmod(F.xxhash64("s"), F.lit(passes)) == turn)

    sums = []
    for turn in range(passes):
        path = None if folder is None else f"{folder}/pass-{turn:06d}"
        total = None if path is None else _stored_sums(spark, path)
        if total is None:
            state = _shortest(walks, lambda rows: pick(rows, turn))
            total = None if state is None else _dependencies(walks, state)
            discard(state)
            near = walks.near_sums(lambda rows: pick(rows, turn), begun / max(1, walks.n * passes))
            total = near if total is None else total if near is None else total.unionByName(near)
            if path is not None:
                none = spark.createDataFrame([], "id bigint, raw double")
                (none if total is None else total).write.mode("overwrite").parquet(path)
                discard(total, near)
                total = _stored_sums(spark, path)
        if total is not None:
            sums.append(total)
    vertices = walks.node.select(F.col("u").alias("id"))
    if not sums:
        return vertices.select("id", F.lit(0.0).alias("Centralidade_Intermediacao"))
    raw = _union(sums).groupBy("id").agg(F.sum("raw").alias("raw"))
    scale = float(max(1, (walks.n - 1) * (walks.n - 2)))  # a part needs three vertices
    value = (F.coalesce("raw", F.lit(0.0)) / scale).alias("Centralidade_Intermediacao")
    return vertices.join(raw, "id", "left").select("id", value)


def bridging_centrality(edges: DataFrame, weight: str = "weight", **options) -> DataFrame:
    """Betweenness times bridging coefficient, with both factors; ``options`` go to :func:`betweenness`."""
    between = betweenness(edges, weight, **options)
    bridge = bridging_coefficient(edges.withColumn("weight", F.col(weight)))
    product = (F.col("Centralidade_Intermediacao") * F.col("coef_ponte")).alias("Centralidade_Ponte")
    return between.join(bridge, "id").select("id", "Centralidade_Intermediacao", "coef_ponte", product)
