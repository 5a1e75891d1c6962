import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plenum.functions import text
from plenum.functions.numbering import number_rows
from plenum.functions.quantiles import exact_quantiles, histogram_quantiles
from plenum.operators import attributes, distribution, profile
from tests.conftest import pairs, rows


@pytest.mark.parametrize("size", [1, 2, 7, 100, 30_000])
def test_quantiles_match_numpy(spark, size):
    rng = random.Random(size)
    # a third of the values are equal, the rest are spread
    values = [0.0 if rng.random() < 1 / 3 else rng.gauss(0, 10) for _ in range(size)]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = exact_quantiles(frame, "x", probabilities, [f"q{i}" for i in range(7)]).first()
    assert list(found) == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12, abs=1e-12)


def test_quantiles_of_integers_and_of_nothing(spark):
    frame = spark.range(11).select((F.col("id") * 10).alias("x"))
    assert tuple(distribution.quartiles(frame, "x").first()) == (25.0, 50.0, 75.0)
    assert tuple(distribution.quartiles(frame.filter("x < 0"), "x").first()) == (None, None, None)


def test_equal_quartiles_take_the_lowest_label(spark):
    values = [(1, 0.0), (2, 0.0), (3, 0.8), (4, 0.8), (5, 0.0), (6, 0.0)]
    frame = spark.createDataFrame(values, "id bigint, x double")
    limits = distribution.iqr_fences(frame, "x").first()
    assert tuple(limits) == pytest.approx((0.0, 0.0, 0.6, -0.9, 1.5))
    labelled = distribution.outlier_label(distribution.quartile_label(frame, "x"), "x")
    assert pairs(labelled, "id", "Quartil") == {1: "1", 2: "1", 3: "4", 4: "4", 5: "1", 6: "1"}
    assert rows(distribution.quartile_counts(labelled)) == [("1", 4), ("2", 0), ("3", 0), ("4", 2)]
    assert rows(distribution.outlier_counts(labelled)) == [(0, 0)]


def test_outliers_and_box(spark):
    values = [10.0, 11.0, 12.0, 13.0, 14.0, 15.0, 16.0, 100.0, -80.0]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    labelled = distribution.outlier_label(frame, "x")
    assert pairs(labelled)[100.0] == "SS" and pairs(labelled)[-80.0] == "SI" and pairs(labelled)[12.0] == "N"
    assert rows(distribution.outlier_counts(labelled)) == [(1, 1)]
    q1, q2, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    assert tuple(distribution.boxplot_stats(frame, "x").first()) == (9, q1, q2, q3, 10.0, 16.0)
    # a whisker never ends inside the box
    skewed = spark.createDataFrame([(0.0,), (0.0,), (0.0,), (100.0,)], "x double")
    box = distribution.boxplot_stats(skewed, "x").first()
    assert (box["q3"], box["whisker_hi"]) == (25.0, 25.0)


VERTICES = [(1, "left", "P", True), (2, "left", "Q", True), (3, "right", "Q", True), (4, None, "P", True), (5, None, None, False)]


@pytest.fixture(scope="module")
def vertices(spark):
    return spark.createDataFrame(VERTICES, "id bigint, ideologia string, partido string, has_attrs boolean")


def test_shares(vertices):
    assert rows(profile.attribute_distribution(vertices, "ideologia")) == rows_of(("left", 2), ("right", 1), (None, 2))
    donut = {r["value"]: r for r in profile.category_shares(vertices, "ideologia").collect()}
    assert donut["left"]["label"] == "Ideologia left (2 ocorrências - 50.0%)"
    assert (donut[None]["n"], donut[None]["pct"]) == (1, 25.0)
    legend = {r["value"]: r for r in profile.group_shares(vertices, "ideologia").collect()}
    assert legend["right"]["label"] == "Comunidade right: 1 (20.00%)" and legend[None]["n"] == 2
    assert profile.category_shares(vertices.filter("not has_attrs"), "ideologia").count() == 0


def test_a_field_can_be_null_or_lacking(spark):
    ids = spark.createDataFrame([(i,) for i in range(1, 6)], "id bigint")
    labels = spark.createDataFrame([(1, "a", 1.5), (2, None, 2.5), (3, "c", None), (9, "z", 0.0)], "id bigint, nome string, x double")
    later = spark.createDataFrame([("1", None), ("4", "d")], "id string, nome string")
    found = attributes.attach_maps(ids, [labels, later])
    assert {r["id"]: r["attrs"] for r in found.collect()} == {
        1: {"nome": None, "x": "1.5"}, 2: {"nome": None, "x": "2.5"}, 3: {"nome": "c", "x": None}, 4: {"nome": "d"}, 5: {}}
    told = {r["field"]: tuple(r)[1:] for r in attributes.field_presence(found, ["nome", "x", "y"]).collect()}
    assert told == {"nome": (2, 2, 1), "x": (2, 1, 2), "y": (0, 0, 5)}
    chosen = attributes.with_fields(found, {"nome": "string", "x": "double"}, present="x")
    assert {r["id"]: tuple(r)[1:] for r in chosen.collect()} == {
        1: (None, 1.5, True), 2: (None, 2.5, True), 3: ("c", None, True), 4: ("d", None, False), 5: (None, None, False)}
    shares = {r["value"]: (r["n"], r["pct"]) for r in profile.category_shares(chosen, "x").collect()}
    assert shares == {1.5: (1, 1 / 3 * 100), 2.5: (1, 1 / 3 * 100), None: (1, 1 / 3 * 100)}
    assert rows(profile.attribute_distribution(chosen, "x")) == rows_of((1.5, 1), (2.5, 1), (None, 3))


def test_maps_of_repeated_empty_and_odd_sources(spark):
    ids = spark.createDataFrame([(1,), (2,)], "id bigint")
    repeated = spark.createDataFrame([(1, "b", 1), (1, None, 2), (2, "c", 1), (2, "a", 1)], "id bigint, `a.b` string, t int")
    placed = attributes.attach_maps(ids, [repeated], order_col="t")
    assert {r["id"]: r["attrs"] for r in placed.collect()} == {1: {"a.b": None}, 2: {"a.b": "c"}}
    assert attributes.attach_maps(ids.limit(0), [repeated]).count() == 0
    assert [r["attrs"] for r in attributes.attach_maps(ids, []).collect()] == [{}, {}]
    assert [r["attrs"] for r in attributes.attach_maps(ids, [repeated.limit(0), ids]).collect()] == [{}, {}]


def test_cross_share_splits_a_value_with_most_rows(spark):
    frame = spark.range(3000).selectExpr("if(id % 3 = 0, null, 'hot') as a", "if(id < 2990, id, null) as b")
    plain, split = profile.cross_share(frame, "a", "b"), profile.cross_share(frame, "a", "b", floor=1)
    assert rows(plain) == rows(split) and split.count() == 2993 - 1
    assert {(r["a"], r["total"]) for r in split.collect()} == {(None, 1000), ("hot", 2000)}


def rows_of(*items):
    return sorted(items, key=repr)


def test_cross_share_and_ties(vertices):
    cross = rows(profile.cross_share(vertices, "ideologia", "partido"))
    assert ("left", "P", 1, 2, 50.0) in cross and (None, None, 1, 2, 50.0) in cross and len(cross) == 5
    best = {r["ideologia"]: r["partido"] for r in profile.dominant_category(vertices, "ideologia", "partido").collect()}
    assert best == {"left": "P", "right": "Q", None: "P"}


def test_strip_points(spark):
    frame = spark.createDataFrame([(1, 100.0, "a"), (2, 0.0, "b")], "id bigint, v double, c string")
    points = {r["id"]: r for r in profile.strip_points(frame, "v", "c").collect()}
    assert points[1]["log_y"] == 2.0 and points[2]["log_y"] is None
    many = profile.strip_points(spark.range(2000).selectExpr("id", "1.0 as v", "'a' as c"), "v", "c")
    low, high, mean = many.agg(F.min("x"), F.max("x"), F.avg("x")).first()
    assert -0.09 <= low < -0.08 and 0.08 < high <= 0.09 and abs(mean) < 0.01


@pytest.mark.parametrize("share", [6.25, 12.35, 0.15, 0.35, 18.75, 100.0, 0.0, 2 / 3 * 100])
def test_percent_text_rounds_like_fixed_point_formatting(spark, share):
    frame = spark.createDataFrame([(share,)], "p double")
    one, two = frame.select(text.percent_text(F.col("p"), 1), text.percent_text(F.col("p"), 2)).first()
    assert (one, two) == (f"{share:.1f}%", f"{share:.2f}%")


def test_text_functions(spark):
    frame = spark.createDataFrame([("a/b/c.d.xlsx",), (".xlsx",), ("x",)], "f string")
    found = [tuple(r) for r in frame.select(text.stem(text.last_segment(F.col("f"))), text.words(F.lit("cOEF_pONTE x"))).collect()]
    assert [f[0] for f in found] == ["c.d", ".xlsx", "x"] and found[0][1] == "Coef ponte x"


def test_number_rows(spark):
    frame = spark.range(1000).select((F.col("id") * 37 % 1000).alias("x")).repartition(7)
    numbered = number_rows(frame, [F.col("x").desc()], "place")
    assert pairs(numbered) == {x: 999 - x for x in range(1000)}


def test_safe_ratio(spark):
    frame = spark.createDataFrame([(1, 2), (1, 0)], "a bigint, b bigint")
    assert rows(frame.select(text.safe_ratio(F.col("a"), F.col("b")))) == [(0.0,), (0.5,)]


@pytest.mark.parametrize("bound", [100, 2_000])
def test_quantiles_narrow_in_several_rounds(spark, bound):
    rng = random.Random(bound)
    # two values with many rows, at whose ends ranks fall, between spread ones
    values = [rng.choice([0.0, 5.0]) if rng.random() < 0.5 else rng.gauss(0, 10) for _ in range(40_000)]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    probabilities = [0.0, 0.25, 0.5, 0.75, 1.0]
    found = exact_quantiles(frame, "x", probabilities, [f"q{i}" for i in range(5)], bound=bound).first()
    assert list(found) == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("bound", [3, 40, 200_000])
def test_quantiles_from_counts_equal_sorted_ones(spark, bound):
    values = [(i * i) % 97 for i in range(500)] + [5] * 300 + [None] * 20
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    want = np.quantile([v for v in values if v is not None], ps)
    assert histogram_quantiles(df, "v", ps, bound) == pytest.approx(list(want))
    halves = df.select((F.col("v") / 2).cast("decimal(10,1)").alias("v"))
    assert histogram_quantiles(halves, "v", ps, bound) == pytest.approx(list(want / 2))
    assert histogram_quantiles(df.limit(0), "v", [0.5]) == [None]
    assert histogram_quantiles(df.filter("v = 5"), "v", [0.3, 1.0], bound) == [5.0, 5.0]
