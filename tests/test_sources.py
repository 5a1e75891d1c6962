import pytest
from pyspark.sql import functions as F

from plenum.operators.graph import attach_attributes, vertex_ids
from plenum.session import materialize, scratch_path, shared_folder
from plenum.skew import hot_keys, salted_join
from plenum.sources import manifest, sinks, tables
from tests.conftest import T2, rows

MANIFEST = "url,nome_banco_dados,descricao\nhttps://example.org/a/deputies.xlsx,TB_DEPU, Deputies\nhttps://example.org/v.xlsx,TB_VOTO,Votes\n"


def test_manifest(spark, tmp_path):
    (tmp_path / "m.csv").write_text(MANIFEST)
    listed = manifest.manifest_files(manifest.read_manifest(spark, str(tmp_path / "m.csv")))
    assert [r["descricao"] for r in listed.collect()] == [" Deputies", "Votes"]
    assert [r["filename"] for r in listed.collect()] == ["deputies.xlsx", "v.xlsx"]
    files = spark.createDataFrame(
        [("deputies.xlsx",), ("other.file.xlsx",), ("REDE_VERTICES.xlsx",), ("notes.txt",)], "filename string"
    )
    expected = [("deputies.xlsx", True, "TB_DEPU"), ("other.file.xlsx", False, "other.file")]
    assert rows(manifest.resolve_table_names(files, listed)) == expected
    crowd = files.union(spark.createDataFrame([("deputies.xlsx",)] * 50, "filename string"))
    assert manifest.resolve_table_names(crowd, listed, floor=5).filter("in_manifest").count() == 51


def test_widths_and_text(spark):
    frame = spark.createDataFrame([(1, "abc", None), (100, "", None)], "a int, `b c` string, d string")
    assert rows(tables.varchar_widths(frame)) == [("a", 3), ("b c", 3), ("d", 1)]
    assert [f.dataType.simpleString() for f in tables.as_text(frame).schema] == ["string"] * 3
    assert rows(tables.varchar_widths(frame.limit(0))) == [("a", 1), ("b c", 1), ("d", 1)]


def test_load_and_audit_can_be_repeated(spark):
    folder = scratch_path(spark, "load")
    spark.createDataFrame([(1, "x y"), (2, None)], "id int, name string").write.csv(f"{folder}/t.xlsx", header=True)
    resolved = spark.createDataFrame([("t.xlsx", "tb_t")], "filename string, table_name string")
    for _ in range(2):
        loaded = tables.load_tables(spark, resolved, folder, "csv", "plenum_test", f"{folder}/stored", header="true")
        assert rows(tables.load_audit(loaded)) == [("tb_t", 2, 2, True)]
    assert rows(spark.table("plenum_test.tb_t")) == [("1", "x y"), ("2", None)]
    measured = tables.load_table(spark.table("plenum_test.tb_t"), "plenum_test.tb_m", f"{folder}/measured", measured=True)
    assert rows(measured) == [("1", "x y"), ("2", None)]
    spark.sql("DROP DATABASE plenum_test CASCADE")


def test_network_tables(spark):
    folder = scratch_path(spark, "net")
    tables.create_database(spark, "plenum_net")
    spark.createDataFrame([("1", "2", "3")], "SOURCE string, TARGET string, WEIGHT string").write.option(
        "path", f"{folder}/e").saveAsTable("plenum_net.tb_arestas", mode="overwrite")
    spark.createDataFrame([("1", "left")], "ID string, Ideologia string").write.option(
        "path", f"{folder}/v").saveAsTable("plenum_net.tb_vertices", mode="overwrite")
    assert rows(tables.read_edges(spark, "plenum_net.tb_arestas")) == [(1, 2, 3)]
    vertices = tables.read_vertices(spark, "plenum_net.tb_vertices")
    assert vertices.columns == ["id", "Ideologia"] and rows(vertices) == [(1, "left")]
    spark.sql("DROP DATABASE plenum_net CASCADE")


def test_sinks(spark, edges, tmp_path):
    net = edges(T2)
    sinks.write_edges(net, f"{tmp_path}/e", "csv", header="true")
    back = spark.read.csv(f"{tmp_path}/e", header=True)
    assert back.columns == ["weight", "Origem", "Destino"] and back.count() == 7
    sinks.write_vertices(vertex_ids(net), f"{tmp_path}/v")
    assert spark.read.parquet(f"{tmp_path}/v").columns == ["ID"]


def test_graph_xml(spark, edges, tmp_path):
    net = edges(T2)
    attrs = spark.createDataFrame([(1, "Ana & <Bia>", "left"), (2, "Caio", None)], "id bigint, nome string, ideologia string")
    vertices = attach_attributes(vertex_ids(net), attrs)
    sinks.export_graph_xml(vertices, net, str(tmp_path))
    nodes, links = sinks.read_graph_xml(spark, str(tmp_path))
    assert rows(nodes.select("id")) == [(i,) for i in range(1, 7)]
    assert sorted(tuple(r) for r in links.collect()) == [(a, b, float(w)) for a, b, w in T2]
    text = "".join(p.read_text() for p in (tmp_path / "nodes").glob("part*"))
    assert 'for="0" value="Ana &amp; &lt;Bia>"' in text and 'value="left"' in text


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(900).select("id", F.when(F.col("id") < 300, 0).when(F.col("id") < 400, None).otherwise(F.col("id") % 50).alias("k"))
    right = spark.createDataFrame([(k, k * 2) for k in range(0, 40)], "k bigint, v bigint")
    left = materialize(left.withColumn("k", F.col("k").cast("bigint")), "left")
    sizes = left.groupBy("k").count()
    assert hot_keys(sizes, ["k"], "count", floor=50).count() >= 1
    assert hot_keys(sizes, ["k"], "count") is None
    plain, salted = left.join(right, ["k"], how), salted_join(left, right, ["k"], how, floor=50)
    assert plain.columns == salted.columns and rows(plain) == rows(salted)


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir", shared_folder(spark)).rstrip("/")


def test_files_of_one_table_are_loaded_together(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "bcd")], "k int, v string").write.option("header", True).csv(f"{tmp_path}/one.xlsx")
    spark.createDataFrame([(30, "e")], "k int, v string").write.option("header", True).csv(f"{tmp_path}/two.xlsx")
    spark.createDataFrame([(1,)], "other int").write.option("header", True).csv(f"{tmp_path}/three.xlsx")
    resolved = spark.createDataFrame([("one.xlsx", "tb_voto"), ("two.xlsx", "tb_voto")], "filename string, table_name string")
    loaded = tables.load_tables(spark, resolved, str(tmp_path), "csv", "plenum_years", f"{tmp_path}/stored", header="true")
    assert [name for name, _, _ in loaded] == ["tb_voto"]
    assert rows(loaded[0][1]) == [("1", "a"), ("2", "bcd"), ("30", "e")]
    assert rows(tables.load_audit(loaded)) == [("tb_voto", 3, 3, True)]
    kinds = {r.col_name: r.data_type for r in spark.sql("DESCRIBE plenum_years.tb_voto").collect()}
    assert kinds == {"k": "varchar(2)", "v": "varchar(3)"}
    more = resolved.union(spark.createDataFrame([("three.xlsx", "tb_voto")], resolved.schema))
    with pytest.raises(ValueError, match="other columns"):
        tables.load_tables(spark, more, str(tmp_path), "csv", "plenum_years", f"{tmp_path}/again", header="true")
    spark.sql("DROP DATABASE plenum_years CASCADE")


@pytest.mark.parametrize("kind, value, expected", [
    ("double", 2.5, "2.500000000"), ("string", "2.5", "2.500000000"), ("bigint", 3, "3"), ("decimal(10,2)", "2.50", "2.50"),
])
def test_weights_keep_their_fraction(spark, tmp_path, kind, value, expected):
    spark.sql("CREATE DATABASE IF NOT EXISTS plenum_weights")
    frame = spark.createDataFrame([(1, 2, value)], f"SOURCE int, TARGET int, WEIGHT {kind if kind[:3] != 'dec' else 'string'}")
    frame.selectExpr("SOURCE", "TARGET", f"CAST(WEIGHT AS {kind}) AS WEIGHT").write.mode("overwrite").option("path", f"{tmp_path}/w").saveAsTable("plenum_weights.w")
    assert str(tables.read_edges(spark, "plenum_weights.w").first().weight) == expected
    spark.sql("DROP DATABASE plenum_weights CASCADE")


def test_many_files_are_one_scan(spark, tmp_path):
    """A thousand small files: one reader, rows counted per file and while they are written."""
    folder = tmp_path / "files"
    folder.mkdir()
    for i in range(1000):
        (folder / f"f{i:04d}.xlsx").write_text("k,v\n" + f"{i},{'x' * (i % 7)}\n" * (i % 3))
    resolved = spark.createDataFrame([(f"f{i:04d}.xlsx", "tb_many", i > 3) for i in range(1000)],
                                     "filename string, table_name string, in_manifest boolean")
    (_, stored, source), = loaded = tables.load_tables(spark, resolved, str(folder), "csv", "plenum_many", f"{tmp_path}/s", header="true")
    assert source._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    found = {r.file.rsplit("/", 1)[-1]: r.rows for r in tables.rows_per_file(source).collect()}
    assert found == {f"f{i:04d}.xlsx": i % 3 for i in range(1000) if i % 3}
    assert rows(tables.load_audit(loaded, naming=True)) == [("tb_many", 999, 999, True, False)]
    assert {r.col_name: r.data_type for r in spark.sql("DESCRIBE plenum_many.tb_many").collect()} == {"k": "varchar(3)", "v": "varchar(6)"}
    spark.sql("DROP DATABASE plenum_many CASCADE")


def test_a_failed_load_leaves_the_old_table(spark, tmp_path):
    tables.create_database(spark, "plenum_staged")
    name, place = "plenum_staged.t", f"{tmp_path}/t"
    old = tables.load_table(spark.createDataFrame([(1, "a")], "k int, v string"), name, place)
    bad = spark.range(3).select((F.lit(1) / (F.col("id") - 2)).alias("k"), F.raise_error(F.lit("lost")).cast("string").alias("v"))
    with pytest.raises(Exception, match="lost|ZERO"):
        tables.load_table(bad, name, place)
    assert rows(spark.table(name)) == rows(old) == [("1", "a")]
    assert [p.name for p in tmp_path.iterdir() if p.is_dir()] == [p.name for p in tmp_path.iterdir() if p.name.startswith("t-")]
    new = tables.load_table(spark.createDataFrame([(22, None, "x")], "k int, v string, w string"), name, place)
    assert rows(new) == [("22", None, "x")] and new.rows_source == 1
    assert len([p for p in tmp_path.iterdir() if p.name.startswith("t-")]) == 1  # the old files are gone
    none = tables.load_table(spark.createDataFrame([], "k int"), "plenum_staged.none")
    assert none.columns == ["k"] and none.count() == 0 and rows(tables.load_audit([("none", none, none)])) == [("none", 0, 0, True)]
    spark.sql("DROP DATABASE plenum_staged CASCADE")


def test_graph_files_are_bounded(spark, tmp_path, monkeypatch):
    """One task that writes very many elements leaves many files, each of which one task reads."""
    monkeypatch.setattr(sinks, "FILE_ROWS", 10)
    edges = spark.range(95).selectExpr("id AS src", "id + 1000 AS dst", "1L AS weight").coalesce(1)
    sinks.export_graph_xml(spark.createDataFrame([(1, "a")], "id bigint, nome string"), edges, str(tmp_path / "graph"))
    assert len(list((tmp_path / "graph" / "edges").glob("part-*"))) == 10
    assert sinks.read_graph_xml(spark, str(tmp_path / "graph"))[1].count() == 95
    assert sinks.read_attributes(spark, str(tmp_path / "graph")).filter("class = 'edge'").count() == 190
