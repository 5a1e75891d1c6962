import pytest

from __spark_entry__ import entry
from compare import difference, duck
from plenum.catalogue.oracle import all_oracles as oracle_sql
from plenum.catalogue.queries import all_queries as queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return duck(FOLDER)


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_twin(spark, database, name):
    found = queries()[name](spark, FOLDER).toPandas()
    assert difference(found, database.execute(oracle_sql()[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_twin_gives_rows(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    report = entry(spark)
    assert report.columns == ["ID", "nome", "partido", "ideologia", "modularidade", "Centralidade_Intermediacao",
                              "coef_ponte", "Centralidade_Ponte", "Quartil", "Outlier"]
    assert report.count() == 9


def test_communities_beat_ideology(spark):
    run = queries()
    found = run["louvain_modularity"](spark, FOLDER).first()["modularity"]
    assert found > 0.2 > run["community_modularity"](spark, FOLDER).first()["modularity"]
