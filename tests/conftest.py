import pytest

from plenum.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
                          spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


EDGES = "src bigint, dst bigint, weight bigint"
T1 = [(1, 2, 1), (2, 3, 1)]
T2 = [(1, 2, 1), (1, 3, 1), (2, 3, 1), (3, 4, 1), (4, 5, 1), (4, 6, 1), (5, 6, 1)]
T3 = [(1, 2, 1), (2, 3, 1), (1, 3, 3)]
T4 = [(8 * g + i, 8 * g + j, 10) for g in range(4) for i in range(8) for j in range(i + 1, 8)]
T4 += [(*sorted((8 * g, 8 * ((g + 1) % 4) + 1)), 1) for g in range(4)]


@pytest.fixture(scope="session")
def edges(spark):
    return lambda rows: spark.createDataFrame(rows, EDGES)


def pairs(df, *columns):
    """Rows as a dict from the first column to the rest."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return {r[0]: r[1] if len(r) == 2 else r[1:] for r in rows}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
