import pytest

from lakewarden.session import build_session

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    def as_tuples(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return as_tuples
