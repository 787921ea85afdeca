import pytest

from asterism.schemas import STAGING, struct
from asterism.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def staged(spark):
    """Rows of a staging table from dicts; what a dict leaves out is null."""

    def build(table, *rows):
        schema = struct(STAGING[table])
        for field in schema.fields:
            field.nullable = True
        values = [tuple(row.get(name) for name in schema.names) for row in rows]
        return spark.createDataFrame(values, schema)

    return build


@pytest.fixture
def rows():
    """The rows of a result as sorted tuples."""

    def collect(df, *names):
        found = df.select(*names) if names else df
        return sorted((tuple(row) for row in found.collect()), key=repr)

    return collect
