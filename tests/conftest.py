import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from lakeloom.session import get_spark  # noqa: E402

TESTDATA = pathlib.Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        "local[8]",
        spark_sql_shuffle_partitions="8",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from lakeloom.sources.tables import Tables

    if not TESTDATA.exists():
        pytest.skip("no test tables")
    return Tables(spark, str(TESTDATA))


def rows(df, *columns):
    """Rows as sorted tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()
