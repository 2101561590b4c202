import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from acervo.session import build_session, ship_package  # noqa: E402

ship_package()


# columns at module level of the tests need an active session
SESSION = build_session("acervo-tests", "local[8]", **{
    "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
    "spark.ui.showConsoleProgress": "false"})
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture
def values(spark):
    """Evaluate column expressions over literal rows: values(rows, schema, expr) -> list."""
    def run(rows, schema, *columns):
        out = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"_i int, {schema}").select(
            "_i", *[c.alias(f"c{n}") for n, c in enumerate(columns)]).orderBy("_i").collect()
        return [r[1] if len(columns) == 1 else tuple(r)[1:] for r in out]
    return run
