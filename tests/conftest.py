import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlens.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
           "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def txn(spark):
    from ledgerlens.sources.event_views import load_view

    return load_view(spark, SF, "txn")


@pytest.fixture(scope="session")
def ident(spark):
    from ledgerlens.sources.event_views import load_view

    return load_view(spark, SF, "ident")


def rows(df, *order):
    """Rows as dicts in a fixed order."""
    return [r.asDict() for r in df.orderBy(*order).collect()]


def frame(df, key):
    out = df.toPandas().sort_values(key).reset_index(drop=True)
    return out[sorted(out.columns)]
