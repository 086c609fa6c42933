import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from support import AS_OF, DOCUMENTS  # noqa: E402

from basketry.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "basketry-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def texts(spark):
    def make(*items, kind="string"):
        return spark.createDataFrame([(i,) for i in items], f"x {kind}").coalesce(1)

    return make


@pytest.fixture(scope="session")
def golden_run(spark, tmp_path_factory):
    """The whole daily run over the documents in the golden mode."""
    from basketry.plans.daily import run_daily

    out = str(tmp_path_factory.mktemp("golden"))
    matrix = run_daily(spark, DOCUMENTS, out, AS_OF, items="first", compat=True, single_csv=True)
    return out, matrix


@pytest.fixture(scope="session")
def full_run(spark, tmp_path_factory):
    """The whole daily run over the documents, all items, own rules."""
    from basketry.plans.daily import run_daily

    out = str(tmp_path_factory.mktemp("full"))
    return out, run_daily(spark, DOCUMENTS, out, AS_OF)
