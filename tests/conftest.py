import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from docloom.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=8, shuffle_partitions=4, memory="8g")
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return session


@pytest.fixture(autouse=True)
def no_codegen_for_tiny_data(request, spark):
    """Compiling code takes longer than running it on a few rows; the query checks do run compiled code."""
    compiled = "true" if "test_queries" in request.node.nodeid else "false"
    spark.conf.set("spark.sql.codegen.wholeStage", compiled)


@pytest.fixture(scope="session")
def sf_dir():
    return SF
