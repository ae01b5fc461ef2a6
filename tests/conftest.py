import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

FOLDER = "/root/testdata/sf0.001"


def pytest_addoption(parser):
    parser.addoption("--quick", action="store_true", help="leave out the slow tests")


def pytest_configure(config):
    config.addinivalue_line("markers", "slow: takes some ten seconds or more")


def pytest_collection_modifyitems(config, items):
    if config.getoption("--quick"):
        items[:] = [item for item in items if "slow" not in item.keywords]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from loanloom.session import local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("tests", 8, **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kolkata"])
def zoned(request, spark):
    """The session in several time zones; results must not change."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield spark
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.fixture(params=["broadcast", "shuffle", "shuffle-all-keys"])
def planned(request, spark):
    """The session with and without broadcast joins and partitioning reuse."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": (
            "10485760" if request.param == "broadcast" else "-1"
        ),
        "spark.sql.requireAllClusterKeysForCoPartition": str(
            request.param == "shuffle-all-keys"
        ).lower(),
    }
    before = {k: spark.conf.get(k) for k in keys}
    for k, value in keys.items():
        spark.conf.set(k, value)
    yield spark
    for k, value in before.items():
        spark.conf.set(k, value)
