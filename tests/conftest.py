import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cityflow.session import build_session
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    s = build_session("local[4]", shuffle_partitions=4, extra={"spark.sql.warehouse.dir": warehouse,
                                                                 "spark.sql.maxMetadataStringLength": "10000"})
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    """A fresh folder per test (tests only; jobs use the configured shared folders)."""
    return str(tmp_path)
