import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session
    s = local_session("*", shuffle_partitions=8, driver_memory="8g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def driver_src(spark):
    from tessera.sources.adapter import driver_sources
    return driver_sources(spark, SF_SMALL)
