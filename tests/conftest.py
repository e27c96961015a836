import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from allelic.session import get_session
    s = get_session("local[*]", app="allelic-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def snps01(spark):
    from allelic.plans.catalog import load_snps
    return load_snps(spark, SF01)
