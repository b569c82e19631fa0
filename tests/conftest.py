import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from helpers import FIX  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from meridian.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="meridian-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fx(spark):
    """Fixture reader: fx('rdd') -> DataFrame with the explicit schema."""
    from meridian.sources.io import read_csv
    files = {
        "crm": "crm_data.csv", "online": "online_order_data.csv", "pos": "instore_pos_data.csv",
        "cuped": "cuped_streaming_sessions.csv", "rule_customers": "rule_based_customers.csv",
        "rfm_customers": "rfm_customers.csv", "kmeans_customers": "kmeans_customers.csv",
        "cac_spend": "marketing_spend_acquisitions.csv", "host_ramp": "host_ramp_productivity.csv",
        "rdd": "rdd_loyalty_customers.csv",
    }

    def read(name):
        return read_csv(spark, os.path.join(FIX, files[name]), name)
    return read
