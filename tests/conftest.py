import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tablelift.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # Many small jobs: a quick compiler matters more than fast code.
    session = build_session("local[8]", shuffle_partitions=4, memory="6g", java_options="-XX:TieredStopAtLevel=1")
    session.sparkContext.setLogLevel("FATAL")
    return session


@pytest.fixture
def small():
    return SMALL


@pytest.fixture
def read(spark):
    return lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet")


def rows(df):
    """Rows as a sorted list of tuples, for comparing without regard to order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
