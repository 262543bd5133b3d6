import os
import sys

import pytest

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, _ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, os.environ.get("PYTHONPATH")]))

from crossroads.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="tests")
    s.sparkContext.setLogLevel("ERROR")
    return s


VEHICLE = (
    "scenario_id long, seq int, vehicle_id string, lane int, speed double, distance_to_intersection double, "
    "direction string, destination string"
)


@pytest.fixture(scope="session")
def rows(spark):
    """vehicles(list of (scenario, seq, lane, speed, distance, direction, destination)) -> DataFrame"""

    def make(data):
        full = [(s, q, f"V{1000 + q}", ln, float(sp), float(di), d, to) for s, q, ln, sp, di, d, to in data]
        return spark.createDataFrame(full, VEHICLE)

    return make
