import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from checks.session import local_session
    from flowverdict.session import tune_session

    return tune_session(local_session(8))


@pytest.fixture(scope="session")
def flows(spark):
    from checks.event_flows import flows_from_events, read_events

    return flows_from_events(read_events(spark, SF))


@pytest.fixture(scope="session")
def trained(flows):
    from flowverdict import train_model

    return train_model(flows, ["event_id"])
