import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from procwarden.schema import KEYED_EVENT_SCHEMA  # noqa: E402
from procwarden.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 8)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_events(spark):
    """Events from partial rows; the rest of the columns is filled in."""
    base = {
        "UtcTime": "2024-07-01T10:00:00.000Z", "ProcessGuid": "{0}", "ProcessId": 1000,
        "Image": "C:\\Windows\\System32\\notepad.exe", "CommandLine": "notepad.exe",
        "ParentImage": "C:\\Windows\\explorer.exe", "ParentCommandLine": "explorer.exe",
        "ParentProcessId": 1001, "User": "CORP\\user1", "IntegrityLevel": "Medium",
        "is_malicious": 0, "mitre_technique_id": "", "technique_name": "", "label": "benign",
    }

    def make(rows):
        data = [tuple({"event_id": i, **base, **r}[f] for f in KEYED_EVENT_SCHEMA.names)
                for i, r in enumerate(rows)]
        return spark.createDataFrame(data, KEYED_EVENT_SCHEMA)
    return make
