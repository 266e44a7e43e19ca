import json
import uuid

import pytest

from clickloom.session import build_session
from pyspark.sql import types as T

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A path that does not exist yet, in a new folder."""
    return lambda name="out": f"{tmp_path}/{name}-{uuid.uuid4().hex[:8]}"


@pytest.fixture
def lines(spark):
    """A DataFrame of lines from dicts or texts."""
    schema = T.StructType([T.StructField("event", T.StringType())])

    def make(*events):
        texts = [e if isinstance(e, str) else json.dumps(e, separators=(",", ":")) for e in events]
        return spark.createDataFrame([(text,) for text in texts], schema)
    return make


#: An invented click in the form the feed sends.
SAMPLE = {
    "h": "q7", "g": "q8", "l": "nightbus", "hh": "go.example.org",
    "u": "https://maps.example.gov/harbour?sheet=12", "r": "http://news.example.net/today",
    "a": "Reader/2.4 (tablet)", "t": 1433920089, "hc": 1433900000, "_id": "click-0001", "al": "fi-fi",
    "c": "FI", "tz": "Europe/Helsinki", "gr": "18", "cy": "Järvenpää", "ll": [60.25, 25.125],
}


def click(**changes):
    """The sample with changed fields; a field set to None is left out."""
    return {key: value for key, value in {**SAMPLE, **changes}.items() if value is not None}
