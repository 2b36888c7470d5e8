import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clicktide.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("clicktide-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


EVENT_SCHEMA = (
    "event_id long, partition_date string, client_id string, clientId string, page_url string, "
    "referrer string, timestamp string, event_name string, event_data string, user_agent string"
)


@pytest.fixture
def make_events(spark):
    """Raw events from dicts; absent fields are null, ids count up, the partition is the day."""

    def make(rows):
        names = [part.split()[0] for part in EVENT_SCHEMA.split(", ")]
        out = []
        for i, row in enumerate(rows):
            full = dict.fromkeys(names)
            full.update({"event_id": i, "event_name": "page_viewed", "user_agent": "UA"})
            full.update(row)
            if full["partition_date"] is None and full["timestamp"]:
                full["partition_date"] = full["timestamp"][:10].replace("-", "")
            out.append(tuple(full[n] for n in names))
        return spark.createDataFrame(out, EVENT_SCHEMA)

    return make
