import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        4,
        {
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.maxMetadataStringLength": "4000",
            # Thousands of small date folders are written here; at scale tasks are larger.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *names):
    """Rows as plain tuples in a fixed order."""
    picked = df.select(*names) if names else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
