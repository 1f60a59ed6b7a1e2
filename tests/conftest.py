from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from martworks.session import clear_scratch, tune

    session = (
        SparkSession.builder.master("local[8]").appName("tests").config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    clear_scratch(session)
    session.stop()


@pytest.fixture
def rows():
    """Sorted tuples of a frame."""
    def collect(df, *cols):
        return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
    return collect
