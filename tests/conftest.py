from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession

from tallyshelf.session import get_spark_session


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    folder = tempfile.mkdtemp(prefix="run-")
    session = get_spark_session(
        "tests",
        hive=False,
        options={
            "spark.master": "local[4]",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
