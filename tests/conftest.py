import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from docweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark_ui_enabled="false", spark_sql_shuffle_partitions="4", spark_driver_memory="8g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def value(spark):
    """Value of a column function for one text."""
    from pyspark.sql import functions as F

    def evaluate(function, text):
        return spark.range(1).select(function(F.concat(F.lit(text), F.substring(F.col("id").cast("string"), 2, 1)))).first()[0]

    return evaluate
