import os
import sys

import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Node table from rows (id, type, x, y, z, radius, parent) or {neuron: rows}."""

    def build(rows, neuron="n"):
        groups = rows if isinstance(rows, dict) else {neuron: rows}
        flat = [(n, i, *map(float, r)) for n, rs in groups.items() for i, r in enumerate(rs)]
        pdf = pd.DataFrame(flat, columns=["neuron", "row_idx", "id", "type", "x", "y", "z", "radius", "parent"])
        pdf = pdf.astype({"row_idx": "int64", "id": "int64", "type": "int32", "parent": "int64"})
        return spark.createDataFrame(pdf)

    return build
