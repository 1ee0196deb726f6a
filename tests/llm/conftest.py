import os

import pytest
from tables_llm import TABLES


@pytest.fixture(scope="session")
def small(spark, tmp_path_factory):
    """A folder with the tables above."""
    folder = str(tmp_path_factory.mktemp("small"))
    for name, (rows, schema) in TABLES.items():
        df = spark.createDataFrame(rows(), schema).repartition(3)
        df.write.parquet(os.path.join(folder, f"{name}.parquet"))
    return folder


@pytest.fixture(scope="session")
def nothing(spark, tmp_path_factory):
    """A folder with empty tables."""
    folder = str(tmp_path_factory.mktemp("nothing"))
    for name, (_, schema) in TABLES.items():
        spark.createDataFrame([], schema).write.parquet(os.path.join(folder, f"{name}.parquet"))
    return folder
