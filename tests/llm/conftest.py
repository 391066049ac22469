"""Python workers of the tests find this package as the driver does."""

import pytest

from tallyloom.llm.common import read_table


@pytest.fixture(scope="session", autouse=True)
def importable(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("one")
    spark.range(1).write.parquet(f"{folder}/t.parquet")
    read_table(spark, str(folder), "t")
