import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cellwise.session import get_spark

    s = get_spark(master="local[*]", shuffle_partitions=8, driver_memory="8g")
    yield s
    s.stop()


def plan_text(df, mode: str = "formatted") -> str:
    """Physical plan text with untruncated scan metadata."""
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
