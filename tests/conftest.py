import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from eventlens.session import clear_scratch, get_session

    s = get_session("local[*]", **{"spark.sql.shuffle.partitions": "8"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    clear_scratch(s)


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")
