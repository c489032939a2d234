import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from rateflow.session import build_session
    s = build_session("local[*]", 8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def items(spark):
    from rateflow.sources.text import read_items_text
    return read_items_text(spark, os.path.join(FIXTURES, "items_small.txt")).cache()


@pytest.fixture(scope="session")
def ratings(spark):
    from rateflow.sources.text import read_ratings_text
    return read_ratings_text(spark, os.path.join(FIXTURES, "ratings_small.txt")).cache()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


def rows_df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)
