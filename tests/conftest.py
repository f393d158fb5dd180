import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from trawl.session import ensure_checkpoint_dir, get_session

    s = get_session("local[4]", shuffle_partitions=8, app="trawl-tests")
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


def page_df(spark, rows, with_md=False):
    """rows: list of (page_id, url, html[, metadata])."""
    schema = "page_id long, url string, html string" + (", metadata map<string,array<string>>" if with_md else "")
    return spark.createDataFrame(rows, schema)
