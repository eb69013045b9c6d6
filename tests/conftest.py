import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))  # for Python workers

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tastemine.session import local_session

    s = local_session(cpus=8, shuffle_partitions=8, app="tastemine-tests")
    yield s


def rows(df, order=None):
    out = [r.asDict(recursive=True) for r in (df.orderBy(*order) if order else df).collect()]
    return out
