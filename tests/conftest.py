import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


def library_queries():
    """Keys of the library's own queries; those of the optional training-data
    subpackage have their tests beside them."""
    import re

    import __spark_entry__ as E

    return sorted(k for k in E.queries() if not re.match(r"op[0-9]+_|pipeline$", k))


@pytest.fixture(scope="session")
def spark():
    from logloom.session import local_session

    s = local_session("*", shuffle_partitions=8, app="logloom-tests")
    yield s
    s.stop()
