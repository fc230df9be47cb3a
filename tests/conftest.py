import os
import sys

import pytest

_TESTS = os.path.dirname(os.path.abspath(__file__))
if _TESTS not in sys.path:
    sys.path.insert(0, _TESTS)

from paths import ROOT  # noqa: E402

if ROOT not in sys.path:
    sys.path.insert(0, ROOT)
# Python workers import the package too, wherever pytest is started.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark():
    from martspark.plans.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="martspark-tests")
    yield s
    s.stop()

