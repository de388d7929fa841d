import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from fleetprep.session import local_session

    session = local_session(4, "tests", memory="8g", **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp")})
    yield session
    session.stop()


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def prepared(spark):
    """Prepared rows of the small tables, and their parameters."""
    from catalogue.inputs import split_rows
    from fleetprep.cluster import stage
    from fleetprep.operators import prepare as P

    split = stage(split_rows(spark, SMALL))
    params = P.fit(split)
    return stage(P.transform(split, params)), params, split
