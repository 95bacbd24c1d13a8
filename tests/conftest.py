import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_session

    warehouse = tempfile.mkdtemp(prefix="tidemark-wh-")
    s = get_session("local[4]", 4, extra={"spark.sql.warehouse.dir": warehouse,
                                          "spark.driver.extraJavaOptions": f"-Dderby.system.home={warehouse}"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
