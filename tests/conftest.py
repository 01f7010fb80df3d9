import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import build_session
    scratch = tempfile.mkdtemp(prefix="ledgerline-tests-")
    s = build_session("local[4]", 8, app_name="ledgerline-tests",
                      extra={"spark.sql.warehouse.dir": os.path.join(scratch, "wh"),
                             "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="ledgerline-t-")
