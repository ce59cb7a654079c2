from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerlight.session import build_session
    scratch = tempfile.mkdtemp(prefix="ledgerlight-tests-")
    s = build_session("local[4]", 8, app_name="ledgerlight-tests",
                      extra={"spark.checkpoint.dir": f"{scratch}/ckpt",
                             "spark.sql.warehouse.dir": f"{scratch}/warehouse"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ledgerlight-t-")
