from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from hirescope.session import build_session

    s = build_session("local[*]", 8, app_name="hirescope-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def base():
    return SF_SMALL
