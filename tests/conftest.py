from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from session import start  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return start()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
