from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from adflow.session import local_session, remove_written

    folder = tempfile.mkdtemp(prefix="adflow-tests-")
    session = local_session(4, "adflow-tests", spark__sql__shuffle__partitions="4", spark__checkpoint__dir=folder)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    remove_written(session)
    session.stop()


@pytest.fixture
def folder(spark):
    from adflow.session import fresh_folder

    return lambda label: fresh_folder(spark, label)
