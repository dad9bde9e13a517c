import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from rillmark.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "rillmark-tests",
        "local[8]",
        **{
            "spark__sql__shuffle__partitions": "2",
            "spark__ui__enabled": "false",
            "spark__driver__memory": "4g",
            "spark__checkpoint__dir": tempfile.mkdtemp(prefix="rillmark-ckpt-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(f"{SF_DIR}/events.parquet")
