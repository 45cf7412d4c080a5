from __future__ import annotations

import sys
import tempfile
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lakewright.session import local_session  # noqa: E402
from lakewright.sources.lake import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="spark-tests-")
    session = local_session(
        "8", "tests", **{
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
            "spark.sql.shuffle.partitions": "4",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    name = f"t{uuid.uuid4().hex[:8]}_"
    return Lake(spark, prefix=name, location=str(tmp_path / "lake"))
