from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from cohortline.session import build_session  # noqa: E402
from cohortline.warehouse import Warehouse  # noqa: E402
from cohortline.workspace import Workspace  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        f"local[{os.environ.get('TEST_CORES', '8')}]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("tables")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def workspace(spark, tmp_path):
    return Workspace(spark, str(tmp_path / "work"))


@pytest.fixture
def make_warehouse(spark, workspace):
    """A warehouse over hand-made documents."""

    def make(studies=(), applications=()) -> Warehouse:
        loaded = "current_timestamp() as fetched_at"
        raw_studies = spark.createDataFrame(list(studies), "nct_id string, payload string")
        raw_applications = spark.createDataFrame(list(applications), "application_number string, payload string")
        return Warehouse(
            raw_studies.selectExpr("*", loaded), raw_applications.selectExpr("*", loaded), workspace
        )

    return make
