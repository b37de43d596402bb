import shutil
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))
sys.path.insert(0, str(Path(__file__).parent))

from reviewloom.session import build_session, scratch_path  # noqa: E402
from reviewloom.sources.warehouse import Warehouse  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": f"file://{shared}",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
    shutil.rmtree(shared, ignore_errors=True)


@pytest.fixture
def warehouse(spark, request):
    name = "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name.lower())
    house = Warehouse(spark, name, scratch_path(spark, name))
    house.create_feature_tables()
    return house


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
