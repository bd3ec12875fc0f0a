import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from entigrid.session import build_session  # noqa: E402
from fixtures import SAMPLE_CSV, SAMPLE_JSON  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "entigrid-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("parties")
    (folder / "sample_parties.csv").write_text(SAMPLE_CSV, encoding="utf-8")
    (folder / "sample_parties.json").write_text(SAMPLE_JSON, encoding="utf-8")
    return str(folder)
