import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from crateloom.runtime import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", 4)
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.codegen.wholeStage", "false")  # tiny inputs: compiling costs more than it saves
    yield session
    session.stop()


@pytest.fixture(scope="session")
def inputs(tmp_path_factory):
    """Folders of awkward tables: empty ones, and full ones with clashing extra columns."""
    from tests import tables

    root = tmp_path_factory.mktemp("tables")
    return {
        "empty": tables.write(root / "empty", {}),
        "awkward": tables.write(root / "awkward", tables.awkward(), clash=True),
    }
