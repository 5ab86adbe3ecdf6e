import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [str(ROOT), os.environ.get("PYTHONPATH", "")]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lodestrata.session import session

    at = tmp_path_factory.mktemp("spark")
    conf = {"spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.checkpoint.dir": str(at), "spark.sql.warehouse.dir": str(at / "warehouse"), "spark.sql.codegen.wholeStage": "false"}
    s = session(**{k.replace(".", "__"): v for k, v in conf.items()})
    s.sparkContext.setLogLevel("ERROR")
    return s
