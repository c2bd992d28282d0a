import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from moodstream.session import get_spark

    here = os.path.dirname(os.path.abspath(__file__))
    os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(here), here, os.environ.get("PYTHONPATH", "")])
    ckpt = tempfile.mkdtemp(prefix="moodstream-test-ckpt-")
    s = get_spark("local[4]", "moodstream-tests", conf={
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": ckpt,
        "spark.sql.streaming.stateStore.stateSchemaCheck": "false",
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="moodstream-t-")
