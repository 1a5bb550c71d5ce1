import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from leafline.session import local_session

    s = local_session(os.environ.get("CPUS", "*"))
    s.conf.set("spark.sql.shuffle.partitions", "8")
    yield s
    s.stop()
