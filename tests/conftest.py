import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickloom.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()
