import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from terrarank.session import build_session, checkpoint_dir

    folder = tmp_path_factory.mktemp("checkpoints").as_uri()
    s = build_session("local[4]", shuffle_partitions=4, app_name="terrarank-tests", extra={"spark.checkpoint.dir": folder})
    checkpoint_dir(s)
    yield s
    s.stop()
