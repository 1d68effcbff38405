import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hourglass.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = get_session("local[*]", app="hourglass-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": ckpt,
                           "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("wh"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
