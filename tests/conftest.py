from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from caremarts.session import build_session, checkpoint_dir

    s = build_session(
        "local[*]",
        app_name="caremarts-tests",
        conf={"spark.sql.shuffle.partitions": "8", "spark.default.parallelism": "4"},
    )
    s.sparkContext.setLogLevel("ERROR")
    # tests own their checkpoint folder only when the session names none
    checkpoint_dir(s, fallback=str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()
