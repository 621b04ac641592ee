from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tarmac.session import build_session

    session = build_session(
        "tarmac-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tmp_path_factory.mktemp("shared").as_uri(),
        },
    )
    yield session
    session.stop()


@pytest.fixture()
def cfg(spark, tmp_path_factory):
    """A fresh warehouse root inside the session's shared checkpoint folder."""
    from tarmac.config import default_config

    name = f"tests/{os.getpid()}/{tmp_path_factory.mktemp('w').name}"
    return default_config(spark, name)


@pytest.fixture()
def scratch(cfg):
    """Folder for hand-written input files, under the shared root."""
    return f"{cfg.root}/input"


def write_text(path: str, text: str) -> str:
    if path.startswith("file:"):
        path = path[5:]
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path
