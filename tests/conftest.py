from __future__ import annotations

import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "millrace-tests",
        "local[8]",
        shuffle_partitions=2,
        log_level="ERROR",
        checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
        large_state=False,
        conf={"spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    yield session
    session.stop()


@pytest.fixture
def drop(tmp_path):
    """A watched folder: ``drop(text)`` puts one new file into it."""
    folder = tmp_path / "in"
    folder.mkdir()

    def put(text: str, name: str | None = None) -> str:
        target = folder / (name or f"{uuid.uuid4().hex}.txt")
        draft = tmp_path / uuid.uuid4().hex
        draft.write_text(text)
        draft.rename(target)
        return str(target)

    put.folder = str(folder)
    return put
