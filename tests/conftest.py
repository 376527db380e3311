from __future__ import annotations

import pytest

from lockscope.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def files(spark):
    """files(name, text, ...) -> one file per text, profiles p0, p1, ..."""

    def build(name: str, *texts):
        rows = [(f"p{i}", ".", name, text) for i, text in enumerate(texts)]
        return spark.createDataFrame(
            rows, "profile_id string, dependency_root string, filename string, content string"
        )

    return build
