import contextlib
import io
import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from textloom.session import spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = spark_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def docs_of(spark):
    """Corpus frame of path → text or bytes."""

    def make(texts):
        rows = [
            (path, 1_700_000_000 + i, bytearray(t.encode() if isinstance(t, str) else t))
            for i, (path, t) in enumerate(texts.items())
        ]
        return spark.createDataFrame(rows, "path string, mtime long, content binary")

    return make


@pytest.fixture
def shuffled():
    """Columns that enter each shuffle of a plan."""

    def columns(df):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("formatted")
        found = re.findall(r"\(\d+\) Exchange\s+Input \[\d+\]: \[(.*?)\]", out.getvalue())
        return [{c.split("#")[0] for c in line.split(", ")} for line in found]

    return columns
