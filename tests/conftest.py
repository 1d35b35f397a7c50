import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from foliant.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="6g", spark__sql__maxMetadataStringLength="10000", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture
def write(tmp_path):
    """Write text to a new file and return its path."""

    def make(text: str, name: str = "file.txt") -> str:
        path = tmp_path / name
        path.write_bytes(text.encode("utf-8") if isinstance(text, str) else text)
        return str(path)

    return make
