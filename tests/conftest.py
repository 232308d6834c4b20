import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sluice.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, 4)


@pytest.fixture
def write_lines(tmp_path):
    """Write text files below a fresh folder; ``.gz`` names are compressed."""
    import gzip

    def write(name, lines):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        opener = gzip.open if name.endswith(".gz") else open
        with opener(path, "wt", encoding="utf-8") as handle:
            handle.write("".join(line + "\n" for line in lines))
        return str(path)

    write.root = str(tmp_path)
    return write
