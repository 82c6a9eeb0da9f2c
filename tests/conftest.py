import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from huddlekit.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # managed tables created by tests go to a per-run folder, not the repo
    os.environ.setdefault("HUDDLEKIT_WAREHOUSE", str(tmp_path_factory.mktemp("warehouse")))
    s = local_session(cores=4, shuffle_partitions=4, app="huddlekit-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as a list of tuples ordered by the given columns."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
