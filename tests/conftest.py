import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from granary import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session("4", shuffle_partitions=4, spark__sql__warehouse__dir=str(warehouse))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = pathlib.Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("test tables are not available")
    return str(path)


@pytest.fixture
def rows():
    def collect(df, *order):
        ordered = df.orderBy(*order) if order else df
        return [tuple(r) for r in ordered.collect()]

    return collect
