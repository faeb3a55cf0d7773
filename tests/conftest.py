import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[8]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def vectors(spark):
    from tessera.sources.vectors import read_vectors
    return read_vectors(spark, f"{SF}/embeddings.parquet")
