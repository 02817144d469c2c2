import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from foliar.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture()
def values(spark):
    """Evaluate named column expressions on literal rows."""

    def run(schema, data, **exprs):
        df = spark.createDataFrame(data, schema)
        rows = df.select(*[e.alias(k) for k, e in exprs.items()]).collect()
        return {k: [r[k] for r in rows] for k in exprs}

    return run


def rows(df):
    """All rows as sorted tuples, missing values first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(x is not None, str(x)) for x in t])
