from datetime import datetime, timedelta

import pytest

from chronogrid.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture
def hourly(spark):
    """Build one hourly series from a list of values; None is a missing value."""

    def build(values, item="a", start=datetime(2024, 1, 1), column="y"):
        rows = [
            (item, start + timedelta(hours=i), None if v is None else float(v)) for i, v in enumerate(values)
        ]
        return spark.createDataFrame(rows, f"item_id string, ts timestamp, {column} double")

    return build


def column(df, name, by="ts"):
    return [row[name] for row in df.orderBy(by).collect()]
