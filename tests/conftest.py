import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gustline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8", "gustline-tests")


@pytest.fixture
def obs(spark):
    """Frame of observations from rows (station, time text, further values)."""
    def make(rows, columns, network="N"):
        data = [(network, *r) for r in rows]
        names = ["network", "station", "valid", *[c.split()[0] for c in columns]]
        kinds = [c.split()[1] if " " in c else "double" for c in columns]
        schema = "network string, station string, valid string, " + ", ".join(f"{n} {k}" for n, k in zip(names[3:], kinds))
        return spark.createDataFrame(data, schema).selectExpr(
            "network", "station", "cast(valid as timestamp_ntz) as valid", *names[3:])
    return make


def table(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
