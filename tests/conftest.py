import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tickforge.session import get_session
    s = get_session("local[*]", app="tickforge-tests", shuffle_partitions=8,
                    extra={"spark.driver.memory": "4g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tests-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s


def bars_df(spark, rows, ticker="A"):
    """rows: list of (day_index, o, h, l, c[, v]) -> bars DataFrame."""
    import datetime as dt
    base = dt.datetime(2020, 1, 1)
    data = []
    for r in rows:
        d, o, h, l, c = r[:5]
        v = r[5] if len(r) > 5 else 100.0
        data.append((ticker, base + dt.timedelta(days=d), float(o), float(h), float(l), float(c),
                     float(v), float(c), 1))
    return spark.createDataFrame(
        data, "ticker string, t timestamp_ntz, o double, h double, l double, c double, v double, "
              "vw double, n long")
