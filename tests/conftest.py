from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

from flowstats.schemas import HTTP_SCHEMA, TCP_SCHEMA  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from flowstats.session import BUILD_DEFAULTS, DEFAULTS, checkpoint_dir

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("flowstats-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**DEFAULTS, **BUILD_DEFAULTS}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(session)  # only set when the environment has none
    yield session
    session.stop()


# FIXTURES.md §3.1, columns in HTTP_SCHEMA order.
HTTP_MICRO = [
    (1, "10.0.0.1", "a.com/x.js", "200", 10, 90, 0, 500),
    (1, "10.0.0.1", "a.com/x.js", "404", 10, 10, 0, 100),
    (1, "10.0.0.2", "b.com:8080/y?f=1.js", "200", 5, 5, 1, 0),
    (2, "10.0.0.1", "a.com", "301", 1, 1, 0, 10),
    (2, "10.0.0.1", None, "500", 7, 7, 0, 7),
    (None, "10.0.0.3", "c.com/p.JPG", "200", 3, 3, 0, 3),
    (1, "10.0.0.2", "b.com/z.png?v=2", "503", None, 4, 0, 4),
]

# FIXTURES.md §3.2, columns in TCP_SCHEMA order.
TCP_MICRO = [
    (1, "a", 80, 7, 8, 0, 100, 900, 4, 6, 1, 0, 0, 1, 0, 0, 200, 1, 500),
    (1, "a", 80, 7, 7, 0, 50, 50, 1, 1, 0, 0, 0, 0, 1, 0, 100, 0, 501),
    (1, "b", 443, 7, 1, 1, 10, 0, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0),
    (2, "a", 443, 9, 8, 0, 20, 30, 1, 1, 1, 1, 0, 0, 0, 0, 300, 0, 700),
    (2, "a", 22, 9, 5, 0, 5, 5, 1, 1, 0, 0, 0, 0, 0, 9, 9, 9, 9),
    (None, "c", 22, 9, 2, 0, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0, 10, 0, 10),
]


@pytest.fixture(scope="session")
def http_micro(spark):
    return spark.createDataFrame(HTTP_MICRO, HTTP_SCHEMA)


@pytest.fixture(scope="session")
def tcp_micro(spark):
    return spark.createDataFrame(TCP_MICRO, TCP_SCHEMA)


def rows_by(df, *keys):
    """Collect into {key tuple or key: row dict}."""
    out = {}
    for r in df.collect():
        d = r.asDict()
        k = tuple(d[c] for c in keys)
        out[k if len(k) > 1 else k[0]] = d
    return out
