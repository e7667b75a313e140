import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from sensorloom.session import build_session, clear_scratch  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark_ui_enabled="false", spark_sql_shuffle_partitions=4,
        spark_driver_memory="6g", spark_ui_showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def skewed(spark):
    """900 readings: one series holds most rows, several share one time, some are missing."""
    import random

    random.seed(7)
    rows = []
    for i in range(900):
        series = "hot" if i % 10 < 7 else f"s{i % 3}"
        t = 1_700_000_000 + (i // 40) * 60 if i < 600 else 1_700_003_000
        value = None if i % 23 == 0 else float("nan") if i % 29 == 0 else round(random.gauss(10, 3), 3)
        if 300 < i < 400 and value is not None:
            value += 12
        rows.append((i, series, t, value))
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, series string, t long, x double")
    return df.selectExpr("id", "series", "timestamp_seconds(t) AS ts", "x").repartition(5)
