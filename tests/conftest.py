import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
DATA = os.environ.get("TEST_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="spark-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="spark-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def sf():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def duck(sf):
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(sf):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf}/{f}'")
    return c


@pytest.fixture(scope="session")
def same():
    """Compares a Spark result with rows from SQL, whatever their order."""

    def run(df, relation):
        got, want = df.toPandas(), relation.df()
        assert sorted(got.columns) == sorted(want.columns)
        cols = sorted(got.columns)
        key = lambda f: sorted(tuple(_plain(v) for v in r) for r in f[cols].itertuples(index=False))
        a, b = key(got), key(want)
        assert len(a) == len(b)
        assert a == b

    return run


def _plain(v):
    import numpy as np
    import pandas as pd

    if isinstance(v, (list, tuple, np.ndarray)):
        return str([_plain(x) for x in v])
    if v is None or v is pd.NaT or (not isinstance(v, (dict, str)) and pd.isna(v)):
        return "NULL"
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, (float, np.floating)):
        return f"{float(v):.9g}" if not float(v).is_integer() else str(int(v))
    return str(v)
