import os
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        if (DATA / f"{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def same(value):
    """A form of a value in which both engines agree."""
    if isinstance(value, float):
        return float(f"{value:.9g}")
    return value


def rows_of(df, columns):
    return sorted((tuple(same(r[c]) for c in columns) for r in df.collect()), key=str)


def agree(spark, duck, query, sql):
    df = query(spark, str(DATA))
    columns = sorted(df.columns)
    result = duck.execute(sql)
    names = [x[0] for x in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(same(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=str)
    assert rows_of(df, columns) == want
