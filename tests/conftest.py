from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for name in os.listdir(SF):
        c.sql(f"create view {name.removesuffix('.parquet')} as from '{SF}/{name}'")
    return c


def rows(df, columns=None) -> list[tuple]:
    """Comparable rows: columns by name, numbers without their types, sorted."""
    import pandas as pd

    cols = sorted(columns or df.columns)

    def plain(v):
        if not isinstance(v, list | str | bytes) and pd.isna(v):
            return None
        return v.item() if hasattr(v, "item") else v

    return sorted((tuple(plain(v) for v in r) for r in df[cols].astype(object).itertuples(index=False)), key=repr)
