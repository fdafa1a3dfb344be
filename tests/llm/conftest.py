import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture
def table_dir(tmp_path, spark):
    """Folder of tables from (name, rows, schema)."""
    def make(*tables):
        for name, rows, schema in tables:
            spark.createDataFrame(rows, schema).write.parquet(os.path.join(tmp_path, f"{name}.parquet"))
        return str(tmp_path)
    return make
