import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def doc_rows():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM read_parquet('{SF}/documents.parquet') ORDER BY 1").fetchall()
