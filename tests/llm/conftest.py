import pytest
from llm_data import SCHEMA, edge_rows


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
