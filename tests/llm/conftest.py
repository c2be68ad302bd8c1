import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def docs_schema() -> str:
    return "doc_id bigint, text string, lang string, source string, n_chars bigint"
