import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("lakesearch-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='lakesearch-tests-')}")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


PRODUCTS = [
    ("1", "laptop computer for programming", "fast machine for programming", "acme", "electronics", 1200.0, [1.0, 0.0, 0.0, 0.0]),
    ("2", "wireless mouse", "ergonomic pointer", "acme", "electronics", 25.0, [0.7071, 0.7071, 0.0, 0.0]),
    ("3", "mechanical keyboard", "keys for programming", "omega", "electronics", 150.0, [0.95, 0.31225, 0.0, 0.0]),
    ("4", "office desk chair", "ergonomic seat", "ergo", "furniture", 300.0, [0.0, 0.0, 0.7071, 0.7071]),
    ("5", "standing desk", "ergonomic table", "ergo", "furniture", 500.0, [0.0, 0.0, 1.0, 0.0]),
    ("6", "monitor screen 27 inch", "sharp picture", "acme", "electronics", 400.0, [0.866, 0.5, 0.0, 0.0]),
]


@pytest.fixture(scope="session")
def products(spark):
    return spark.createDataFrame(
        PRODUCTS,
        "_key string, title string, description string, brand string, category string, price double, embedding array<float>",
    ).cache()


@pytest.fixture(scope="session")
def product_schema():
    from lakesearch.schema import DocumentSchema

    return DocumentSchema(
        "products",
        [
            {"name": "title", "type": "text"},
            {"name": "description", "type": "text"},
            {"name": "brand", "type": "tag"},
            {"name": "category", "type": "tag"},
            {"name": "price", "type": "numeric"},
            {"name": "embedding", "type": "vector", "attrs": {"algorithm": "flat", "dims": 4}},
        ],
    )


@pytest.fixture(scope="session")
def keys_of():
    return lambda df: [r["_key"] for r in df.collect()]
