import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def make(spark):
    """Documents from texts, or from (doc_id, text) pairs."""

    def run(texts, extra=None):
        pairs = [x if isinstance(x, tuple) else (k, x) for k, x in enumerate(texts)]
        df = spark.createDataFrame([(i, t, None, None if i is None else f"s{i % 2}", None) for i, t in pairs], SCHEMA)
        return df.withColumns({k: F.lit(v) for k, v in (extra or {}).items()})

    return run


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def pairs(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
