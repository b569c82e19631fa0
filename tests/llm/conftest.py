import pytest

from llm_helpers import DOCS


# the session fixture ``spark`` is that of the folder above: one per run
@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with two more columns, named like internal ones."""
    def make(texts, ids=None, source="s"):
        ids = ids or range(len(texts))
        rows = [(i, t, None, source, None if t is None else len(t), "x", 1) for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, DOCS + ", key string, node int")
    return make
