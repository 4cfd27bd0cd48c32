import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in zip(ids, texts)], DOC_SCHEMA)
    return make
