import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from samples import CLASHING, DOCS  # noqa: E402


@pytest.fixture
def docs(spark):
    """docs([(doc_id, text, lang, source), ...], clashing=False) -> DataFrame"""
    def make(rows, clashing=False, parts=3):
        full = [(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows]
        if clashing:
            full = [r + ("x",) * (len(CLASHING.fields) - 5) for r in full]
        return spark.createDataFrame(full, CLASHING if clashing else DOCS).repartition(parts)
    return make
