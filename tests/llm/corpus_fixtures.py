from __future__ import annotations

import pytest

from forgepulse.sources.storage import Scratch

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def scratch(spark):
    with Scratch(spark) as folder:
        yield folder


@pytest.fixture()
def documents(spark):
    """Documents from texts or (doc_id, text) or (doc_id, text, lang, source) tuples."""
    def make(rows, schema=DOCUMENTS):
        full = []
        for i, row in enumerate(rows):
            row = (i, row) if row is None or isinstance(row, str) else row
            doc_id, text, lang, source = (*row, *("en", "s")[len(row) - 2:]) if len(row) < 4 else row
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, schema)

    return make
