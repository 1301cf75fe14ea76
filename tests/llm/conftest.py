from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, lang[, source]]), with a further column whose name clashes with names used inside."""

    def make(*rows, extra="size"):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or ""), "x") for r in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, `{extra}` string").repartition(3)

    return make
