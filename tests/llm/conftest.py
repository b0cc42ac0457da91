"""Small tables with the awkward rows: NULLs in any column, empty and
very long texts, ties, repeated rows, and an extra column whose name an
operator uses itself."""

from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    def make(rows, extra: str | None = None):
        """rows: (doc_id, text[, lang[, source]])."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", 0) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in (extra or "").split():
            df = df.selectExpr("*", f"'x' as {name}")
        return df
    return make
