from __future__ import annotations

import pytest

#: Columns that operators also use, so that a clash would show.
CLASHING = "row long, block string, size int, shard int, slot int, epoch int, weight double, host string, name string, level int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


@pytest.fixture
def documents(spark, tmp_path):
    """Writes (doc_id, text[, source]) rows as a table of documents with clashing columns."""

    def write(rows, files=2):
        full = []
        for row in rows:
            doc, text, source = (*row, "s")[:3]
            full.append((doc, text, "en", source, None, 7, "b", 1, 1, 1, 1, 1.0, "h", "n", 1))
        path = str(tmp_path / f"documents-{len(list(tmp_path.iterdir()))}.parquet")
        spark.createDataFrame(full, SCHEMA).repartition(files).write.parquet(path)
        return spark.read.parquet(path)

    return write
