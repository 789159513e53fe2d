import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """A frame of documents with an extra column of a clashing name, from (doc_id, text[, lang, source])."""
    def make(rows):
        full = [(r[0], r[1], (r[2] if len(r) > 2 else "en"), (r[3] if len(r) > 3 else "s"), 0, -1) for r in rows]
        return spark.createDataFrame(full, DOCS + ", component_id long").repartition(3)
    return make
