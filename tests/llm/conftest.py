import pytest


@pytest.fixture
def documents(spark):
    """``documents(rows)``: rows of doc_id, text and optionally lang and source, odd columns added."""

    def make(rows):
        full = [tuple(row) + (None,) * (4 - len(row)) + (0, "x", 1) for row in rows]
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long,"
            " size string, score int"
        )
        return spark.createDataFrame(full, schema)

    return make
