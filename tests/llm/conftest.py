"""Small tables with what real ones hold: nulls, empty and long texts, ties, repeated rows, and columns whose names an operator uses itself."""

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row string, doc long, sig string, size int, n_lines int, keep string, ids string, "
    "component_id int, decoded string, kept string, text_crc32 int"
)


@pytest.fixture(scope="session")
def docs(spark):
    def make(rows):
        """Rows of (doc_id, text[, lang[, source]])."""
        full = [(*r, *([None] * (4 - len(r)))) for r in rows]
        extra = (None, 7, "s", 1, 2, "k", "i", 3, "d", "x", 4)
        return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *extra) for r in full], SCHEMA)

    return make


@pytest.fixture(scope="session")
def sf(request):
    return "/root/testdata/sf0.001"
