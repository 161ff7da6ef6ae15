"""Fixtures of the document tests: small tables with the awkward cases."""

import pytest

AWKWARD = [None, "", " \n\t ", "one", "Üben é ñ 😀 ß", "x" * 30_000, "word " * 6_000]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, empty and very long texts, repeated rows and extra, clashing columns."""
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 2 else "s", 1, "k") for i, t in enumerate(AWKWARD)]
    rows += rows[3:5] + [(None, None, None, None, None, None), (None, "one", None, None, None, None)]
    names = "doc_id long, text string, lang string, source string, n_chars long, key string"
    extra = spark.createDataFrame(rows, names).selectExpr(
        "*", "'c' as copy", "'h' as hash", "'p' as place", "1 as size", "'f' as fp", "array(1) as blocks", "'t' as id", "map('k', 1) as m"
    )
    return extra


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.where("false")
