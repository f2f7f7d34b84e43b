import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tests_llm_data import prose  # noqa: E402

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score string, tokens string,"
    " fp string, root string, found string, content string, bucket string, votes string, keep string,"
    " weight string, tails string, rated string, clean string, mix string")
ODD_IDS = [1, 2, 3, 4, 5, 6, 6, 7, None, None, 8, 9]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows and ids, clashing names."""
    shared = prose(3)
    texts = [
        prose(1), prose(1), None, "", " \n\t ", "twice", "twice", "other " + shared, prose(5), None,
        ("long " + prose(9) + "\n") * 3000, "x" * 700_000]
    rows = [
        (i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}",
         None if t is None else len(t), *["clash"] * 14)
        for k, (i, t) in enumerate(zip(ODD_IDS, texts))]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 0, None), (None, 1, 1), (7, None, 1), (8, 1, 1), (8, 1, 1), (9, 0, 0)],
        "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
