import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

#: Names that the operators use for columns of their own.
CLASHING = ("content", "digest", "key", "rep", "path", "score", "label", "kind", "version", "spans", "base", "keep_id",
            "_stay", "host", "ids", "length", "start", "sequence_id", "_class", "kept", "text_sha256")


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, lang, source]) with the table's columns and clashing ones."""
    names = ", ".join(f"`{c}` string" for c in CLASHING)

    def make(*rows, extra=True):
        schema = "doc_id long, text string, lang string, source string, n_chars long" + (f", {names}" if extra else "")
        full = [(*r, None, None)[:4] for r in rows]
        return spark.createDataFrame(
            [(*r, None if r[1] is None else len(r[1]), *(["x"] * len(CLASHING) if extra else [])) for r in full], schema)

    return make


@pytest.fixture(scope="session")
def odd(docs_of):
    """Null, empty, blank, long and repeated texts, ties, and a null in each column."""
    long = " ".join(f"word{i % 977} tail" for i in range(30_000))
    return docs_of(
        (None, "a text without an id, of nine words in all"), (1, None, "en", None), (2, "", None, "a"), (3, " \n\t\x0b ", "en", "a"),
        (4, long, "en", "a"), (5, "the same text stands here twice and is short", "en", "b"),
        (6, "the  same text stands here twice\nand is short", "en", "b"),
        (6, "the  same text stands here twice\nand is short", "en", "b"), (7, "x", "de", "b"), (8, "é́ ß 日本語 \U0001f600 ok", None, None))


@pytest.fixture(scope="session")
def labels_of(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")

    return make
