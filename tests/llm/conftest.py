import pytest

from tidemark.llm import queries as q

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def texts(spark):
    """(doc_id, text) of the small documents, as a list."""
    return [tuple(r) for r in q.table(spark, MIDDLE, "documents").select("doc_id", "text").collect()]


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
