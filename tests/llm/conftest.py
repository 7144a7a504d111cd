import pytest
from hypothesis import settings

from clickflow.llm.common import ship

# Examples have no time limit: one that reads a vocabulary file takes 0.2 s or more on a slow machine.
settings.register_profile("untimed", deadline=None)
settings.load_profile("untimed")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source, lang), with columns whose names
    operators use themselves."""

    def build(*rows):
        kinds = "doc_id long, text string, lang string, source string, n_chars long, component string, host int, label string"
        full = []
        for row in rows:
            doc, text, source, lang = (*row, *("src", "en")[len(row) - 2 :])[:4]
            full.append((doc, text, lang, source, None if text is None else len(text), "c", 1, "l"))
        return spark.createDataFrame(full, kinds)

    return build
