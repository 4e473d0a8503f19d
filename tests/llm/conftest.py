import pytest
from hypothesis import settings
from llm_helpers import WORDS

settings.register_profile("llm", deadline=None)
settings.load_profile("llm")

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use for their own columns or results.
    "size long, score double, kept boolean, fp long, row long, _draw long, target string, fingerprint string, secrets string, unit long"
)

@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and long texts, ties, repeated rows and neighbours of equal text."""
    long = " ".join(WORDS[(i * i + i // 7) % len(WORDS)] + str(i % 97) for i in range(6000))
    texts = [
        None, "", " \t\n", "One word", "one WORD", "a", " ".join(WORDS), " ".join(WORDS).upper(), long, long + " end",
        "ÄÖ äö \x1c x\xa0y", "🎉🎉 𝒳 " * 40, "x" * 9000, " ".join(WORDS * 3), " ".join(WORDS * 3),
        "Released under the MIT License.\nnothing else", "\n\n" + " ".join(WORDS[::-1]), "123 456 ---",
    ]
    rows = [(i, t, ("en", "de", None)[i % 3], ("b", None, "a", "é")[i % 4], i) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (6, "same id, other text", None, "a", 0), (None, "no id", "en", "a", 0), (None, None, None, None, None)]
    return [(*r, 1, 0.5, True, 7, 8, 9, "t", "f", "s", 3) for r in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
