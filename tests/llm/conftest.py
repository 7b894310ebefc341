import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the cat of the house and a dog in the garden with many words " * 3000


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and equal ids."""
    rows = [(1, "The cat sat on the mat. The dog ran.", "en", "a", 1), (2, "the CAT sat on the mat. The dog ran.", "en", "a", 1), (3, "Le chat est sur la table avec le chien.", "fr", None, None), (4, None, "en", "a", 0), (5, "", "fr", "b", 0), (6, " \n\t ", None, "b", 3), (7, "123 !!! ...", "en", "b", 9), (8, LONG, "en", "c", len(LONG)), (9, "The cat sat on the mat. The dog ran.", None, "c", 1), (9, "The cat sat on the mat. The dog ran.", None, "c", 1), (None, "Der Hund ist in dem Haus und die Katze auch.", "de", "c", 1), (10, "x", "de", "c", 1), (10, "y　z é日", "de", "c", 1), (-3, "Die Katze und der Hund sind in dem Garten.", "de", "d", 2)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def real(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def rows_of():
    return texts
