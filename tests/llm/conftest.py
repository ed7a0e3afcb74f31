import pytest

import public_tokenizers

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def vocabulary():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, columns with clashing names."""
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, "a b c d e f g h i j k", "en", "s"), (1, "a b c d e f g h i j k", "en", "s"), (None, None, None, None), (2, "", "en", None), (3, " \n\t ", None, "s"), (None, "a b c d e f g h i j k", "en", "s"), (4, long, "en", "s"), (4, "other text", "de", "s"), (5, "x", "en", "s")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_words string, labels string, start string, ids binary, fingerprint string"
    return spark.createDataFrame([(*r, len(r[1] or ""), "clash", "clash", "clash", b"clash", "clash") for r in rows], schema)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENT)
