import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, words_ string, fp string, score string, block_ int, mix string, quality string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and column names that the operators use themselves."""
    prose = "The cat and the dog of the house is in a tree by the road to town with some old friend of ours today"
    texts = [None, "", "  \n\t ", prose, prose, "Short one.", "x" * 200_000, f"{prose}. " * 3000, "der die und den von das\nder die und den von das\nzzz", "\U0001f600 é ñ \x00 <s> [INST] \\ </s>", "All rights reserved.\n" + prose, "😀" * 50]
    rows = [(i, t, lang, "s", None, "w", "f", "s", 1, "m", "q") for i, (t, lang) in enumerate(zip(texts, ["en", None, "de", "en", "en", "xx", "fr", "en", "de", "es", "en", None], strict=True))]
    rows += [rows[3], rows[3], rows[0], (None, prose, None, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none_at_all(spark):
    return spark.createDataFrame([], SCHEMA)
