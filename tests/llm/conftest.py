import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def texts(spark):
    """Odd rows: nulls, empty and blank texts, repeats, a long text, columns with names that operators use inside."""
    long = " ".join(f"w{i % 977}" for i in range(30000))
    rows = [
        (1, "The cat sat on the mat and looked at the dog for a very long time before it went home again today"),
        (2, None), (3, ""), (4, " \t\n "), (5, "one"), (5, "one"), (None, "no id here"), (None, "no id here"), (6, long),
        (7, "Ünï cödé 文字 🙂   x\r\ny"), (8, "<s>[INST] hi [/INST]</s> \\ \\<s>"),
        (9, "The cat sat on the mat and looked at the dog for a very long time before it went home again today"),
    ]
    data = [(i, t, "en", "s", 0, 1.5, "x", "y") for i, t in rows]
    return spark.createDataFrame(
        data, "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, rejected_by string"
    )


@pytest.fixture(scope="session")
def no_texts(texts):
    return texts.limit(0)
