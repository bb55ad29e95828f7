import pytest


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """A checkpoint folder of the tests' own, and the settings of the text operators."""
    from foldspark.llm.shared import prepare

    folder = str(tmp_path_factory.mktemp("shared"))
    spark.sparkContext.setCheckpointDir(folder)
    prepare(spark)
    return folder


ODD_TEXTS = [
    None, "", " ", "a", "one two", "tab\tand\nline", "  doubled  blanks\n\n\nlines ", "É à ß", "x" * 6000, "日本語 テキスト　空白",
    "<|endoftext|> inside <|endoftext|>", "it's we'LL 12,345.67 ...", "a b", "end\n", "\r\n x", "İstanbul ΑΣ á",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows with nulls, empty, long and repeated texts, and columns that clash with results."""
    rows = [(i, t, "en", None if i % 3 else "src", len(t or ""), "x") for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, "a", "en", "src", 1, "x"), (None, "null id", None, None, None, "x"), (None, "a", None, None, None, "x")]
    names = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    return spark.createDataFrame(rows * 1, names)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
