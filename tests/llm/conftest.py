import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    from churnlens.session import ship_package

    ship_package(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


PASSAGE = " ".join(f"pass{i}" for i in range(20))
ODD_TEXTS = [
    (1, "", "a"), (2, None, "a"), (3, " \t\n ", "b"), (4, "One", "b"), (5, "one TWO", None), (6, "one two", "a"),
    (7, f"start here {PASSAGE} end of it", "a"), (8, f"{PASSAGE}", "c"), (9, f"x y z {PASSAGE} {PASSAGE}", "c"),
    (9, f"x y z {PASSAGE} {PASSAGE}", "c"), (None, f"x y z {PASSAGE} {PASSAGE}", "c"), (None, None, None),
    (10, "it's they'll  we've  'tis 　x\ty !?'s 12½ Été 你好 \U0001f600 a\x00b \r\n end  ", "é"),
    (11, "word " * 30000, "d"), (12, "n" * 5000 + " " * 3000 + "!" * 4000, "d"), (13, "a b c d e f g h i j k l m", "z"),
    (14, "a b c d e f g h i j k l m", "z"), (15, "B a b c d e f g h i j k l m q", "z"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns that clash with results."""
    rows = [(i, t, s, "en", None if t is None else len(t), 0.5, "x", 1) for i, t, s in ODD_TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, score double, bucket string, size int")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
