import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long, k long, row string, shard string, bucket int"


def documents(spark, rows):
    """(doc_id, text, source) as a documents table with columns whose names
    the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 7, "x", "y", 3) for i, t, s in rows], DOC)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties and repeated rows."""
    prose = " ".join(f"word{i % 97} and{i % 31} more{i}" for i in range(60))
    rows = [
        (1, prose, "a"), (2, prose, "a"), (2, prose, "a"), (3, prose.replace("more7 ", "other "), "b"), (None, prose, None),
        (4, None, "a"), (5, "", None), (6, " \n\t\n ", "b"), (7, "one", "b"), (7, "two words", "b"), (None, None, None),
        (8, "x" * 50_000, "c"), (9, "a line\n" * 3_000, "c"), (10, " ".join(f"t{i}" for i in range(30_000)), "c"), (11, "é ü 字 😀   \x0b word", "é"),
    ]
    return documents(spark, rows)


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (2, 0, 0), (9, 0, 0), (10, 1, None), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def items(spark):
    return spark.createDataFrame([(1, "word1 and1 MORE1 word2 and2 more2"), (2, None), (3, ""), (None, "one"), (4, "one"), (4, "nothing here"), (5, "t5 t6 t7 t8 t9 t10 t11 t12 t13 t14 t15")], "item_id long, text string")
