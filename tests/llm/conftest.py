import random

import pytest

SMALL = "/root/testdata/sf0.001"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


ODD_TEXTS = [None, "", "   ", "\n\n\t", "one", "Two words", "tail \x1c\x85\xa0x", "é" * 300, "日本語 テキスト 😀 " * 40,
             "same same same same same same same same same same same same", "a" * 12000, "long " * 9000]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls in every column, odd texts, repeated rows and clashing column names."""
    rng = random.Random(7)
    rows = [(i, t, "en", f"src{i % 3}", len(t or ""), "x", i) for i, t in enumerate(ODD_TEXTS)]
    rows += [(100 + i, words(rng, 60), None, None, None, None, None) for i in range(10)]
    rows += [(None, "no id here at all", "en", "src1", 5, "x", 1)] * 2
    rows += [(100, words(rng, 50), "en", "src1", 5, "x", 1)]  # an id again, with another text
    rows += [rows[5]] * 3  # repeated rows
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                 "spans string, _key long").withColumnRenamed("spans", "fingerprint")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
