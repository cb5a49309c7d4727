import pytest


@pytest.fixture()
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and an extra column."""
    long = " ".join(f"word{i % 997} and" for i in range(6000))
    passage = " ".join(f"p{i}assage{i * 7 % 101}" for i in range(90))
    rows = [(1, "The quick  brown fox, jumps!", "a"), (2, None, "a"), (3, "", None), (None, "no id at all here", "b"),
            (5, long, "b"), (6, long, "b"), (7, "x" * 5000, "c"), (8, "x" * 5000, "c"), (9, "short", "a"), (9, "short", "a"),
            (10, "lead in. " + passage + " tail one", "a"), (11, "another opening of text. " + passage + " other", "c"),
            (12, "naïve café ▁ 中文 \U0001d11e \x00 end\n", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as fp", "2 as n", "3 as s")
