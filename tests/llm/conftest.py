import pytest

CLASHING = "doc_id long, text string, lang string, n long, part long, block long, node long, bits long, key long, word string, n_tokens string, _text string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls, empty and long texts, repeated rows and columns that sound like an operator's own."""
    prose = " ".join(f"w{i % 97}x{i % 89}" for i in range(300))
    texts = [
        (1, prose), (2, None), (3, ""), (4, " \t\n\x0b "), (5, prose + " and more"), (6, "one"), (7, "two words"),
        (8, "é" * 120 + " ünïcödé 日本語 🙂 " * 30), (9, "é" * 119 + "è" + " ünïcödé 日本語 🙂 " * 30), (10, "x" * 70_000 + " end"),
        (11, "ab " * 60_000), (12, prose), (12, prose), (None, prose), (None, None), (13, "a\x00b c " * 20), (14, "ab " * 60_000 + "tail"),
        (15, "<|start|>user</s>[INST]\\n"), (16, prose.upper()),
    ]
    rows = [(i, t, None if k % 5 == 0 else "en", 1, 2, 3, 4, 5, 6, "w", "t", "own") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, CLASHING)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], CLASHING)
