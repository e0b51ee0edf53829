import pytest

NASTY = [  # (doc_id, text): null id, null and empty and blank texts, ties, repeated rows, odd characters, a long text
    (1, "The quick brown fox jumps over the lazy dog and runs away from the angry bear tonight"),
    (2, "The quick brown fox jumps over the lazy dog and runs away from the angry bear tonight"),
    (2, "The quick brown fox jumps over the lazy dog and runs away from the angry bear tonight"),
    (3, None), (4, ""), (5, " \t\n "), (6, "one"), (7, "two words"), (None, "a row without an id"), (8, "éa ñ ß 漢字 \x00   x"),
    (9, "<|endoftext|> inside <|endoftext|>"), (10, "it's don't  a   b\n\n c\td  "), (11, "w" * 4000),
    (12, " ".join(f"word{i % 700}" for i in range(60_000)))]


@pytest.fixture()
def nasty(spark):
    """Documents with awkward rows, and extra columns whose names the operators use inside."""
    rows = [(i, t, "id", 1, "x", [1], 2.0) for i, t in NASTY]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, size int, fp string, ids array<int>, "
                                       "score double")


@pytest.fixture()
def empty(nasty):
    return nasty.limit(0)
