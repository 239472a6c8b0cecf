import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use inside.
CLASHING = ("row", "id", "norm", "hash", "salt", "found", "gone", "kinds", "block", "times", "fp", "node", "HASH_", "tokens")


def prose(seed: int, n: int) -> str:
    """n words that the seed decides."""
    out = []
    for i in range(n):
        seed = (seed * 1103515245 + 12345) % 2**31
        word = "".join(chr(97 + (seed >> s) % 26) for s in (3, 7, 11, 15, 19)[: 2 + seed % 4])
        out.append(word + ("." if i % 11 == 10 else "\n" if i % 31 == 30 else ""))
    return " ".join(out)


ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n\x0b\x0c\r ", "en", "a", 7),
    (4, "word", "en", "a", 4),
    (5, prose(5, 90), "en", "a", 1),
    (6, prose(5, 90).replace(" ", " \t "), "en", "b", 1),
    (7, prose(5, 90), "de", "b", 1),
    (7, prose(5, 90), "de", "b", 1),  # a repeated row
    (8, prose(8, 300).replace("a", "ä"), "de", None, 1),
    (9, "x" * 70_000, "en", "a", 70_000),
    (10, prose(10, 40) + " ### $$$ " + prose(10, 40), None, "c", 1),
    (11, "1234 5678 !!", "en", "c", 12),
    (12, "日本語 \U0001f600 é ﬁ", "en", "c", 9),
    (13, prose(13, 4000), "fr", "a", 1),
    (14, prose(13, 2000) + " other " + prose(14, 100), "fr", "a", 1),
    (None, "a text without id", "en", "a", 1),
    (None, prose(5, 90), "en", "a", 1),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, COLUMNS)


@pytest.fixture
def crowded(odd):
    """With further columns of clashing names."""
    return odd.selectExpr("*", *(f"'{c}' as `{c}`" for c in CLASHING))


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture
def given(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def rows(df) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]
