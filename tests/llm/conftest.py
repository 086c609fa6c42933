import pytest

# Ids that repeat and are null, texts that are null, empty, blank, long, repeated; clashing columns.
BLOCK = " ".join(f"word{i}" for i in range(120))
AWKWARD = [
    (1, f"{BLOCK}\nshared line that is long enough\nown one", "a"),
    (2, f"intro {BLOCK}\nShared line that is long enough \n", "a"),
    (3, f"{BLOCK}\nshared line that is long enough\nown one", None),
    (3, f"{BLOCK}\nshared line that is long enough\nown one", None),
    (4, None, "b"),
    (5, "", "b"),
    (6, " \t\n\r ", None),
    (None, f"{BLOCK}\nshared line that is long enough", "b"),
    (None, None, None),
    (7, "same " * 30000, "c"),
    (8, "same " * 300 + BLOCK.upper(), "c"),
    (8, "two words", "c"),
    (9, "two words", "c"),
    (10, "Ärger über café — naïve façade x y ñandú", "d"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(*r, i, "x", 1, "y") for i, r in enumerate(AWKWARD)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, node long, hash string, n_words int, lang string").repartition(3)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
