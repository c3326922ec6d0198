import pytest

# Names that operators use inside, as columns of the caller's table.
EXTRA = "key string, id string, chunk int, match string, toxicity string, node int, _match string"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names clash."""

    def make(rows, partitions=3):
        extra = ("k", "i", 1, "m", "t", 2, "_")
        df = spark.createDataFrame([(i, t, *extra) for i, t in rows],
                                   f"doc_id long, text string, {EXTRA}")
        return df.repartition(partitions) if rows else df

    return make


LONG = " ".join(f"w{n % 700}" for n in range(30_000))
HARD = [(1, None), (2, ""), (3, "a b"), (4, LONG), (5, LONG), (5, LONG), (None, "a b"),
        (6, " \t\n"), (7, "Ünïcode wörds  and\x00nul"), (8, "a b"), (9, "x" * 3000)]


@pytest.fixture(scope="session")
def hard():
    return list(HARD)
