import pytest

DOCS = "doc_id long, text string"
#: Extra columns whose names operators use themselves.
EXTRA = ("doc_id long, text string, key string, row string, c long, k1 long, k2 long, ranges string, label int, "
         "score string, n_words string, features string, spans string, n_chars long, `a.b c` string")


@pytest.fixture(scope="session")
def spark():
    from lexitrend.session import get_spark
    return get_spark("local[4]", shuffle_partitions=4, app_name="lexitrend-llm-tests")


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text) as a table; with ``extra`` it has further columns with clashing names."""
    def make(rows, extra=False):
        if not extra:
            return spark.createDataFrame(rows, DOCS)
        more = ("x",) * 2 + (1, 2, 3) + ("x", 0) + ("x",) * 4 + (7, "x")
        return spark.createDataFrame([(*r, *more) for r in rows], EXTRA)
    return make


def words(n, seed=0, size=5):
    """n made-up words."""
    import random
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(size)) for _ in range(n)]
