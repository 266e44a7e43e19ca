import pytest
from pyspark.sql import types as T


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) pairs, with columns of clashing names."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           *[T.StructField(name, T.StringType())
                             for name in ("id", "keep_id", "digest", "bucket", "rate", "component", "shard", "source")]])

    def make(*rows):
        return spark.createDataFrame([(i, text, *["x"] * 8) for i, text in rows], schema)
    return make


def words(n, seed=0, pool=5000):
    """Invented prose: n words of a fixed pseudo-random sequence."""
    import random

    chooser = random.Random(seed)
    return [f"w{chooser.randrange(pool)}" for _ in range(n)]


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (6, "one two three four"), (7, "é É ÉÉ ß İ Σας"),
    (8, "same same same same same same same same same same"), (8, "same same same same same same same same same same"),
    (None, "no number here at all"), (None, None), (9, "a\x00b\x1cc d　e <|endoftext|> <|EndOfText|>"),
    (10, " ".join(words(20_000, 3))), (11, "x" * 50_000), (12, "line\n" * 300),
]
