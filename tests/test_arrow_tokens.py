import random

from pyspark.sql import functions as F

from quartergrid.functions.text import arrow_tokens, lowered, tokens

PIECES = ("a", "B", "É", "-", " ", " - ", ".", "\\", "[", "}", "?", "\n", "ΑΣ", "İ", "K")


def texts(n, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 16))) for _ in range(n)] + [None, ""]


def test_arrow_tokens_are_the_tokens(spark):
    df = spark.createDataFrame([(t,) for t in texts(3000)], "text string")
    low = df.select(lowered(F.col("text")).alias("low"), tokens(F.col("text")).alias("want")).toArrow()
    want = low.column("want").to_pylist()
    got = low.column("low").combine_chunks()
    for first, last in ((0, len(want)), (70, 900), (len(want) - 2, len(want)), (5, 5)):
        words, counts = arrow_tokens(got.slice(first, last - first))
        assert counts.tolist() == [len(w) for w in want[first:last]]
        assert words.to_pylist() == [t for w in want[first:last] for t in w]
