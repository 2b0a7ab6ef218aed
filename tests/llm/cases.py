"""Small inputs with the awkward rows that every operator must take."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n int, h long, words string, tag string"


def docs(spark, texts, langs=None):
    """A documents table from texts or (doc_id, text) pairs, with clashing extra columns."""
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    rows = [
        (i, t, (langs or ["en"])[k % len(langs or ["en"])], "s", None if t is None else len(t), 7, 8, "x", "y")
        for k, (i, t) in enumerate(pairs)
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def awkward(spark, sample="some plain text"):
    """Null, empty, blank and very long texts, repeated rows and a null doc_id."""
    long_text = " ".join(f"w{i % 977}{i}" for i in range(60_000))
    return docs(spark, [
        (1, None), (2, ""), (3, " \t\n "), (4, sample), (4, sample), (5, long_text), (None, sample), (None, None), (6, "x"),
    ])


def by_id(df):
    """{doc_id: list of rows without the id}, sorted."""
    out = {}
    for r in df.collect():
        d = r.asDict()
        out.setdefault(d.pop("doc_id"), []).append(d)
    return out


def prose(rng: random.Random, n: int, vocabulary=400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
