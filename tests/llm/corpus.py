"""Small corpora with the cases that every operator must handle."""

import random

# Names that operators use themselves.
EXTRA = ["kept", "n_words", "digest", "class", "_key", "_text", "spans"]


def awkward(spark, texts, *, repeat=True):
    """Rows with ids, extra columns with clashing names, a null id, null and empty texts, and repeated rows."""
    rows = [(i, t) for i, t in enumerate(texts)] + [(9001, None), (9002, ""), (9003, " \n\t "), (None, "a text without id")]
    if repeat:
        rows += rows[:3] + rows[-1:]
    rows = [(i, t, *range(len(EXTRA))) for i, t in rows]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` int" for c in EXTRA)
    return spark.createDataFrame(rows, schema)


def words(seed, n, vocabulary=400):
    pick = random.Random(seed)
    return [f"w{pick.randrange(vocabulary)}" for _ in range(n)]


def prose(seed, n, vocabulary=400):
    return " ".join(words(seed, n, vocabulary))


def empty(df):
    return df.limit(0)
