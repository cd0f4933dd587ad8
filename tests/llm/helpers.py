"""Small tables with every awkward case, and rows by id."""

import random

LONG = " ".join(f"word{k % 977} tail{k % 13}" for k in range(12_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark):
    """Nulls in any column, empty and very long texts, repeated rows, ties, columns with clashing names."""
    a = "The quick brown fox jumps over the lazy dog and then walks home along the river in the evening."
    rows = [
        (1, a, "en", "s1", len(a)), (2, a, "en", "s1", None), (3, a + " Again.", "en", None, 3), (4, None, None, None, None), (5, "", "en", "s1", 0), (6, "   \n\t ", "en", "s2", 6),
        (7, "one two", "en", "s2", 7), (8, "one two", "de", "s2", 7), (9, LONG, "en", "s1", len(LONG)), (9, LONG, "en", "s1", len(LONG)), (None, a, "en", "s1", 5), (10, "12345 !!", None, "s3", 8),
        (11, "Ünïcödé çàé 漢字 😀 ends", "fr", "s3", 4), (12, LONG + " more", "en", "s1", 1),
    ]
    extra = "kept boolean, component_id long, score double, spans string, replica int, value string, n_words long"
    return spark.createDataFrame([(*r, True, 5, 0.5, "x", 9, "v", 3) for r in rows], f"{SCHEMA}, {extra}")


def empty(spark, schema=SCHEMA):
    return spark.createDataFrame([], schema)


def prose(seed, n, words=60):
    rng = random.Random(seed)
    known = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(1, 8))) for _ in range(300)]
    return [" ".join(rng.choices(known, k=words)) for _ in range(n)]


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}
