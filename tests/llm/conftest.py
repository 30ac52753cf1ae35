import random

import pytest

KINDS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Rows (doc_id, text[, lang[, source]]) as a documents table, with extra columns of clashing names."""

    def make(rows, extra=True):
        full = [(r[0], r[1], *(r[2:3] or ("en",)), *(r[3:4] or ("s",)), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, KINDS)
        if extra:
            for name in ("row", "key", "size", "score", "kept", "n", "tid", "bucket"):
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


def words(rng, n, pool=2000):
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


@pytest.fixture
def awkward():
    """Nulls, empty, blank, tiny and very long texts, ties and repeated rows."""
    rng = random.Random(3)
    long = " ".join(words(rng, 30000))
    base = " ".join(words(rng, 300))
    near = base.replace(" ", " ", 1).rsplit(" ", 1)[0] + " other"
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "a b c"), (6, long), (7, long), (8, base),
        (9, base.replace(" ", "\n\t", 5)), (10, near), (11, "naïve Ünïcode 漢字 don't 🙂\x0b x y"),
        (8, base), (None, base), (None, None), (12, "line one\nline two\nline one\n\nline one"),
        (13, "a b c d e " * 40), (14, "x" * 5000), (15, base + " " + base),
    ]
