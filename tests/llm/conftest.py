from __future__ import annotations

import pytest

WORDS = "the of and river stone light house under winter garden silver morning paper window mountain bridge letter corner harbour market".split()


def sentence(seed: int, n: int, vocabulary: list[str] = WORDS) -> str:
    """Words that look random but repeat in every run."""
    out, state = [], seed * 7919 + 13
    for _ in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(vocabulary[(state >> 8) % len(vocabulary)] + ("" if state % 3 else str(state % 50)))
    return " ".join(out)


BASE = sentence(1, 120)
PASSAGE = sentence(99, 60)
#: doc_id, text, lang, source: nulls, empty and long texts, copies, near copies, shared passages, odd characters.
ROWS = [
    (1, BASE, "en", "a"),
    (2, BASE, "en", "a"),
    (3, BASE.replace("river", "lake", 1), "en", "b"),
    (4, sentence(2, 80) + "\n" + PASSAGE + "\n" + sentence(3, 30), "en", "b"),
    (5, sentence(4, 50) + "\n" + PASSAGE, "de", "b"),
    (6, None, None, None),
    (7, "", "fr", "c"),
    (8, "   \n\t\n", "fr", "c"),
    (9, "word", None, "c"),
    (10, "Größe über Straße, naïve café — 東京 \x1c odd space here!! it's 2024 <|endoftext|> x", "de", "a"),
    (11, " ".join([sentence(5, 40)] * 30), "en", "a"),
    (12, sentence(6, 9000), "en", "a"),
    (13, "one line here\nanother line there\none line here\nONE LINE HERE", "en", None),
    (14, "x" * 30000, "en", None),
    (15, "?!? ... 12 34", "es", "é"),
    (16, BASE.upper(), "en", "a"),
    (None, "no id at all\none line here", "en", "a"),
    (2, BASE, "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def docs(spark):
    """The rows over three partitions, with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    extra = {name: F.lit("extra") for name in ("n_chars", "doc", "gone", "row", "place", "repeats", "range", "node", "n", "unit", "below", "size")}
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).withColumns(extra)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
