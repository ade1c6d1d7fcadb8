"""Small tables for the tests: invented words, and rows with every odd case."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, h string, key int, score string, words int"


def words(n: int, seed: int, stems: str = "aeiou") -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("bcdfglmnprst") + rng.choice(stems) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def row(doc_id, text, lang="en", source="s0"):
    """A row of documents with extra columns whose names the operators use themselves."""
    return (doc_id, text, lang, source, None if text is None else len(text), "x", 1, "y", 2)


def odd_rows(start: int) -> list[tuple]:
    """Null, empty, blank, tiny, repeated and very long texts; null language and source."""
    long_text = " ".join(words(30_000, 99))
    return [
        row(start, None), row(start + 1, ""), row(start + 2, " \t\n\x0b\f\r "), row(start + 3, "one"), row(start + 4, "x" * 5000),
        row(start + 5, long_text, None, None), row(start + 6, "né à  l’été —", None, "s1"), row(start + 6, "né à  l’été —", None, "s1"),
        row(start + 7, "123 456 ***"),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)
