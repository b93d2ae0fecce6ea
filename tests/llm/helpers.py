"""Fixtures for the corpus operators: awkward rows that every operator must take."""

from __future__ import annotations

LONG = "Wort für wort, " * 4000

AWKWARD = [
    (1, "The first line of text, it's long enough to count.\nAnd here is a second one."),
    (2, None),
    (3, ""),
    (4, "   \t\n \n"),
    (5, "The first line of text, it's long enough to count.\nAnd here is a second one."),
    (5, "The first line of text, it's long enough to count.\nAnd here is a second one."),
    (None, "a row without an id, and with some words of its own"),
    (6, LONG),
    (7, "x" * 3000),
    (8, "Éçà ΣΑΣ İstanbul ﬁn 12 345    é <|endoftext|>tail <|startoftext|> 日本語 🙂🙂"),
    (9, "short"),
]


def frame(spark, rows=AWKWARD):
    """documents with further columns whose names clash with what operators make."""
    data = [(i, t, f"s{k % 2}" if k % 5 else None, "en", "?", 0, None) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(
        data, "doc_id long, text string, source string, lang string, fingerprint string, part int, score double")


def rows_of(df):
    return [tuple(r) for r in df.collect()]
