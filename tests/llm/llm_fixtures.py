"""Small tables with the odd cases every operator has to take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Extra columns whose names operators use for themselves.
CLASHING = "spans string, base string, own string, node string, content string, copy string, n_copies string, kept string"


def documents(spark: SparkSession, rows: list[tuple], clashing: bool = True) -> DataFrame:
    """(doc_id, text, lang, source) rows as a documents table, with clashing columns behind."""
    full = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows]
    if not clashing:
        return spark.createDataFrame(full, DOCUMENTS)
    return spark.createDataFrame([(*row, *["x"] * 8) for row in full], f"{DOCUMENTS}, {CLASHING}")


def sentences(seed: int, words: int, vocabulary: int = 400) -> str:
    chance = random.Random(seed)
    return " ".join(f"w{chance.randrange(vocabulary)}" for _ in range(words))


def odd_rows() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows."""
    long = sentences(1, 20_000)
    return [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \n\t ", "en", "a"),
        (4, long, "en", "a"),
        (5, long, "en", "a"),
        (5, long, "en", "a"),
        (None, "no id here but some words", "en", "b"),
        (6, "one two", None, "b"),
        (7, "!!! ... ???", "de", None),
        (8, "🙂 ünïcödé\r\n\x0b text  <|endoftext|> ", "de", "b"),
    ]


def empty(spark: SparkSession) -> DataFrame:
    return documents(spark, [])
