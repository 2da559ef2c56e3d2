"""Texts that operators must survive, and frames made of them."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

from forecourt.llm.common import prepared

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash long, shard string, n int"
NASTY = [
    None, "", " \t\n", "!?", "one", "two words", "é", "naïve façade Ünïcode 文字 😀", "a\x00b", "x " * 300, "\n\n\nline\n\nline\n",
    "\x85 a b", "The cat.\r\nThe cat.\rEnd", "tail without end ", "'s 't 123 !!! \n\n  x",
]


def prose(seed: int, words: int) -> str:
    """Words that hardly ever repeat between seeds."""
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 7))) for _ in range(words))


def documents(spark: SparkSession, texts: list[str | None], ids: list[int | None] | None = None) -> DataFrame:
    """A table with the columns of documents and some with names that operators use themselves."""
    prepared(spark)
    ids = list(range(len(texts))) if ids is None else ids
    data = [(i, t, "en", "src", 0 if t is None else len(t), 7, "mine", 1) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(data, SCHEMA)


def nasty(spark: SparkSession) -> DataFrame:
    """Every odd text, one very long one, repeated rows, shared and missing ids."""
    long = prose(1, 40_000)
    texts = [*NASTY, long, "same row", "same row", "shared id", "no id", None]
    return documents(spark, texts, [*range(len(NASTY)), 50, 60, 60, 3, None, None])
