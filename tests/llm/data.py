"""Small tables with the cases that every operator and stage has to take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "fp long, bucket long, position long, spans string, score double, label string, _row int"
)
WORDS = "the quick brown fox jumps over a lazy dog while seven wizards brew strong potions near cold rivers".split()


def prose(seed: int, count: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(count))


def odd_texts() -> list[str | None]:
    """Null, empty, blank, without letters, one word, very long, repeated, unusual characters."""
    return [
        None,
        "",
        "   \n\t ",
        "123 456 !!",
        "word",
        "é",
        "a" * 3_000,
        prose(1, 40_000),
        prose(2, 200),
        prose(2, 200),
        prose(2, 200).upper(),
        "ab" * 900,
        "naïve \U0001f600 ünïcode " * 30,
        "\x00 null \x7f bytes   here",
    ]


def documents(spark: SparkSession, texts: list[str | None]) -> DataFrame:
    """Documents with null ids, a repeated row, null columns and clashing extra columns."""
    rows = [
        (i, t, None if i % 5 == 0 else "en", None if i % 3 == 0 else "s", len(t) if t else None, 1, 2, 3, "x", 0.5, "l", 7)
        for i, t in enumerate(texts)
    ]
    if rows:
        rows += [rows[-1], (None, *rows[-1][1:]), (None, None, *rows[-1][2:])]
    return spark.createDataFrame(rows, SCHEMA)


def parquet(df: DataFrame, folder, name: str = "documents") -> str:
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
