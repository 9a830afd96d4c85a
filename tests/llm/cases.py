"""Small tables with the cases that every operator must bear."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sentence(rng: random.Random, n: int, words: list[str]) -> str:
    return " ".join(rng.choice(words) for _ in range(n))


def edge_texts(seed: int = 1) -> list[str | None]:
    """Null, empty, blank, other spaces, repeats, long lines, non-Latin text, one very long text."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Straße", "niño", "être", "слово", "a", "x1", "don't", "end."] + [f"w{i}" for i in range(40)]
    long = sentence(rng, 30_000, vocabulary)
    same = sentence(rng, 120, vocabulary)
    return [None, "", " \t\n", "a", "a  b c\x0bd \n\n e", same, same, same + " tail", "head " + same, long,
            "line one\nline one\n\nline two\nline one", "x " * 300, "é" * 700, "😀 emoji 😀", "no<|endoftext|>special  <|endoftext|> x",
            *[sentence(rng, rng.randint(1, 200), vocabulary) for _ in range(40)]]


def edge_docs(spark, seed: int = 1, extra: bool = False):
    """The texts as documents: a hot source, null source and lang, repeated rows and, if asked for, clashing columns."""
    rows = [(i, t, [None, "en", "de"][i % 3], None if i % 7 == 0 else ("hot" if i % 3 else f"s{i % 5}"), 0)
            for i, t in enumerate(edge_texts(seed))]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        from pyspark.sql import functions as F

        for name in ("n_words", "kept", "size", "target", "_key", "_text", "block", "piece", "taken", "_lane"):
            df = df.withColumn(name, F.lit("x"))
    return df


def stored(df, folder) -> str:
    """``df`` as the documents table of a new data folder."""
    df.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return str(folder)
