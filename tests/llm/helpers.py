"""Frames and words for the small tests."""

import random


def documents(spark, rows):
    """Rows of (doc_id, text) with the other columns of documents, some null, and two columns with names the operators use themselves."""
    full = [(d, t, "en" if i % 3 else None, "src" if i % 2 else None, len(t) if t is not None else None, i, "x") for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, shard int, c0 string")


def prose(rng: random.Random, n: int, vocabulary: int = 300) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


#: Null and empty texts, white space, ties, repeated rows, null ids, a long text.
ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "a b c d e f g h"), (None, None), (4, "a b c d e f g h"), (4, "a b c d e f g h"), (5, "Long " * 20000), (6, "é中🙂\r\nx"), (7, "\x00\x7f")]
