"""Small tables with the awkward cases every operator has to stand."""

import os
import tempfile

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def sentence(n: int, seed: int = 0) -> str:
    return " ".join(WORDS[(i * i + seed * 7 + i // 3 + (seed + i) % 5) % len(WORDS)] + ("." if i % 9 == 8 else "") for i in range(n))


def awkward_documents(spark):
    """doc_id, text, lang, source, n_chars, and columns whose names operators use themselves."""
    rows = [
        (1, sentence(60, 1), "en", "a", 0), (2, sentence(60, 1), "en", "a", 0), (3, None, None, None, None), (4, "", "en", "a", 0),
        (5, " \t\x0b\n ", "en", "b", 0), (6, "One", "en", "b", 0), (7, "one two\x1cthree é ﬁ 你好 🙂", "fr", "b", 0),
        (8, "\n".join([sentence(12, 2)] * 6), "en", "hot", 0), (9, sentence(20_000, 3), "en", "hot", 0), (10, "x" * 100_000, "en", "hot", 0),
        (11, "#$% " * 40, "en", "hot", 0), (12, "Licensed under the Apache License, Version 2.0.", "en", "hot", 0),
        (None, sentence(30, 4), "en", "hot", 0), (13, sentence(30, 5), "en", "hot", 0), (13, sentence(30, 5), "en", "hot", 0),
        *[(100 + i, sentence(40, 6), "en", "hot", 0) for i in range(30)],
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, schema)


def folder(spark, **tables) -> str:
    """A folder with these tables as Parquet."""
    top = tempfile.mkdtemp(prefix="run-")
    for name, df in tables.items():
        df.coalesce(2).write.parquet(os.path.join(top, f"{name}.parquet"))
    return top
