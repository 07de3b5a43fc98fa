import random

import pytest

#: Column names that the operators use inside.
CLASHING = "uid long, key long, cls long, block int, kind string, part int, guest int, found string, n_shingles long, component_id long, train boolean, value double, held_out boolean, score double, template int, pos long, tree long, path long, node long, rank int, ids string, runs string, hits string, comp long, n long, item string"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(n))


def messy_rows() -> list[tuple]:
    """(doc_id, text, lang): nulls, empty, white space, ties, repeated rows, a long text, other scripts."""
    base = prose(1, 120)
    near = base.replace(base.split()[60], "changed", 1)
    rows = [(1, base, "en"), (2, base, "en"), (3, near, "en"), (4, None, "en"), (5, "", None), (6, " \t\n ", "fr"), (7, "one two", "en"), (8, "ONE  two", None),
            (None, base, "en"), (None, None, None), (9, prose(2, 4000) * 5, "en"), (9, "other text of nine", "de"), (1, base, "en"), (10, "日本語のテキスト é ß   \U0001F600", "ja"), (11, "12345 !!", "en"),
            (12, "the code is under the MIT license, or Apache License, Version 2; not CC-BY-NC", "en")]
    return rows + [(100 + i, prose(100 + i, 30 + i), "en" if i % 2 else "de") for i in range(12)]


@pytest.fixture(scope="session")
def messy(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(messy_rows(), "doc_id long, text string, lang string").repartition(3)
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (x.split(" ") for x in CLASHING.split(", "))])


@pytest.fixture(scope="session")
def messy_stored(messy, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("messy") / "documents.parquet")
    messy.write.parquet(path)
    return messy.sparkSession.read.parquet(path)
