import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import colloc, queries
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows: list[tuple], least: int, longest: int = 5, top: int = 2000) -> list[tuple]:
    """(lang, rank, phrase, a, l, r, n, score) by counting everything."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(CAPITALS)):
            w = tuple(re.findall("[^ \t]+", piece))
            n[lang] += len(w)
            f.update((lang, w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    inside = Counter()
    for (lang, w), a in f.items():
        if a >= least:
            for s in range(len(w)):
                for e in range(s + 2, len(w) + 1):
                    if e - s < len(w):
                        inside[lang, w[s:e]] = max(inside[lang, w[s:e]], a)
    found = []
    for (lang, w), a in f.items():
        if a >= least and len(w) > 1 and inside[lang, w] < a:
            score, _, l, r = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            found.append((lang, -score, -a, " ".join(w).encode(), l, r))
    out, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return out


def made(df) -> list[tuple]:
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def loose_texts() -> list[tuple]:
    r = random.Random(5)
    vocabulary = ["a", "A", "b", "new", "York", "city", "é", "É", "of", "\x1cx"]
    rows = [("".join(r.choice(vocabulary) + r.choice([" ", " ", "\t", ". ", "  ", "\n", "\r\n", "!"]) for _ in range(r.randint(0, 60))), r.choice(["en", "de", None])) for _ in range(60)]
    return [*rows, ("new york city hall " * 40, "en"), ("a a a a a a a a", "xx"), (None, "en"), ("", None), (" \t", "fr"), *[("same row here", "en")] * 9]


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    if small:  # several blocks a task, several segments a stripe, few buckets
        for name, value in (("BLOCK", 50), ("SEGMENT", 8), ("RUN", 16), ("BUCKETS", 1)):
            monkeypatch.setattr(colloc, name, value)
    rows = loose_texts()
    df = spark.createDataFrame(rows, "text string, lang string").withColumn("block", F.lit(1)).withColumn("word", F.lit("w")).repartition(3)
    assert made(colloc.collocations(df, least=5, top=7)) == sorted(brute(rows, 5, top=7))


def test_prefix_totals_equal_counts(spark):
    rows = [("x y z. x y. x q x", "en")] * 6
    found, _ = colloc.phrases(spark.createDataFrame(rows, "text string, lang string"), least=6)
    got = {r.phrase: r for r in found.collect()}
    assert list(got["x y"].heads) == [24] and list(got["x y z"].heads) == [24, 12] and list(got["x y z"].tails) == [6, 6]
    assert got["x y"].covered == 6 and got["x y z"].covered == 0


def test_scores_past_64_bits_are_exact(spark):
    a, n, l, r = 9_000_000_000_001, 90_000_000_000_007, 9_100_000_000_003, 9_300_000_000_001
    df = spark.createDataFrame([(a, n, [l, r], [r, l])], "a long, n long, heads array<long>, tails array<long>")
    got = df.select(colloc.weakest_cut(F.col("a"), F.col("n"), F.col("heads"), F.col("tails")).alias("x")).first().x
    assert (got.score, got.k, got.l, got.r) == (1000 * a * n // (l * r), 1, l, r)


def test_words_of_a_long_text_are_not_cut(monkeypatch):
    text = "one two.three  four,five six\tseven" * 3
    whole = [w for part in colloc.words(text.encode()) for w in part]
    for run in (1, 2, 5):
        monkeypatch.setattr(colloc, "RUN", run)
        assert [w for part in colloc.words(text.encode()) for w in part] == whole


def test_codes_come_back():
    code = np.array([1, 5, 0, 7], np.int32)
    assert (colloc.unpacked_code(colloc.packed_code(code)) == code).all()
    arrays = [np.array([3, 3, 9, 1 << 60, 5]), np.empty(0, np.int64), np.array([-7])]
    assert [x.tolist() for x in colloc.unpacked(colloc.packed(*arrays))] == [x.tolist() for x in arrays]


def test_an_empty_table_and_messy_rows(spark, messy):
    assert made(colloc.collocations(messy.limit(0))) == []
    rows = [(r.text, r.lang) for r in messy.select("text", "lang").collect()]
    assert made(colloc.collocations(messy, least=3)) == sorted(brute(rows, 3))


def test_query_equals_sql(spark):
    df = colloc.documents(spark, SF_SMALL)
    cur = duck(SF_SMALL).execute(queries.ORACLES["op13_stripe_collocations"])
    rows = df.collect()
    assert len(rows) > 10
    assert compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description]) is None
