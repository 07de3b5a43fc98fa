import math
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import hpylm
from tests.conftest import SF_SMALL
from tests.llm.conftest import messy_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(rows):
    """(n_tokens, n_known, N, base score) of each (doc_id, text), by counting in Python."""
    toks = [[*WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)})), None] for _, t in rows]
    c = {}
    for (d, _), ts in zip(rows, toks, strict=True):
        if zlib.crc32(("" if d is None else str(d)).encode()) % 10:
            for t in ts:
                c[t] = c.get(t, 0) + 1
    n, v = sum(c.values()), len(c)
    return [(len(ts), sum(t in c for t in ts), n, sum(math.log10((c.get(t, 0) + 0.1) / (n + 0.1 * (v + 1))) for t in ts)) for ts in toks]


def check(got, rows):
    want = sorted(((str(d), *b) for (d, _), b in zip(rows, base(rows), strict=True)), key=lambda x: (x[0], x[4]))
    got = sorted(((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=lambda x: (x[0], x[4]))
    assert [x[:4] for x in got] == [x[:4] for x in want]
    assert np.allclose([x[4] for x in got], [x[4] for x in want])


def test_base_scores_and_gain_on_documents(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    got = hpylm.documents(spark, sf).collect()
    check(got, [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()])
    held = [r for r in got if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in got)
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_messy_rows(messy_stored):
    train = hpylm.training_fold().alias("x")
    got = hpylm.scored(messy_stored, train).collect()
    check(got, [r[:2] for r in messy_rows()])
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    empty = {r.score for r in got if r.n_tokens == 1}
    assert len(empty) == 1


def test_nothing_to_learn_from(messy_stored):
    got = hpylm.scored(messy_stored, F.lit(False)).collect()
    for r in got:
        assert r.n_known == 0 and r.train_tokens == 0
    one = next(r for r in got if r.doc_id == 4)
    assert one.score == pytest.approx(-math.log10(hpylm.SYMBOLS))
    assert hpylm.scored(messy_stored.limit(0), F.lit(True)).count() == 0


def test_probabilities_of_a_context_sum_to_one():
    """With every symbol asked for, each context's averaged probabilities are a distribution."""
    rng = np.random.default_rng(3)
    contexts = rng.integers(0, 4, (6, 3))
    keys = np.array([s | sum(int(c) << hpylm.BITS * (j + 1) for j, c in enumerate(ctx)) for ctx in contexts for s in range(hpylm.SYMBOLS)])
    keys, first = np.unique(keys, return_index=True)
    n = np.where(rng.random(len(keys)) < 0.1, rng.integers(1, 500, len(keys)), 0)
    p, _, _ = hpylm.sample(keys, n, [3, 2, 1, 0], lambda k: np.full(len(k), 1 / hpylm.SYMBOLS), seed=1)
    sums = {}
    for k, x in zip(keys.tolist(), p.tolist(), strict=True):
        sums[k >> hpylm.BITS] = sums.get(k >> hpylm.BITS, 0) + x
    assert np.allclose(list(sums.values()), 1)


def test_seating_keeps_tables_within_bounds_and_near_the_expected_number():
    rng = np.random.default_rng(1)
    n = np.array([0, 1, 2, 10, 1000, 200_000])
    t = np.mean([hpylm.seat(n, np.full(6, 0.5), np.zeros(6), rng) for _ in range(300)], axis=0)
    assert t[0] == 0 and t[1] == 1 and (t <= np.maximum(n, 0)).all()

    def expected(customers):
        tables = 1.0
        for i in range(1, customers):
            new = (hpylm.CONCENTRATION + hpylm.DISCOUNT * tables) * 0.5
            tables += new / (new + i - hpylm.DISCOUNT * tables)
        return tables

    assert t[3] == pytest.approx(expected(10), rel=0.1) and t[4] == pytest.approx(expected(1000), rel=0.15)


def test_grams_hold_the_symbol_and_its_context():
    g = hpylm.grams(hpylm.tokens("Ab c"))
    text = [*b"ab c ", hpylm.END]
    assert (g & 511).tolist() == text
    assert (g >> 9 & 511).tolist() == [hpylm.BEGIN, *text[:-1]]
    assert hpylm.grams(hpylm.tokens("")).tolist() == [hpylm.END | sum(hpylm.BEGIN << 9 * j for j in range(1, hpylm.ORDER + 1))]
