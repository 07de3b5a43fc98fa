import itertools
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from ledgerflow.llm import common, decontam, minhash
from tests.conftest import SF_SMALL
from tests.llm.conftest import messy_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_groups(rows):
    """component id of each (doc_id, text) row by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 85 * len(sets[i] | sets[j]):
            up[find(i)] = find(j)
    names = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            names[find(i)] = min(d, names.get(find(i), d))
    return [(d, len(s), names.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def as_rows(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_groups_equal_brute_force_on_messy_rows(messy):
    got = minhash.groups(messy)
    assert as_rows(got) == sorted(brute_groups([r[:2] for r in messy_rows()]), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_groups_equal_brute_force_on_documents(spark):
    table = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = minhash.groups(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    assert as_rows(got) == sorted(brute_groups([(r["doc_id"], r["text"]) for r in table]), key=str)


def test_chain_of_near_copies_beyond_the_pivots(spark, monkeypatch):
    """Each text is like its neighbours only, so most links need more rounds than the first."""
    monkeypatch.setattr(minhash, "PIVOTS", (1, 2))
    words = prose(5, 260).split()
    rows = [(i, " ".join(words[2 * i:2 * i + 120])) for i in range(40)]
    got = minhash.groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert as_rows(got) == sorted(brute_groups(rows), key=str)


def test_outliers_of_a_large_group(spark, monkeypatch):
    """Copies with one to four changed words: links only between some of them, none beyond the bounds."""
    monkeypatch.setattr(minhash, "PIVOTS", (1, 2))
    base = prose(9, 140).split()
    rows = []
    for i in range(60):
        w = list(base)
        for j in range(1 + i % 4):
            w[(i * 17 + j * 41) % 140] = f"edit{i if i % 3 else 0}x{j}"
        rows.append((i if i % 10 else None, " ".join(w)))
    got = minhash.groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert as_rows(got) == sorted(brute_groups(rows), key=str)


def test_groups_of_an_empty_table(spark):
    assert minhash.groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sketch_is_filled_and_estimates_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 1000).astype(np.uint64)
    b = np.concatenate((a[:900], rng.integers(0, 2**63, 100).astype(np.uint64)))
    tiny = a[:3]
    grid = minhash.sketches([a, b, tiny])
    assert (grid != np.uint64(2**64 - 1)).all()
    assert abs((grid[0] == grid[1]).mean() - 900 / 1100) < 0.08
    assert (minhash.sketches([tiny])[0] == grid[2]).all()


def test_dedup_keeps_one_row_of_each_group(messy):
    kept = [(r.doc_id, r.text) for r in minhash.deduplicated(messy).collect()]
    want = {(d, t) for (d, t, _), (_, _, c) in zip(messy_rows(), brute_groups([r[:2] for r in messy_rows()]), strict=True) if d == c}
    assert sorted(map(str, kept)) == sorted(map(str, want))
    assert minhash.deduplicated(messy).columns == messy.columns


def brute_tiles(doc, item, least):
    """Greedy string tiling by looking at every pair of positions."""
    free_d, free_i, covered = [True] * len(doc), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for p, t in itertools.product(range(len(item)), range(len(doc))):
            n = 0
            while p + n < len(item) and t + n < len(doc) and free_i[p + n] and free_d[t + n] and item[p + n] == doc[t + n]:
                n += 1
            best = max(best, (n, -p, -t))
        n, p, t = best[0], -best[1], -best[2]
        if n < least:
            return covered
        covered += n
        free_i[p:p + n] = free_d[t:t + n] = [False] * n


@pytest.mark.parametrize("seed", range(25))
def test_tiles_cover_what_brute_force_covers(seed):
    rng = np.random.default_rng(seed)
    item = rng.integers(0, 4 if seed % 2 else 30, 30).astype(np.uint64)
    cuts = sorted(rng.integers(0, 30, 3))
    parts = np.split(item, cuts)
    rng.shuffle(parts)
    doc = np.concatenate([*parts, rng.integers(0, 4, 15).astype(np.uint64)])
    found = decontam.tiles([doc], item, 3)
    assert sum(n for *_, n in found) == brute_tiles(doc.tolist(), item.tolist(), 3)
    marked = [p + i for p, _, _, n in found for i in range(n)]
    assert len(marked) == len(set(marked))


ITEM = prose(77, 40)


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_leaks_whole_reordered_and_not(spark, messy, sent):
    w = ITEM.split()
    halves = " ".join(w[20:] + ["between"] + w[:20])
    rows = [(1, f"{prose(3, 50)} {ITEM.upper()}! {prose(4, 50)}"), (2, halves), (3, prose(5, 400)), (4, " ".join(w[:10])), (5, None), (None, ITEM), (6, "tiny item"), (1, f"{prose(3, 50)} {ITEM.upper()}! {prose(4, 50)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as uid", "1 as size", "'x' as words", "2 as seed")
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "Tiny, item"), (4, "Tiny, item"), (None, "no such words here at all")], "item_id long, text string").selectExpr("*", "0 as doc_id")
    got = {(r.doc_id, r.item_id): r for r in decontam.leaks(docs, bench, sent_seeds=sent).collect()}
    assert set(got) == {(1, 1), (2, 1), (None, 1), (6, 4)}
    assert got[1, 1].coverage == 1 and got[1, 1].n_tiles == 1
    assert got[2, 1].coverage == 1 and got[2, 1].n_tiles == 2
    left = decontam.cleaned(docs, bench)
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 5] and left.columns == docs.columns


def test_leaks_of_empty_tables(spark, messy):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.leaks(messy, none).count() == 0
    assert decontam.leaks(messy.limit(0), spark.createDataFrame([(1, ITEM)], "item_id long, text string")).count() == 0


def test_window_hashes_tell_orders_apart():
    h = common.window_hashes(np.array([1, 2, 1, 2, 2, 1], np.uint64), 2)
    assert h[0] == h[2] and len(set(h.tolist())) == 3


def test_groups_equal_sql(spark):
    from ledgerflow.llm import queries
    from tools.oracle_check import compare, duck
    sf = SF_SMALL.replace("0.001", "0.01")
    df = minhash.documents(spark, sf)
    cur = duck(sf).execute(queries.ORACLES["op6_fast_similarity_sketch"])
    rows = df.collect()
    assert any(not r.kept for r in rows)
    assert compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description]) is None
