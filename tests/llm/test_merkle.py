import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import common, merkle, queries
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def climb(nodes: list[str], fanout: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and for each node its path."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + fanout] for i in range(0, len(nodes), fanout)]
        for i, p in enumerate(paths):
            run, k = runs[at[i] // fanout], at[i] % fanout
            p.append(("".join(run[:k]), "".join(run[k + 1:])))
        at, nodes = [k // fanout for k in at], [h(*run) for run in runs]
    return nodes[0], paths


def brute(rows: list[tuple], fanout: int) -> list[tuple]:
    """rows: (id, group, leaf) -> (id, group, pos, leaf, path, subroot, root), sorted."""
    groups: dict = {}
    for i, g, leaf in rows:
        groups.setdefault(g, []).append((i, leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[g] = climb([leaf for _, leaf in groups[g]], fanout)
    root, tops = climb([trees[g][0] for g in order], fanout) if order else (None, [])
    out = []
    for g, top in zip(order, tops, strict=True):
        out += [(i, g, pos, leaf, trees[g][1][pos] + top, trees[g][0], root) for pos, (i, leaf) in enumerate(groups[g])]
    return sorted(out, key=str)


def made(df) -> list[tuple]:
    return sorted(((r.id, r.group, r.pos, r.leaf, [(s.before, s.after) for s in r.path], r.subroot, r.root) for r in df.collect()), key=str)


@pytest.mark.parametrize(("fanout", "levels"), [(3, 1), (2, 2)])
def test_paths_equal_those_of_one_tree(spark, fanout, levels):
    sizes = {None: 1, "": 3, "a": 33, "b": 28, "c": 2, "é": 5, "z": 17}
    rows = [(i, g, h(str((g, i)))) for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string").repartition(5)
    got = made(merkle.manifest(df, fanout=fanout, levels=levels))
    assert got == brute(rows, fanout)


def test_null_ids_ties_repeated_rows_and_an_empty_table(spark):
    rows = [(None, "a", h("1")), (None, "a", h("2")), (5, "a", h("3")), (5, "a", h("3")), (5, "a", h("0")), (1, None, h("x")), (1, None, h("x"))]
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string").withColumn("uid2", F.lit(3)).withColumn("tree", F.lit("t"))
    assert made(merkle.manifest(df, fanout=2, levels=1)) == brute(rows, 2)
    assert merkle.manifest(df.limit(0)).count() == 0


def test_query_equals_sql_and_finds_each_tampered_text(spark):
    df = merkle.documents(spark, SF_SMALL)
    rows = df.collect()
    cur = duck(SF_SMALL).execute(queries.ORACLES["op11_merkle_butterfly"])
    assert compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description]) is None
    texts = {r.doc_id: r.text for r in common.table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()}
    lower = str.maketrans(merkle.UPPER, merkle.LOWER)
    for r in rows:
        text = texts[r.doc_id]
        changed = text is not None and text.translate(lower) != text and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert r.verified == (not changed)


def test_query_handles_messy_rows(spark, messy, tmp_path):
    path = str(tmp_path)
    messy.selectExpr("*", "if(doc_id = 1, null, 'src') as source", "cast(length(text) as long) as n_chars").write.parquet(f"{path}/documents.parquet")
    got = merkle.documents(spark, path).collect()
    docs = spark.read.parquet(f"{path}/documents.parquet").select(*merkle.COLUMNS).collect()
    canon = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    want = brute([(r[0], r[1], h(*map(canon, r))) for r in docs], 16)
    assert sorted((r.leaf, r.subroot, r.root, r.proof_sha256) for r in got) == sorted((w[3], w[5], w[6], h(*[x for s in w[4] for x in s])) for w in want)
