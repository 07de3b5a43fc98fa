import hashlib

import pyarrow.parquet as pq

import corpus_pipeline
from ledgerflow.llm import common, langid, minhash
from tests.conftest import SF_SMALL
from tests.llm.conftest import prose
from tests.llm.test_dedup_decontam import brute_groups, shingle_set


def test_pipeline_keeps_what_brute_force_keeps(spark):
    rows = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()}
    items = [r["text"] for r in pq.read_table(f"{SF_SMALL}/benchmark.parquet").to_pylist()]
    docs = common.table(spark, SF_SMALL, "documents")
    found = {r.doc_id: r.found for r in langid.identified(docs).select("doc_id", "found").collect()}
    kept = sorted((d, rows[d]) for d in rows if found[d].lang_pred != "und" and not found[d].ambiguous)
    kept = [(d, t) for (d, t), (_, _, c) in zip(kept, brute_groups(kept), strict=True) if d == c]
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert set(got) <= {d for d, _ in kept}
    norm = lambda t: " ".join(t.lower().split())
    for d, t in kept:
        if any(norm(i) in norm(t) for i in items):
            assert d not in got
    assert len(got) > 0.8 * len(kept)
    for d, r in got.items():
        assert hashlib.sha256(r.decoded).digest() == hashlib.sha256(rows[d].encode()).digest()


def test_every_stage_but_the_last_keeps_the_columns(spark, messy):
    docs = messy.selectExpr("doc_id", "text", "lang", "'s' as source", "1L as n_chars", "uid", "found")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = common.stored(stage(spark, docs.drop("found"), SF_SMALL), "test")
        assert out.columns == docs.drop("found").columns and out.count() > 0
        assert stage(spark, docs.drop("found").limit(0), SF_SMALL).count() == 0


def test_stages_keep_the_values_of_columns_with_any_name(spark, messy):
    docs = messy.selectExpr("doc_id", "text", "lang", "'s' as source", "1L as n_chars", "cast(doc_id * 7 as long) as uid", "concat('f', lang) as found", "doc_id as row", "'x' as `a.b`", "doc_id as comp")
    rows = {tuple(r) for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        got = [tuple(r) for r in out.collect()]
        assert got and set(got) <= rows


def test_one_document_of_each_group_stays_whatever_its_id(spark):
    base = prose(31, 100).split()
    texts = [" ".join([*base[:i], "edit", *base[i + 1:]]) for i in (20, 40, 60)]
    for ids in ((None, None, None), (3, 3, 3), (None, 5, 5)):
        docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
        got = minhash.deduplicated(docs, percent=80).collect()
        assert len(got) == 1 and got[0].doc_id == min((i for i in ids if i is not None), default=None)


def test_stages_name_four_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "MinHash near-dedup", "benchmark decontamination", "byte-level BPE"]
    assert minhash.PERCENT == 85


def test_near_dedup_stage_links_from_80_on_and_op6_from_85_on(spark):
    """12 words in a row changed: 130 of 162 shingles in common; 13: 129 of 163."""
    base = prose(21, 150).split()
    near = base[:60] + [f"edit{i}" for i in range(12)] + base[72:]
    far = base[:60] + [f"other{i}" for i in range(13)] + base[73:]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far))]
    sets = [shingle_set(t) for _, t in rows]
    alike = [len(sets[0] & x) / len(sets[0] | x) for x in sets[1:]]
    assert 0.8 <= alike[0] < 0.85 and alike[1] < 0.8
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["MinHash near-dedup"]
    assert sorted(r.doc_id for r in stage(spark, docs, SF_SMALL).collect()) == [1, 3]
    assert sorted(r.doc_id for r in minhash.groups(docs).where("kept").collect()) == [1, 2, 3]


def test_bound_of_differing_coordinates_follows_the_threshold():
    assert minhash.most_different(85) == 97
    assert minhash.most_different(80) > 115 and minhash.most_different(100) == 0
