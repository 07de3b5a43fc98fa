import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import common, queries, warc
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

FAKE = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def page_rows() -> list[tuple]:
    r = random.Random(3)
    hostile = ["".join(r.choice(["\r", "\n", "\r\n", "\r\n\r\n", "a", FAKE]) for _ in range(r.randint(1, 60))) for _ in range(12)]
    same = "same payload " * 20
    rows = [(1, "http://a/1", None), (2, None, ""), (3, "http://a/3\r\nX: y", same), (9, "http://b/", same), (4, "http://c", same), (None, "http://n", same), (None, None, same),
            (5, "u", "tiny"), (6, "u", "tiny"), (7, "é  ", "é" * 50), (8, "v", "é" * 50), (11, "w", "z" * 200_000 + "\r\n\r"), (12, "t", "twice " * 30), (12, "t", "twice " * 30), (13, "e", "tiny"), (13, "e", "tiny")]
    return rows + [(100 + i, f"h{i}", t) for i, t in enumerate(hostile)]


def expected(rows: list[tuple]) -> list[tuple]:
    """(page_id, bytes, digest, type, refers_to), by plain grouping."""
    data = [(p, u, (h or "").encode()) for p, u, h in rows]
    data.sort(key=lambda r: (r[2], r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
    out, first = [], {}
    for p, _, b in data:
        again = len(b) >= 100 and b in first
        out.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
        first.setdefault(b, p)
    return sorted(out, key=str)


def test_what_is_written_is_read_back(spark, tmp_path):
    rows = page_rows()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit("k")).withColumn("copy", F.lit(7)).repartition(3)
    folder = str(tmp_path / "archives")
    warc.write(df, folder)
    found = common.stored(warc.records(spark, folder), "test")
    assert found.count() == 3 * len(rows)
    got = warc.of_pages(warc.captures(found)).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(rows)
    assert sorted(((r.page_id, r.url) for r in got), key=str) == sorted(((p, u) for p, u, _ in rows), key=str)
    whole = {bytes(r.payload) for r in found.where("type = 'response'").collect()}
    assert whole == {(h or "").encode() for _, _, h in rows}


def test_an_empty_table_gives_no_rows(spark, tmp_path):
    folder = str(tmp_path / "archives")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.of_pages(warc.captures(common.stored(warc.records(spark, folder), "test"))).count() == 0


def archive(*records: tuple[str, str, list[str], bytes]) -> bytes:
    out = b""
    for name, kind, concurrent, block in records:
        lines = ["WARC/1.0", f"WARC-Type: {kind}", f"warc-record-id: <{name}>", *[f"WARC-Concurrent-To: <{c}>" for c in concurrent], f"Content-Length: {len(block)}"]
        out += "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return out


def test_transactions_are_assembled_in_either_direction_and_over_one_record(spark, tmp_path):
    # Members of a gzip file follow each other, as other writers have them.
    one = archive(("q1", "request", [], b"GET"), ("r1", "response", ["q1"], b"one"), ("m1", "metadata", ["q1"], b"x: y"))
    two = archive(("m2", "metadata", ["r2", "r9"], b"\r\n\r\n"), ("r2", "response", [], b"two"), ("lone", "request", ["nobody"], b""), ("w", "warcinfo", [], b"i"))
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in (one, two)))
    rows = {r.capture_id: r for r in warc.captures(common.stored(warc.records(spark, str(tmp_path)), "test")).collect()}
    assert set(rows) == {"<r1>", "<r2>", "<lone>", "<w>"}
    assert [x.record_id for x in rows["<r1>"].requests] == ["<q1>"] and [x.record_id for x in rows["<r1>"].metadata] == ["<m1>"]
    assert bytes(rows["<r2>"].response.payload) == b"two" and bytes(rows["<r2>"].metadata[0].payload) == b"\r\n\r\n"
    assert rows["<lone>"].response is None and [x.type for x in rows["<w>"].others] == ["warcinfo"]


def test_a_capture_with_very_many_records_has_further_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "NESTED", 10)
    many = [(f"m{i}", "metadata", ["r"], b"") for i in range(95)]
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(archive(("r", "response", [], b"body"), *many)))
    rows = warc.captures(common.stored(warc.records(spark, str(tmp_path)), "test")).collect()
    assert sorted(x.record_id for r in rows for x in r.metadata) == sorted(f"<m{i}>" for i in range(95))
    assert sum(r.response is not None for r in rows) == 1 and len(rows) > 5 and {r.capture_id for r in rows} == {"<r>"}


def test_a_cut_archive_fails(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(archive(("r", "response", [], b"body" * 9))[:-20]))
    with pytest.raises(Exception, match="ends inside a record"):
        warc.records(spark, str(tmp_path)).collect()


def test_query_equals_sql(spark):
    df = warc.pages(spark, SF_SMALL)
    cur = duck(SF_SMALL).execute(queries.ORACLES["op12_warc_transactions"])
    assert compare(df.collect(), df.columns, cur.fetchall(), [d[0] for d in cur.description]) is None


def test_looked_up_equals_a_left_join(spark, monkeypatch):
    monkeypatch.setattr(common, "SHARE", 4)
    rows = spark.createDataFrame([(1 if i % 2 else i if i % 10 else None, i) for i in range(200)], "k long, v long")
    table = spark.createDataFrame([(1, "hot"), (2, "x"), (44, "y")], "k long, w string")
    got = common.looked_up(common.stored(rows, "test"), "k", table).select("k", "v", "w")
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.join(table, "k", "left").collect()))
