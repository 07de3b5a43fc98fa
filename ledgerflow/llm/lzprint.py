"""Lempel-Ziv phrase fingerprints.

A text is parsed from left to right into dictionary phrases: each phrase is
the shortest run of characters that is not a phrase yet.  The fingerprint is
the sorted ``SIZE`` least 32-bit hashes of the phrase set, in hex, eight
digits each; the likeness of two fingerprints is the share of the least
``SIZE`` hashes of their union that both hold, which estimates the Jaccard
similarity of the phrase sets and so follows how well one text compresses
the other.

For the neighbour columns documents are dealt into ranges of ids, sorted
within each, and every range also gets the first document of the next one, so
that a task reads its rows as a stream and holds two documents at a time.
The edited text shares its beginning with the document, and so its parse.

Defined results: a null or empty text has the empty fingerprint, like another
empty one by 1 and any other by 0; rows with equal ids follow each other by
text; null ids come first; the only row of a table is its own next; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import common

SIZE = 64
#: Characters whose phrases are hashed at a time.
RUN = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def phrases(text: str, root: dict, start: int = 0, log: list | None = None) -> tuple[list[int], bool]:
    """Ends of the phrases from ``start`` on, and whether the last is cut short
    by the end of the text; such a one counts, but is not learnt.

    ``root`` is the trie of the phrases so far, nested by character, with 0 for
    a phrase that none extends; it is extended, and ``log`` says where."""
    ends: list[int] = []
    node, end = root, start
    for char in text[start:]:
        end += 1
        below = node.get(char)
        if below:
            node = below
        elif below is None:
            node[char] = 0
            if log is not None:
                log.append((node, char))
            ends.append(end)
            node = root
        else:
            node[char] = node = {}
    if node is not root:
        ends.append(end)
    return ends, node is not root


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(10, (n - 1).bit_length())
        _POWERS[:] = [np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)))) for b in (_BASE, _BASE_INVERSE)]
    return _POWERS[0], _POWERS[1]


def phrase_hashes(text: str, ends: list[int], start: int = 0) -> np.ndarray:
    """A 64-bit hash of each phrase: a polynomial in its characters, mixed."""
    out = []
    cuts = np.concatenate(([start], np.array(ends, np.int64)))
    at = 0
    while at < len(ends):
        upto = max(at + 1, int(np.searchsorted(cuts, cuts[at] + RUN, "right")) - 1)
        first, last = int(cuts[at]), int(cuts[upto])
        codes = np.frombuffer(text[first:last].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        up, down = _powers(len(codes) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(common.mix(codes + np.uint64(1)) * up[:len(codes)])))
        s, e = cuts[at:upto] - first, cuts[at + 1:upto + 1] - first
        out.append(common.mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)))
        at = upto
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def least(hashes: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The least ``size`` distinct 32-bit hashes, sorted."""
    top = (hashes >> np.uint64(32)).astype(np.uint32)
    if len(top) > 8 * size:
        part = np.unique(np.partition(top, 4 * size)[:4 * size + 1])
        if len(part) > size:
            return part[:size]
    return np.unique(top)[:size]


def fingerprint(mins: np.ndarray) -> str:
    return mins.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    union = np.union1d(a, b)[:size]
    if not len(union):
        return 1.0
    return float((np.isin(union, a) & np.isin(union, b)).sum() / len(union))


def print_of(text: str) -> np.ndarray:
    return least(phrase_hashes(text, phrases(text, {})[0]))


def prints_of_both(text: str, following: str) -> tuple[np.ndarray, str, np.ndarray]:
    """The text's least hashes, its edited text, and that text's least hashes."""
    q = len(text) // 4
    border = len(text) - q
    edited = text[:border] + following[:q]
    if edited == text:
        mine = print_of(text)
        return mine, edited, mine
    # Both begin alike; the phrase that crosses the border is read anew in each.
    root: dict = {}
    both, cut = phrases(text[:border], root)
    if cut:
        both.pop()
    at = both[-1] if both else 0
    shared = phrase_hashes(text, both)
    learnt: list[tuple[dict, str]] = []
    rest, _ = phrases(text, root, at, learnt)
    for node, char in reversed(learnt):
        del node[char]
    other, _ = phrases(edited, root, at)
    return (least(np.concatenate((shared, phrase_hashes(text, rest, at)))), edited,
            least(np.concatenate((shared, phrase_hashes(edited, other, at)))))


def chained(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(part, guest, doc_id, text): the documents by range of ids, and for each
    range as its guest the first document of the next range."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = rows.where("doc_id is not null").agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10 * parts)).first()[0] if parts > 1 else None
    bounds = sorted(set(found or []))
    part = F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(F.array(*map(F.lit, bounds)), lambda x: x < F.col("doc_id")))) if bounds else F.lit(0)
    rows = rows.withColumn("part", part.cast("int"))
    # At most ``parts`` rows: the least id of each range.
    firsts = sorted(((r["part"], r["nulls"], r["first"]) for r in rows.groupBy("part").agg(F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("nulls")).collect()), key=lambda r: r[0])
    if not firsts:
        return rows.select("part", F.lit(0).alias("guest"), "doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]
    to = spark.createDataFrame([(firsts[i - 1][0], None if nulls else first) for i, (_, nulls, first) in enumerate(firsts)], f"to int, first {kind}")
    guests = rows.join(F.broadcast(to), F.col("doc_id").eqNullSafe(F.col("first"))).groupBy("to", "doc_id").agg(F.min("text").alias("text"))
    return rows.select("part", F.lit(0).alias("guest"), "doc_id", "text").union(guests.select(F.col("to").alias("part"), F.lit(1).alias("guest"), "doc_id", "text"))


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    rows = chained(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, done = None, None, []
        # held: (id, text) whose next row has not come; waiting: the finished
        # columns of the row before it, which lack the likeness to held.

        def batch(id_type: pa.DataType) -> pa.RecordBatch:
            cols = list(zip(*done, strict=True))
            done.clear()
            kinds = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        for b in common.slices(batches, 256):
            id_type = b.schema.field("doc_id").type
            for guest, doc_id, text in zip(b.column("guest").to_pylist(), b.column("doc_id").to_pylist(), common.texts(b), strict=True):
                if held is not None:
                    mine, edited, theirs = prints_of_both(held[1], text)
                    if waiting:
                        done.append((*waiting[0], likeness(waiting[1], mine)))
                    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    waiting = (held[0], len(held[1]), sha, fingerprint(mine), fingerprint(theirs), likeness(mine, theirs)), mine
                held = doc_id, text
                if guest:
                    if waiting:
                        done.append((*waiting[0], likeness(waiting[1], print_of(text))))
                    held = waiting = None
            if done:
                yield batch(id_type)

    ordered = rows.repartition("part").sortWithinPartitions("part", "guest", F.asc_nulls_first("doc_id"), "text")
    return common.map_arrow(ordered.select("guest", "doc_id", "text"), f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double", run)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op3: every document's fingerprint, its edited text's, and their likeness."""
    return neighbours(common.table(spark, sf_dir, "documents"))
