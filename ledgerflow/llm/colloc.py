"""Phrase collocations by stripes.

Texts are cut into pieces at punctuation and line ends, and pieces into words.
For phrases of each length in turn, a prefix keys a stripe, an associative
counter of what follows it.  Stripes are made per block of text, merged
elementwise, and one merged stripe gives the counts of the prefix's
extensions, the prefix's total (what has no frequent follower is counted
under 0), and the largest extension, which tells whether the prefix is
subsumed.

A phrase can only be frequent if the phrases without its last and without its
first word are.  So after each length the blocks learn which of their own
phrases are frequent, and the next stripes hold only pairs of neighbouring
frequent ones; nothing else is left out, and all counts are exact.

Spark jobs, for each length:

1. a block (at most about ``BLOCK`` words of one language, as numbers of its own
   list of words or phrases) meets the numbers given to its frequent phrases and
   sends its stripes, those of one bucket packed into a row.  A frequent prefix's
   stripe goes in segments of about ``SEGMENT`` occurrences, by what follows;
2. the rows of one bucket meet in a task, which merges the bucket's stripes and
   sends each block a row with the numbers of its phrases that are frequent.

No key is in a block more than once, so none is hot.  Numbers are given by the
task that merges (its partition and a counter), never by a hash.

Defined results: a null text is empty, a null language ``und``; repeated rows
count each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm import common

LEAST, LONGEST, TOP = 100, 5, 2000
#: A candidate is dropped for a longer one with so many percent of its occurrences.
SUBSUMED = 100
BLOCK = 1 << 20
SEGMENT = 1 << 20
#: Bytes of text cut into words at a time.
RUN = 1 << 18
#: Buckets, for each of the session's shuffle partitions, that words and stripes are dealt into; a task merges one at a time.
BUCKETS = 4
#: Tasks among which the candidates of one language are dealt for the report.
DEALT = 64
BORDER = b"."
_BORDERS = b".,;:!?\n\x0b\x0c\r"
_CAPITALS = bytes(range(65, 91))
_TABLE = bytes.maketrans(_CAPITALS + b"\t" + _BORDERS, _CAPITALS.lower() + b" " + BORDER * len(_BORDERS))
_CUT = re.compile(rb"[ .]")
PHRASE, GIVEN, SUMMARY = 0, 1, 2


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words, with ``BORDER`` between pieces, some at a time."""
    text = text.translate(_TABLE)
    start = 0
    while start < len(text):
        cut = _CUT.search(text, start + RUN) if start + RUN < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[start:end].replace(BORDER, b" . ").split()
        start = end


class Block(dict):
    """The numbers of a block's words, and its text in these numbers."""

    def __init__(self):
        super().__init__({BORDER: 0})
        self.codes: list[np.ndarray] = []
        self.size = 0

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n

    def add(self, found: list[bytes]) -> None:
        self.codes.append(np.fromiter(map(self.__getitem__, found), np.int32, len(found)))
        self.size += len(found)


def packed(*arrays: np.ndarray) -> bytes:
    """Whole numbers, each array sorted or not, as differences by byte planes, compressed."""
    parts = []
    for x in arrays:
        steps = np.diff(x.astype(np.int64), prepend=0)
        parts += [np.int64(len(x)).tobytes(), steps.view(np.uint8).reshape(-1, 8).T.tobytes()]
    return zstandard.compress(b"".join(parts), 3)


def unpacked(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.decompress(data), 0, []
    while at < len(raw):
        n = int(np.frombuffer(raw, np.int64, 1, at)[0])
        planes = np.frombuffer(raw, np.uint8, 8 * n, at + 8).reshape(8, n)
        out.append(np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel()))
        at += 8 + 8 * n
    return out


def packed_code(code: np.ndarray) -> bytes:
    return zstandard.compress(code.astype(np.int32).tobytes(), 3)


def unpacked_code(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), np.int32)


def runs(sorted_keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, start, end) of each run of equal keys."""
    edges = np.flatnonzero(np.diff(sorted_keys)) + 1
    if len(sorted_keys):
        for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(sorted_keys)], strict=True):
            yield int(sorted_keys[s]), s, e


class Sender:
    """Collects rows of a schema (``name kind, ...``) and gives them as batches."""

    KINDS = {"long": pa.int64(), "int": pa.int32(), "tinyint": pa.int8(), "string": pa.string(), "binary": pa.binary()}

    def __init__(self, schema: str):
        self.fields = [(name, self.KINDS[kind]) for name, kind in (x.split() for x in schema.split(", "))]
        self.rows: list[dict] = []
        self.size = 0

    def add(self, **row) -> None:
        self.rows.append(row)
        self.size += sum(len(x) for x in row.values() if isinstance(x, bytes))

    def full(self) -> bool:
        return len(self.rows) >= 1000 or self.size > 1 << 22

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([r.get(name) for r in self.rows], kind) for name, kind in self.fields], [name for name, _ in self.fields])
        self.rows, self.size = [], 0
        return out

    def columns(self, **columns) -> Iterator[pa.RecordBatch]:
        """Whole columns at once; the others are null."""
        size = len(next(iter(columns.values())))
        for i in range(0, size, 50_000):
            n = min(50_000, size - i)
            yield pa.RecordBatch.from_arrays([pa.array(columns[name][i:i + n], kind) if name in columns else pa.nulls(n, kind) for name, kind in self.fields], [name for name, _ in self.fields])


CODED = "block long, lang string, code binary, total long, bucket int, words binary, data binary"


def coded(docs: DataFrame, text_col: str, lang_col: str, buckets: int) -> DataFrame:
    """Per block one row with its ``code`` and ``total`` words, and a row for each
    bucket of its distinct words: their numbers and counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[str, Block] = {}
        made = TaskContext.get().partitionId() << 32
        out = Sender(CODED)

        def close(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal made
            b = blocks.pop(lang)
            code = np.concatenate(b.codes)
            n = np.bincount(code, minlength=len(b))
            out.add(block=made, lang=lang, code=packed_code(code), total=int(n[1:].sum()))
            spelt = list(b)
            bucket = np.fromiter((zlib.crc32(w) % buckets for w in spelt), np.int64, len(spelt))
            order = np.argsort(bucket[1:], kind="stable") + 1
            for key, s, e in runs(bucket[order]):
                c = order[s:e]
                out.add(block=made, lang=lang, bucket=key, words=zstandard.compress(b" ".join([spelt[i] for i in c])), data=packed(c, n[c]))
                if out.full():
                    yield out.batch()
            made += 1

        for rows in common.slices(batches):
            for lang, text in zip(rows.column("lang").to_pylist(), rows.column("text").to_pylist(), strict=True):
                for found in words(text or b""):
                    b = blocks.setdefault(lang, Block())
                    if b.size + len(found) >= BLOCK and BORDER in found:
                        cut = len(found) - found[::-1].index(BORDER)
                        b.add(found[:cut])
                        yield from close(lang)
                        found, b = found[cut:], blocks.setdefault(lang, Block())
                    b.add(found)
                if lang in blocks:
                    blocks[lang].add([BORDER])
            if sum(b.size for b in blocks.values()) > 2 * BLOCK:
                yield from close(max(blocks, key=lambda x: blocks[x].size))
        for lang in list(blocks):
            yield from close(lang)
        if out.rows:
            yield out.batch()

    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    return common.map_arrow(rows, CODED, run)


#: ``given``: the numbers c of a block's frequent words or phrases, their ids and into how many segments their stripes go.
LEARNT = "kind tinyint, lang string, word string, prefix long, suffix long, f long, gid long, block long, given binary, total long, largest long"


def segments(f: np.ndarray) -> np.ndarray:
    return 1 + f // SEGMENT


def by_bucket(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    """All rows of one bucket after another, from rows sorted by bucket."""
    held: list[dict] = []
    for b in common.slices(batches, 64):
        for row in b.to_pylist():
            if held and held[0]["bucket"] != row["bucket"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def give(out: Sender, block: np.ndarray, c: np.ndarray, gid: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each block with what it learns."""
    order = np.lexsort((c, block))
    block, c, gid, f = block[order], c[order], gid[order], f[order]
    for key, s, e in runs(block):
        out.add(kind=GIVEN, block=key, given=packed(c[s:e], gid[s:e], segments(f[s:e])))
        if out.full():
            yield out.batch()
    if out.rows:
        yield out.batch()


def first_id() -> int:
    return (TaskContext.get().partitionId() << 40) + 1


def frequent_words(parts: DataFrame, least: int) -> DataFrame:
    """Rows of ``LEARNT``: the words of at least ``least`` occurrences in their
    language (lang, word, f, gid), and what blocks learn of them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, out = first_id(), Sender(LEARNT)
        for rows in by_bucket(batches):
            for lang in {r["lang"] for r in rows}:
                mine = [(r["block"], zstandard.decompress(r["words"]).split(b" "), *unpacked(r["data"])) for r in rows if r["lang"] == lang]
                spelt = pa.array([w for _, found, _, _ in mine for w in found], pa.binary()).dictionary_encode()
                which, c, n = spelt.indices.to_numpy(), np.concatenate([x[2] for x in mine]), np.concatenate([x[3] for x in mine])
                block = np.repeat([x[0] for x in mine], [len(x[1]) for x in mine])
                f = np.bincount(which, weights=n, minlength=len(spelt.dictionary)).astype(np.int64)
                often = f >= least
                gid = np.zeros(len(f), np.int64)
                gid[often] = made + np.arange(often.sum())
                made += int(often.sum())
                yield from out.columns(kind=np.full(often.sum(), PHRASE, np.int8), lang=[lang] * int(often.sum()), word=spelt.dictionary.filter(pa.array(often)).cast(pa.string()), f=f[often], gid=gid[often])
                sent = often[which]
                yield from give(out, block[sent], c[sent], gid[which][sent], f[which][sent])

    rows_in = parts.where("bucket is not null").select("bucket", "block", "lang", "words", "data")
    return common.map_arrow(rows_in.repartition("bucket").sortWithinPartitions("bucket"), LEARNT, run)


STRIPES = "block long, code binary, bucket int, base int, data binary"


def pairs(code: np.ndarray, c: np.ndarray, gid: np.ndarray, segs: np.ndarray, buckets: int) -> tuple[list[tuple], np.ndarray]:
    """A block's stripes and its code for the next length.

    Stripes come by bucket (bucket, base, prefix, suffix, n, end, n_end), sorted by prefix
    and suffix: a suffix is the frequent phrase that ends with the next word; an
    end is a prefix that no frequent word follows.  The pairs of a bucket are
    numbered from ``base`` on in the next code."""
    size = int(max(code.max(initial=0), c.max(initial=0))) + 1
    number, split = np.zeros(size, np.int64), np.ones(size, np.int64)
    number[c], split[c] = gid, segs
    alive = number[code] > 0
    at = np.flatnonzero(alive[:-1] & alive[1:])
    which, found = pd.factorize(code[at].astype(np.int64) << 32 | code[at + 1])
    found = np.asarray(found, np.int64)
    alive[at] = False
    ends, n_ends = np.unique(code[alive], return_counts=True)

    def bucket_of(prefix: np.ndarray, seg: np.ndarray) -> np.ndarray:
        return (common.mix(prefix.view(np.uint64) + common.mix(seg.view(np.uint64))) % np.uint64(buckets)).astype(np.int64)

    prefix, suffix = number[found >> 32], number[found & 0xFFFFFFFF]
    seg = (common.mix(suffix.view(np.uint64)) % split[found >> 32].astype(np.uint64)).astype(np.int64)
    bucket = bucket_of(prefix, seg)
    order = np.lexsort((suffix, prefix, bucket))
    n = np.bincount(which, minlength=len(found))[order]
    prefix, suffix, bucket = prefix[order], suffix[order], bucket[order]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(1, len(order) + 1)
    end_bucket = bucket_of(number[ends], np.zeros(len(ends), np.int64))
    end_order = np.lexsort((number[ends], end_bucket))
    ends, n_ends, end_bucket = number[ends][end_order], n_ends[end_order], end_bucket[end_order]
    of_pairs = {key: (s, e) for key, s, e in runs(bucket)}
    of_ends = {key: (s, e) for key, s, e in runs(end_bucket)}
    out = []
    for key in sorted({*of_pairs, *of_ends}):
        (s, e), (t, u) = of_pairs.get(key, (0, 0)), of_ends.get(key, (0, 0))
        out.append((key, s + 1, prefix[s:e], suffix[s:e], n[s:e], ends[t:u], n_ends[t:u]))
    code = np.zeros(len(code), np.int32)
    code[at] = place[which]
    return out, code[(code > 0) | (np.concatenate(([0], code[:-1])) > 0)]


def stripes(codes: DataFrame, learnt: DataFrame, last: bool, buckets: int) -> DataFrame:
    """Rows of ``STRIPES``: every block's stripes by bucket, and its next code (but for the last length)."""

    def run(block: pa.Table, known: pa.Table) -> pa.Table:
        out = Sender(STRIPES)
        if block.num_rows and known.num_rows:
            name = block.column("block")[0].as_py()
            parts = [unpacked(x) for x in known.column("given").to_pylist()]
            made, code = pairs(unpacked_code(block.column("code")[0].as_py()), *map(np.concatenate, zip(*parts, strict=True)), buckets)
            for key, base, *arrays in made:
                out.add(block=name, bucket=key, base=base, data=packed(*arrays))
            if not last and len(code):
                out.add(block=name, code=packed_code(code))
        return pa.Table.from_batches([out.batch()])

    common.workers_import(codes.sparkSession)
    given = learnt.where(F.col("kind") == GIVEN).select("block", "given")
    return codes.select("block", "code").groupBy("block").cogroup(given.groupBy("block")).applyInArrow(run, STRIPES)


def merged(parts: DataFrame, least: int) -> DataFrame:
    """Rows of ``LEARNT``: the frequent phrases (prefix, suffix, f, gid), what
    blocks learn of them, and sums by prefix and segment (prefix, total, largest)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, out = first_id(), Sender(LEARNT)
        for rows in by_bucket(batches):
            each = [unpacked(r["data"]) for r in rows]
            sizes = [len(x[0]) for x in each]
            prefix, suffix, n, end, n_end = map(np.concatenate, zip(*each, strict=True))
            block = np.repeat([r["block"] for r in rows], sizes)
            c = np.concatenate([np.arange(r["base"], r["base"] + size) for r, size in zip(rows, sizes, strict=True)])
            order = np.lexsort((suffix, prefix))
            prefix, suffix, n, c, block = (x[order] for x in (prefix, suffix, n, c, block))
            stripe = np.diff(prefix, prepend=-1) != 0
            starts = np.flatnonzero(stripe | (np.diff(suffix, prepend=-1) != 0))
            f = np.add.reduceat(n, starts) if len(starts) else np.empty(0, np.int64)
            often = f >= least
            gid = np.zeros(len(starts), np.int64)
            gid[often] = made + np.arange(often.sum())
            made += int(often.sum())
            yield from out.columns(kind=np.full(often.sum(), PHRASE, np.int8), prefix=prefix[starts][often], suffix=suffix[starts][often], f=f[often], gid=gid[often])
            of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(n))))
            sent = often[of]
            yield from give(out, block[sent], c[sent], gid[of][sent], f[of][sent])
            # Totals and largest extensions of the bucket's merged stripes.
            names, at = np.unique(np.concatenate((prefix, end)), return_inverse=True)
            total = np.bincount(at, weights=np.concatenate((n, n_end)), minlength=len(names)).astype(np.int64)
            largest = np.zeros(len(names), np.int64)
            np.maximum.at(largest, at[starts], f)
            yield from out.columns(kind=np.full(len(names), SUMMARY, np.int8), prefix=names, total=total, largest=largest)

    rows_in = parts.where("bucket is not null").select("block", "bucket", "base", "data")
    return common.map_arrow(rows_in.repartition("bucket").sortWithinPartitions("bucket"), LEARNT, run)


def phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """The frequent phrases of two words and more: (lang, phrase, a, heads, tails,
    covered), where heads and tails hold the counts of the first 1, 2, ... words
    and of what remains, and covered is the count of the most frequent phrase
    that is longer by a word; and (lang, n), each language's number of words."""
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    codes = common.stored(coded(docs, text_col, lang_col, buckets), "colloc-coded")
    totals = codes.groupBy("lang").agg(F.sum("total").alias("n"))
    learnt = common.stored(frequent_words(codes, least), "colloc-words", tidy=True)
    none = F.array().cast("array<long>")
    of = learnt.where(F.col("kind") == PHRASE).select("gid", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", none.alias("heads"), none.alias("tails"))
    levels = []
    for length in range(2, longest + 1):
        codes = common.stored(stripes(codes.where("code is not null"), learnt, length == longest, buckets), "colloc-stripes", tidy=True)
        learnt = common.stored(merged(codes, least), "colloc-merged", tidy=True)
        prefixes = learnt.where(F.col("kind") == SUMMARY).groupBy(F.col("prefix").alias("gid")).agg(F.sum("total").alias("total"), F.max("largest").alias("right"))
        new = learnt.where(F.col("kind") == PHRASE).select("gid", "prefix", "suffix", "f")
        suffixes = new.groupBy(F.col("suffix").alias("gid")).agg(F.max("f").alias("left"))
        of = of.join(prefixes, "gid", "left").join(suffixes, "gid", "left")
        covered = F.greatest(F.coalesce("right", F.lit(0)), F.coalesce("left", F.lit(0)))
        if length > 2:
            levels.append(of.select("lang", "phrase", F.col("f").alias("a"), "heads", "tails", covered.alias("covered")))
        before = of.select(F.col("gid").alias("prefix"), "lang", F.col("phrase").alias("begin"), F.concat("heads", F.array("total")).alias("heads"))
        after = of.select(F.col("gid").alias("suffix"), F.col("last"), F.concat(F.array("f"), F.col("tails")).alias("tails"))
        joined = new.join(before, "prefix").join(after, "suffix")
        of = common.stored(joined.select("gid", "lang", F.concat_ws(" ", "begin", "last").alias("phrase"), "last", "f", "heads", "tails"), "colloc-phrases", tidy=True)
    levels.append(of.select("lang", "phrase", F.col("f").alias("a"), "heads", "tails", F.lit(0).cast("long").alias("covered")))
    out = levels[0]
    for level in levels[1:]:
        out = out.union(level)
    return out, totals


def weakest_cut(a: Column, n: Column, heads: Column, tails: Column) -> Column:
    """struct(score, k, l, r) of the cut with the least floor(1000 * a * n / (l * r)), in exact decimals."""
    top = (a * 1000).cast("decimal(19,0)") * n.cast("decimal(18,0)")
    cuts = F.transform(F.arrays_zip(heads.alias("l"), tails.alias("r")), lambda x, i: F.struct(
        F.call_function("div", top, x["l"].cast("decimal(18,0)") * x["r"].cast("decimal(18,0)")).alias("score"), (i + 1).alias("k"), x["l"].alias("l"), x["r"].alias("r")))
    return F.array_min(cuts)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases."""
    found, totals = phrases(docs, text_col, lang_col, least, longest)
    kept = found.where(F.col("covered") * 100 < F.col("a") * SUBSUMED).join(totals, "lang")
    cut = weakest_cut(F.col("a"), F.col("n"), F.col("heads"), F.col("tails"))
    rows = kept.withColumn("cut", cut).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First the best of each deal, then the best of these, DEALT * top rows a language at most.
    dealt = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(DEALT))).orderBy(*order)
    best = rows.withColumn("at", F.row_number().over(dealt)).where(F.col("at") <= top).drop("at")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op13: the best collocations of each language."""
    return collocations(common.table(spark, sf_dir, "documents"))


SQL = f"""
WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents),
    worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
    totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
    places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
    grams AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k FROM places, (SELECT unnest(range(1, {LONGEST + 1})) AS k) WHERE i + k - 1 <= len(w)),
    counts AS (SELECT lang, phrase, any_value(k) AS k, count(*) AS f FROM grams GROUP BY lang, phrase HAVING count(*) >= {LEAST}),
    cuts AS (
        SELECT c.lang, c.phrase, c.k, c.f AS a, cut, string_split(c.phrase, ' ') AS w, l.f AS l, r.f AS r, t.n, ((1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
        FROM counts c CROSS JOIN (SELECT unnest(range(1, {LONGEST})) AS cut) JOIN totals t USING (lang)
        JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(string_split(c.phrase, ' ')[:cut], ' ')
        JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(string_split(c.phrase, ' ')[cut + 1:], ' ')
        WHERE cut < c.k),
    inside AS (
        SELECT lang, array_to_string(string_split(phrase, ' ')[s:e], ' ') AS phrase, max(f) AS f
        FROM counts, (SELECT unnest(range(1, {LONGEST + 1})) AS s), (SELECT unnest(range(1, {LONGEST + 1})) AS e)
        WHERE s < e AND e <= k AND e - s + 1 < k GROUP BY ALL),
    best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    kept AS (SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.f IS NULL OR 100 * i.f < {SUBSUMED} * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept QUALIFY rank <= {TOP}
"""
