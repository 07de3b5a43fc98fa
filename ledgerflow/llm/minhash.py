"""Near-duplicate groups by fast similarity sketching.

A document is the set of its five-word shingles.  Its sketch has ``COORDS``
coordinates.  In rounds 0..COORDS-1 every shingle is hashed to a coordinate
and a value, and each coordinate keeps the least value; values of a later
round are larger than those of any earlier one.  Rounds COORDS..2*COORDS-1
offer every shingle to one coordinate each, so that all coordinates are
filled.  The share of equal coordinates of two sketches is concentrated
about the Jaccard similarity of the sets.  Bands of coordinates bring
documents together; every link is confirmed on the full sets.

With ``BANDS`` bands of ``ROWS`` coordinates, a pair at similarity 0.85 shares
no band with probability (1 - 0.85**ROWS)**BANDS = 1.4e-9, one at 0.8, the
threshold of the pipeline's stage, with 7.9e-6.

Documents with equal sets form one class, which is sketched and compared
once.  Within a bucket of the bands, classes are compared with a few pivots
at a time and those that are connected already are not compared again, so a
group of thousands of near copies costs a few comparisons a member.  Rounds go
on until every bucket holds one component or all its pairs are settled.  Each
pair is looked at in the first band that it shares.  Before sets are compared,
two bounds leave pairs out: two bits of each coordinate, and the number of
shingles that a set has alone among all the sets looked at, which no
intersection can hold.

Defined results: without words (null, empty or white space) a set is empty,
linked with nothing, and the document is its own component; with one to four
words the whole sequence is the one shingle; rows with equal sets are linked;
a null id never gives a component its name: a component of null ids only has
a null component_id and its rows count as kept; repeated rows give repeated
results.  Sets are held as 64-bit hashes of the shingles, and classes as
64-bit hashes of sets.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm import common
from ledgerflow.llm.common import row_uid

SHINGLE = 5
ROWS = 8
BANDS = 64
COORDS = ROWS * BANDS
#: Query op6 links sets with 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Pivots of a bucket in the rounds; the last number holds for all further rounds.
PIVOTS = (1, 8, 512)
#: Chance that two bits of each coordinate leave out a pair at the threshold.
LEFT_OUT = 2e-7
_LONGS = COORDS // 64
#: Slots of the map of documents whose sets are needed: one bit each.
SLOTS = 1 << 22
_UNFILLED = np.uint64(0xFFFFFFFFFFFFFFFF)
_ROUND_BITS = np.uint64(64 - 11)


def most_different(percent: int) -> int:
    """Pairs of sketches that differ in more than this many coordinates, by
    their last two bits, are not compared.  At the threshold a coordinate
    differs so with probability 0.75 * (1 - percent / 100); more than this many
    of ``COORDS`` do with less than ``LEFT_OUT``: 97 at 85, 120 at 80."""
    p = 0.75 * (100 - percent) / 100
    if not p:
        return 0
    more = 0.0
    for k in range(COORDS, 0, -1):
        more += math.comb(COORDS, k) * p**k * (1 - p)**(COORDS - k)
        if more >= LEFT_OUT:
            return k
    return 0


def shingles(text: str, hashes: common.WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles."""
    words = hashes.of(common.ascii_words(text))
    if not len(words):
        return words
    return np.unique(common.window_hashes(words, min(SHINGLE, len(words))))


def sketches(sets: list[np.ndarray], coords: int = COORDS) -> np.ndarray:
    """One row of ``coords`` values for each non-empty set."""
    out = np.full(len(sets) * coords, _UNFILLED, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    items = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    grid = out.reshape(len(sets), coords)
    for r in range(2 * coords):
        if not len(items):
            break
        h = common.mix(items + np.uint64((r + 1) * 0xA24BAED4963EE407 & 0xFFFFFFFFFFFFFFFF))
        value = (h >> np.uint64(11)) | (np.uint64(r) << _ROUND_BITS)
        at = (h & np.uint64(0x7FF)).astype(np.int64) * coords >> 11 if r < coords else np.full(len(items), r - coords)
        np.minimum.at(out, owner * coords + at, value)
        open_rows = (grid == _UNFILLED).any(1)
        if not open_rows.all():
            keep = open_rows[owner]
            items, owner = items[keep], owner[keep]
    return grid


def band_keys(grid: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per document and band; keys of different bands differ."""
    parts = grid.reshape(len(grid), -1, rows)
    acc = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), parts.shape[:2])
    for j in range(rows):
        acc = common.mix(acc ^ parts[:, :, j]) + np.uint64(j)
    return common.mix(acc)


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(uid, doc_id, n_shingles, cls, bands, bits) for every row: hash of the
    id and text, set size, hash of the set (null if empty), band keys and the
    last two bits of each coordinate.  A task gives the bands of a set once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = common.WordHashes(), set()
        for b in common.slices(batches, 256):
            sets = [shingles(t, hashes) for t in common.texts(b, "text")]
            cls = [int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())))) if len(s) else None for s in sets]
            fresh = []
            for i, c in enumerate(cls):
                if c is not None and c not in seen:
                    seen.add(c)
                    fresh.append(i)
            bands: list = [None] * len(sets)
            bits: list = [None] * len(sets)
            if fresh:
                grid = sketches([sets[i] for i in fresh])
                last = np.packbits(np.concatenate(((grid & np.uint64(1)).astype(np.uint8), (grid >> np.uint64(1) & np.uint64(1)).astype(np.uint8)), axis=1), axis=1).view(np.int64)
                for i, k, x in zip(fresh, band_keys(grid).view(np.int64), last, strict=True):
                    bands[i], bits[i] = k, x
            if len(seen) > 1_000_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(cls, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))],
                                             ["uid", "doc_id", "n_shingles", "cls", "bands", "bits"])

    rows = docs.select(row_uid(id_col, text_col).alias("uid"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return common.map_arrow(rows, "uid long, doc_id long, n_shingles long, cls long, bands array<long>, bits array<long>", run)


def wanted(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Those documents whose id may be among the chosen ones.  The chosen ids
    are marked in a map of ``SLOTS`` bits, at most 65,536 rows of 64, which all
    tasks get; what it lets through besides is sorted out by a join."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS))
    marks = chosen.select((slot / 64).cast("int").alias("row"), F.pmod(slot, F.lit(64)).cast("int").alias("bit")) \
        .groupBy("row").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("marks"))
    at = docs.withColumn("row", (slot / 64).cast("int")).withColumn("bit", F.pmod(slot, F.lit(64)).cast("int"))
    return at.join(F.broadcast(marks), "row").where(F.expr("shiftright(marks, bit) & 1 = 1")).drop("row", "bit", "marks")


def full_sets(docs: DataFrame, classes: DataFrame, rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(cls, items): the shingles of one document of each class in ``classes``."""
    chosen = rows.where("doc_id is not null").join(classes, "cls", "left_semi").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
    nameless = rows.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("d"), F.min("uid").alias("uid")).where("d is null").join(classes, "cls", "left_semi").select("cls", "uid")
    chosen = common.stored(chosen, "chosen")
    all_docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = wanted(all_docs, chosen).join(chosen, "doc_id").select("cls", "text")
    without_id = docs.where(F.col(id_col).isNull()).select(row_uid(id_col, text_col).alias("uid"), F.col(text_col).alias("text")).join(nameless, "uid").select("cls", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = common.WordHashes()
        for b in common.slices(batches, 256):
            sets = [shingles(t, hashes) for t in common.texts(b, "text")]
            right = [i for i, (s, c) in enumerate(zip(sets, b.column("cls").to_pylist(), strict=True)) if int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())))) == c]
            yield pa.RecordBatch.from_arrays([b.column("cls").take(pa.array(right, pa.int64())), pa.array([sets[i].view(np.int64) for i in right], pa.list_(pa.int64()))], ["cls", "items"])

    return common.map_arrow(found.union(without_id), "cls long, items array<long>", run).dropDuplicates(["cls"])


def linkable(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(cls, shared) of the sets that can have a link at all: shared is the
    number of their items that some other set has too, and a link needs
    ``percent`` of a set's items in common with another."""
    alone = sets.select("cls", F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("cls").alias("cls")) \
        .where("n = 1").groupBy("cls").agg(F.count(F.lit(1)).alias("alone"))
    sized = sets.select("cls", F.size("items").alias("size")).join(alone, "cls", "left").withColumn("shared", F.col("size") - F.coalesce("alone", F.lit(0)))
    return sized.where(F.col("shared") * 100 >= F.col("size") * percent).select("cls", "shared")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of the pairs (a, b) of classes whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("cls").alias("a"), F.col("items").alias("items_a")), "a") \
        .join(sets.select(F.col("cls").alias("b"), F.col("items").alias("items_b")), "b")
    common_n = F.size(F.array_intersect("items_a", "items_b"))
    return both.select("a", "b", common_n.alias("n"), (F.size("items_a") + F.size("items_b")).alias("m")).where(F.col("n") * 100 >= (F.col("m") - F.col("n")) * percent).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(cls, comp): the least class that can be reached from each linked class."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = common.stored(both.distinct(), "links")
    label = common.stored(both.groupBy(F.col("a").alias("cls")).agg(F.least(F.col("cls"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(label, both.b == label.cls).groupBy("a").agg(F.min("comp").alias("near"))
        step = label.join(near, label.cls == near.a).select("cls", "comp", F.least("comp", "near").alias("to"))
        over = label.select(F.col("cls").alias("to"), F.col("comp").alias("far"))
        moved = common.stored(step.join(over, "to").select("cls", F.least("to", "far").alias("comp"), (F.least("to", "far") < F.col("comp")).alias("moved")), "labels")
        label = moved.select("cls", "comp")
        if not moved.where("moved").limit(1).count():
            return label


def worth_comparing(percent: int = PERCENT) -> Column:
    """Whether the classes of a joined pair, the second with names ending in
    _a, can be linked and this band is the first that they share."""
    differ = sum((F.bit_count((F.col("bits")[i].bitwiseXOR(F.col("bits_a")[i])).bitwiseOR(F.col("bits")[i + _LONGS].bitwiseXOR(F.col("bits_a")[i + _LONGS]))) for i in range(_LONGS)), F.lit(0))
    size = F.least("n_shingles", "n_shingles_a") * 100 >= F.greatest("n_shingles", "n_shingles_a") * percent
    # 32 bits of each band's key: another band seems equal with probability 1.5e-8.
    # Of two sets of m items together, similar ones share at least m * P / (100 + P).
    overlap = F.least("shared", "shared_a") * (100 + percent) >= (F.col("n_shingles") + F.col("n_shingles_a")) * percent
    first = F.array_position(F.zip_with("bands", "bands_a", lambda x, y: x == y), True) == F.col("band") + 1
    return size & overlap & (differ <= most_different(percent)) & first


def similar_classes(rows: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int = PERCENT) -> DataFrame:
    """(cls, comp) of all classes that are linked with another."""
    sketched = rows.where("bands is not null")
    bucket = Window.partitionBy("key")
    banded = sketched.select("cls", F.posexplode("bands").alias("band", "key"))
    shared = banded.select("key", "band", "cls", F.min("cls").over(bucket).alias("lo"), F.max("cls").over(bucket).alias("hi")).where("lo < hi").select("key", "band", "cls").distinct()
    shared = common.stored(shared, "buckets")
    sets = common.stored(full_sets(docs, shared.select("cls").distinct(), rows, id_col, text_col), "sets")
    first = common.stored(linkable(sets, percent), "linkable")
    sets = common.stored(sets.join(first, "cls", "left_semi"), "sets")
    able = common.stored(linkable(sets, percent), "linkable")
    about = sketched.join(able, "cls").groupBy("cls", "n_shingles", "shared").agg(F.first("bits").alias("bits"), F.transform(F.first("bands"), lambda x: F.shiftright(x, 32).cast("int")).alias("bands"))
    about = common.stored(about, "sketches")
    rest = shared.join(able.select("cls"), "cls", "left_semi")
    links = label = None
    for step in itertools.chain(PIVOTS, itertools.repeat(PIVOTS[-1])):
        known = rest.withColumn("comp", F.col("cls")) if label is None else rest.join(label, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        mixed = known.withColumn("lo", F.min("comp").over(bucket)).withColumn("hi", F.max("comp").over(bucket)).where("lo < hi")
        rest = common.stored(mixed.withColumn("place", F.row_number().over(bucket.orderBy("cls"))).drop("lo", "hi"), "open")
        pivots = rest.where(F.col("place") <= step).join(about, "cls").select("key", *[F.col(c).alias(f"{c}_a") for c in ("cls", "comp", "n_shingles", "shared", "bits", "bands")])
        pairs = rest.join(about, "cls").join(pivots, (F.col("cls_a") < F.col("cls")) & (F.col("comp") != F.col("comp_a")) & worth_comparing(percent) & (rest.key == pivots.key))
        more = common.stored(confirmed(pairs.select(F.col("cls_a").alias("a"), F.col("cls").alias("b")), sets, percent), "links")
        if links is None or more.limit(1).count():
            links = more if links is None else links.union(more)
            label = components(links)
        rest = rest.where(F.col("place") > step).select("key", "band", "cls")
        if not rest.limit(1).count():
            return label


def components_of_rows(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """(uid, doc_id, n_shingles, comp, component_id) for every row; comp names the group (null without words)."""
    rows = common.stored(described(docs, id_col, text_col), "sets-by-row")
    label = similar_classes(rows, docs, id_col, text_col, percent)
    named = rows.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least")) \
        .join(label, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    names = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    by_class = named.select("cls", "comp").join(names, "comp").select("cls", "comp", "component_id")
    out = rows.select("uid", "doc_id", "n_shingles", "cls").join(by_class, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("uid", "doc_id", "n_shingles", "comp", component.alias("component_id"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(uid, doc_id, n_shingles, component_id, kept) for every row."""
    rows = components_of_rows(docs, id_col, text_col, percent)
    return rows.select("uid", "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op6: the near-duplicate group of every document."""
    return groups(common.table(spark, sf_dir, "documents")).drop("uid")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One document of each group, as it is: that with the least id, null last,
    and of several with that id one of them.  Rows without words are in no
    group; repeated ones of them are kept once."""
    rows = components_of_rows(docs, id_col, text_col, percent)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid"))["uid"].alias("uid")
    kept = rows.where("comp is not null").groupBy("comp").agg(first).select("uid") \
        .union(rows.where("comp is null").select("uid").distinct())
    held = docs.select(row_uid(id_col, text_col).alias("uid"), common.whole_row(docs))
    return held.join(kept, "uid", "left_semi").dropDuplicates(["uid"]).select("row.*")


#: Sets of five-word strings, all pairs that share one, and what each document reaches.
SQL = f"""
WITH RECURSIVE worded AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                            ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS items FROM worded),
    members AS (SELECT doc_id, unnest(items) AS item FROM sets),
    shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM members a JOIN members b ON b.item = a.item AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT x, y FROM shared JOIN sets a ON a.doc_id = x JOIN sets b ON b.doc_id = y WHERE 100 * n >= {PERCENT} * (len(a.items) + len(b.items) - n)),
    edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reached AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, e.y FROM reached r JOIN edges e ON e.x = r.other)
SELECT s.doc_id, len(s.items) AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept
FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r USING (doc_id)
"""
