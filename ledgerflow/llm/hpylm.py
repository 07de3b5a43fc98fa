"""A hierarchical Pitman-Yor language model over the bytes of token sequences.

A text is its lower-case words, each followed by a space, then an end symbol.
The next symbol has one restaurant for each context of the last ``ORDER``
symbols; the restaurant's parent is that of the context without its oldest
symbol, so contexts with the same recent symbols share parents, down to the
empty context, whose parent is the uniform distribution.  A table of a
restaurant is a customer of its parent.

Seating is sampled by Gibbs sweeps: all customers of one symbol in one
restaurant are taken out and seated again, one after another, at a new table
with probability (concentration + discount * tables) * parent's probability
against (customers - discount * own tables) for the tables that serve the
symbol; a restaurant's other tables and the parent's probabilities are those
at the start of the sweep.  Beyond ``SINGLY`` customers they are seated in
groups of an eighth of those seated.  Predictive probabilities are averaged
over ``SAMPLES`` sweeps after ``BURN_IN``.

Spark jobs:

1. Every partition of the documents counts its distinct words and its
   distinct (context, symbol) grams; the counts are summed over the corpus and
   given back to each partition's rows.
2. Restaurants of three and more symbols of context are sampled in groups that
   hold all of one pair of last symbols, and so all of their parents; a group
   takes as many pairs as make about ``GROUP`` grams.  The restaurants above
   them number at most 258 * 258, a bound that does not grow with the corpus;
   their seating is sampled from the groups' tables.
3. Each partition's words and grams, now with counts and probabilities, are
   packed into arrays and brought together with its documents, which are read
   as a stream.

Defined results: a null or empty text is the end token alone; a null id
counts as an empty id for the fold; repeated rows are learnt and scored
again each; with no training text all known counts are 0 and all
probabilities come from the uniform base; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm import common

ORDER = 5
END, BEGIN, SYMBOLS = 256, 257, 257
BITS = 9
DISCOUNT = 0.5
CONCENTRATION = 0.5
BURN_IN, SAMPLES = 3, 4
SINGLY = 48
SMOOTHING = 0.1
END_TOKEN = b" "
#: Grams that a task counts at a time.
RUN = 1 << 22
#: Grams that a group of restaurants is meant to have.
GROUP = 50_000
WORD, GRAM, DOCUMENT = 0, 1, 2
#: Entries of a block in one row, and entries that a task packs at a time.
PACK, PACKED = 1024, 1 << 19


def tokens(text: str) -> list[bytes]:
    """The words and the end token, which no word can equal."""
    return [*common.ascii_words(text), END_TOKEN]


def grams(words: list[bytes]) -> np.ndarray:
    """One number per symbol: the symbol in the lowest 9 bits, then its context, the latest first."""
    codes = np.frombuffer(b" ".join(words), np.uint8)[:-1]  # the last space stands for the end token
    s = np.concatenate((np.full(ORDER, BEGIN), codes, [END])).astype(np.int64)
    out = s[ORDER:].copy()
    for j in range(1, ORDER + 1):
        out |= s[ORDER - j:len(s) - j] << BITS * j
    return out


class Tally:
    """Counts by 64-bit key, as sorted arrays."""

    def __init__(self):
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.waiting: list[tuple[np.ndarray, int]] = []
        self.size = 0

    def add(self, keys: np.ndarray, weight: int) -> None:
        self.waiting.append((keys, weight))
        self.size += len(keys)
        if self.size >= RUN:
            self.merge()

    def merge(self) -> None:
        if self.waiting:
            codes, found = pd.factorize(np.concatenate([k for k, _ in self.waiting]))
            weights = np.repeat([w for _, w in self.waiting], [len(k) for k, _ in self.waiting])
            counts = np.bincount(codes, weights=weights, minlength=len(found))
            self.keys, at = np.unique(np.concatenate((self.keys, found)), return_inverse=True)
            self.counts = np.bincount(at, weights=np.concatenate((self.counts, counts)), minlength=len(self.keys)).astype(np.int64)
        self.waiting, self.size = [], 0


def gathered(docs: DataFrame) -> DataFrame:
    """(block, kind, key, n): per block (a partition of the scan) all its words
    and grams, with their counts in training texts (0: only in others)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, tallies, block = common.WordHashes(), (Tally(), Tally()), None
        for b in common.slices(batches):
            for at, train, t in zip(b.column("block").to_pylist(), b.column("train").to_pylist(), common.texts(b), strict=True):
                block = at
                words = tokens(t)
                tallies[WORD].add(hashes.of(words).view(np.int64), int(train))
                tallies[GRAM].add(grams(words), int(train))
        for kind, tally in enumerate(tallies):
            tally.merge()
            for i in range(0, len(tally.keys), 50_000):
                k, n = tally.keys[i:i + 50_000], tally.counts[i:i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), block, np.int32)), pa.array(np.full(len(k), kind, np.int8)), pa.array(k), pa.array(n)], ["block", "kind", "key", "n"])

    return common.map_arrow(docs.select("block", "train", "text"), "block int, kind tinyint, key long, n long", run)


def seat(customers: np.ndarray, parent: np.ndarray, others: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Tables of each (restaurant, symbol) after seating its customers anew.
    ``others``: tables of the restaurant's other symbols."""
    tables = (customers > 0).astype(np.int64)
    seated = tables.copy()
    on = np.flatnonzero(customers > 1)
    while len(on):
        n, t = seated[on], tables[on]
        step = np.where(n < SINGLY, 1, np.minimum(n >> 3, customers[on] - n))
        new = (CONCENTRATION + DISCOUNT * (others[on] + t)) * parent[on]
        tables[on] += rng.binomial(step, new / (new + n - DISCOUNT * t))
        seated[on] += step
        on = on[seated[on] < customers[on]]
    return tables


class Level:
    """The restaurants of one context length: a row for each (context, symbol)."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        _, self.room = np.unique(keys >> BITS, return_inverse=True)
        self.rooms = int(self.room.max(initial=-1)) + 1
        self.customers = self.tables = np.zeros(len(keys), np.int64)

    def totals(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.room, weights=x, minlength=self.rooms)[self.room]

    def predictive(self, parent: np.ndarray) -> np.ndarray:
        own = self.customers - DISCOUNT * self.tables + (CONCENTRATION + DISCOUNT * self.totals(self.tables)) * parent
        return own / (CONCENTRATION + self.totals(self.customers))

    def reseat(self, parent: np.ndarray, rng: np.random.Generator) -> None:
        self.tables = seat(self.customers, parent, (self.totals(self.tables) - self.tables).astype(np.int64), rng)


def sample(keys: np.ndarray, customers: np.ndarray, orders: list[int], base, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gibbs sampling of the levels with ``orders`` symbols of context, longest
    first.  ``base(keys)``: probabilities of the parent of the last level.
    Gives the averaged probability of every key, and the keys of the last
    level with their tables."""
    rng = np.random.default_rng(seed)
    levels, up = [], []
    for order in orders:
        mask = (1 << BITS * (order + 1)) - 1
        below = levels[-1].keys if levels else keys
        k, at = np.unique(below & mask, return_inverse=True)
        levels.append(Level(k))
        up.append(at)
    parents = base(levels[-1].keys)
    first = levels[0]
    first.customers = np.bincount(up[0], weights=customers, minlength=len(first.keys)).astype(np.int64)

    def lift(i: int) -> None:
        levels[i].customers = np.bincount(up[i], weights=levels[i - 1].tables, minlength=len(levels[i].keys)).astype(np.int64)

    for i, level in enumerate(levels):
        if i:
            lift(i)
        level.tables = (level.customers > 0).astype(np.int64)
    mean, tables = np.zeros(len(first.keys)), np.zeros(len(levels[-1].keys))
    for sweep in range(BURN_IN + SAMPLES):
        p = [np.empty(0)] * len(levels) + [parents]
        for i in range(len(levels) - 1, -1, -1):
            p[i] = levels[i].predictive(p[i + 1][up[i + 1]] if i + 1 < len(levels) else parents)
        for i, level in enumerate(levels):
            if i:
                lift(i)
            level.reseat(p[i + 1][up[i + 1]] if i + 1 < len(levels) else parents, rng)
        if sweep >= BURN_IN:
            p = parents
            for i in range(len(levels) - 1, -1, -1):
                p = levels[i].predictive(p if i + 1 == len(levels) else p[up[i + 1]])
            mean += p / SAMPLES
            tables = levels[-1].tables
    return mean[up[0]], levels[-1].keys, tables


def upper_probabilities(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys (two symbols of context) and their probabilities, from their customers."""
    rows = rows.sort_values("key2")
    keys = rows["key2"].to_numpy(np.int64)
    p, _, _ = sample(keys, rows["n"].to_numpy(np.int64), [2, 1, 0], lambda k: np.full(len(k), 1 / SYMBOLS), seed=2)
    return keys, p


def probabilities(counts: DataFrame, n_grams: int) -> DataFrame:
    """(key, logp): log10 of the averaged predictive probability of each gram.
    ``counts``: key, n, one row for each of the ``n_grams`` grams."""
    spark = counts.sparkSession
    low = F.col("key").bitwiseAND((1 << 3 * BITS) - 1)
    counts = counts.withColumn("group", F.pmod(F.xxhash64(F.shiftright(low, BITS)), F.lit(n_grams // GROUP + 1)).cast("int"))

    def subtrees(upper: tuple[np.ndarray, np.ndarray]) -> DataFrame:
        sent = spark.sparkContext.broadcast(upper)

        def run(rows: pd.DataFrame) -> pd.DataFrame:
            keys2, p2 = sent.value
            base = lambda k: p2[np.searchsorted(keys2, k & (1 << 3 * BITS) - 1)]
            rows = rows.sort_values("key")
            keys = rows["key"].to_numpy(np.int64)
            p, last, tables = sample(keys, rows["n"].to_numpy(np.int64), list(range(ORDER, 2, -1)), base, seed=int(rows["group"].iloc[0]))
            two, at = np.unique(last & (1 << 3 * BITS) - 1, return_inverse=True)
            customers = np.bincount(at, weights=tables, minlength=len(two)).astype(np.int64)
            return pd.DataFrame({"upper": np.repeat([False, True], [len(keys), len(two)]), "key": np.concatenate((keys, two)),
                                 "n": np.concatenate((rows["n"].to_numpy(np.int64), customers)), "logp": np.concatenate((np.log10(p), np.zeros(len(two))))})

        return counts.groupBy("group").applyInPandas(run, "upper boolean, key long, n long, logp double")

    common.workers_import(spark)
    # At most 258 * 258 * 257 rows, however large the corpus is.
    first = counts.groupBy(low.alias("key2")).agg(F.sum((F.col("n") > 0).cast("long")).alias("n")).toPandas()
    drawn = subtrees(upper_probabilities(first)).where("upper").select(F.col("key").alias("key2"), "n").toPandas()
    return subtrees(upper_probabilities(drawn)).where("not upper").select("key", "logp")


def packed(entries: DataFrame) -> DataFrame:
    """(block, kind, keys, values): the entries (block, kind, key, value) with up
    to ``PACK`` of one block and kind in a row, as arrays."""

    def flush(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, kind, key, value = (np.concatenate([b.column(i).to_numpy() for b in parts]) for i in range(4))
        order = np.lexsort((kind, block))
        block, kind, key, value = block[order], kind[order], key[order], value[order]
        edges = np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
        starts = np.concatenate([np.arange(s, e, PACK) for s, e in zip([0, *edges], [*edges, len(block)], strict=True)])
        for i in range(0, len(starts), 256):
            rows = starts[i:i + 256]
            last = starts[i + 256] if i + 256 < len(starts) else len(block)
            offsets = pa.array((np.append(rows, last) - rows[0]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x[rows[0]:last])) for x in (key, value)]
            yield pa.RecordBatch.from_arrays([pa.array(block[rows]), pa.array(kind[rows]), *lists], ["block", "kind", "keys", "values"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= PACKED:
                yield from flush(held)
                held, size = [], 0
        if size:
            yield from flush(held)

    return common.map_arrow(entries.select("block", "kind", "key", "value"), "block int, kind tinyint, keys array<long>, values array<double>", run)


def scored(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    for every row; rows where ``train`` holds are learnt from.

    ``docs`` must be a table as read or stored: its partitions are the blocks
    of steps 1 and 3, so both must see the same ones (a word or gram that a
    block lacks fails the job)."""
    rows = docs.select(F.spark_partition_id().alias("block"), F.col(id_col).alias("doc_id"), train.alias("train"), F.col(text_col).alias("text"))
    counted = gathered(rows)
    same = Window.partitionBy("kind", "key")
    totals = common.stored(counted.select("block", "kind", "key", F.sum("n").over(same).alias("n"), (F.col("block") == F.min("block").over(same)).alias("first")), "counts")
    word, one = F.col("first") & (F.col("kind") == WORD), F.col("first") & (F.col("kind") == GRAM)
    n_train, v_train, n_grams, last_block = totals.agg(
        F.coalesce(F.sum(F.when(word, F.col("n"))), F.lit(0)), F.count(F.when(word & (F.col("n") > 0), 1)), F.count(F.when(one, 1)), F.coalesce(F.max("block"), F.lit(0))).first()
    logp = common.stored(probabilities(totals.where("kind = 1 and first").select("key", "n"), n_grams), "probabilities")
    none = F.lit(None)
    entries = totals.where("kind = 0").select("block", "kind", "key", F.col("n").cast("double").alias("value")) \
        .union(totals.where("kind = 1").select("block", "kind", "key").join(logp, "key").select("block", "kind", "key", "logp"))
    id_kind = rows.schema["doc_id"].dataType.simpleString()
    all_rows = packed(entries).select("*", none.cast(id_kind).alias("doc_id"), none.cast("boolean").alias("train"), none.cast("string").alias("text")) \
        .union(rows.select("block", F.lit(DOCUMENT).cast("tinyint"), none.cast("array<long>"), none.cast("array<double>"), "doc_id", "train", "text"))
    log_total = float(np.log10(n_train + SMOOTHING * (v_train + 1)))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, now, parts, ready = common.WordHashes(), None, ([], []), None

        def table(kind: int) -> tuple[pd.Index, np.ndarray]:
            keys = np.concatenate([k for k, _ in parts[kind]]) if parts[kind] else np.empty(0, np.int64)
            values = np.concatenate([v for _, v in parts[kind]]) if parts[kind] else np.empty(0)
            return pd.Index(keys), values

        def look(kind: int, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            at = ready[kind][0].get_indexer(np.concatenate(keys))
            if (at < 0).any():
                raise ValueError("the documents' partitions changed between two readings")
            return ready[kind][1][at], np.concatenate(([0], np.cumsum([len(k) for k in keys])[:-1]))

        def documents(part: pa.RecordBatch) -> pa.RecordBatch:
            words = [tokens(t) for t in common.texts(part)]
            c, at = look(WORD, [hashes.of(w).view(np.int64) for w in words])
            known = np.add.reduceat((c > 0).astype(np.int64), at)
            sizes = np.array(list(map(len, words)))
            base = np.add.reduceat(np.log10(c + SMOOTHING), at) - sizes * log_total
            p, at = look(GRAM, [grams(w) for w in words])
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([not t for t in part.column("train").to_pylist()]), pa.array(sizes), pa.array(known), pa.array(np.full(len(words), n_train)), pa.array(base), pa.array(np.add.reduceat(p, at))], names)

        for b in batches:
            blocks, kinds = b.column("block").to_numpy(), b.column("kind").to_numpy()
            edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for s, e in zip([0, *edges], [*edges, len(blocks)], strict=True):
                if s == e:
                    continue
                if blocks[s] != now:
                    now, parts, ready = blocks[s], ([], []), None
                part = b.slice(s, e - s)
                if kinds[s] != DOCUMENT:
                    parts[kinds[s]].append((part.column("keys").flatten().to_numpy(), part.column("values").flatten().to_numpy()))
                    continue
                if ready is None:
                    ready, parts = (table(WORD), table(GRAM)), ([], [])
                yield from map(documents, common.slices([part], 256))

    # Blocks are dealt in turn, not by a hash: no task has two while another has none.
    deal = max(1, min(last_block + 1, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    together = all_rows.repartitionById(deal, F.pmod("block", F.lit(deal))).sortWithinPartitions("block", "kind")
    return common.map_arrow(together, f"doc_id {id_kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double", run)


def training_fold(id_col: str = "doc_id") -> Column:
    return common.crc_mod(id_col, 10) != 0


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op1: every document's score under the model and under smoothed word frequencies."""
    return scored(common.table(spark, sf_dir, "documents"), training_fold())
