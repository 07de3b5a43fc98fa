"""Benchmark decontamination by greedy string tiling.

Texts are word sequences (letters and digits, lower case).  A benchmark
item's ``LEAST``-word windows are the seeds; a document's windows are joined
with them, which gives the (document, item) pairs to look at and, for each
document, the runs of words that lie in some seed.  Any tile of at least
``LEAST`` words lies within one run, so only runs leave the scan, not texts.
For each pair the longest common unmarked matches are marked again and again
(running Karp-Rabin with a shrinking window) until none of ``LEAST`` words is
left.  The tiles do not overlap and may stand in any order, so reordered
passages are caught.  A pair is a leak if the tiles cover at least
``COVERAGE`` of the item's words.

Seeds are given to all tasks only while there are at most ``SENT_SEEDS`` of
them (8 bytes each); beyond that the documents' windows are joined by a
shuffle, with the same result.

Defined results: a null or empty text or item matches nothing; an item
shorter than ``LEAST`` words is matched as one window of its own length;
repeated rows give one result row for each distinct (id, text, item); a null
id is carried; ties between equally long matches go to the first position in
the item, then in the document; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import common
from ledgerflow.llm.common import row_uid

LEAST = 5
COVERAGE = 0.5
SENT_SEEDS = 1 << 20
_GAP = bytes(b if chr(b).isalnum() or b >= 0x80 else 0x20 for b in range(256))


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_GAP).split()


def item_table(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, size, words, seeds): word hashes and window hashes of each item that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = common.WordHashes()
        for b in common.slices(batches):
            all_words = [hashes.of(words(t)) for t in common.texts(b, "text")]
            size = [min(LEAST, len(w)) for w in all_words]
            seeds = [np.unique(common.window_hashes(w, s)).view(np.int64) if s else np.empty(0, np.int64) for w, s in zip(all_words, size, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array(size, pa.int32()), pa.array([w.view(np.int64) for w in all_words], pa.list_(pa.int64())), pa.array(seeds, pa.list_(pa.int64()))],
                                             ["item_id", "size", "words", "seeds"])

    rows = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["item_id"]
    return common.map_arrow(rows, f"item_id {kind}, size int, words array<long>, seeds array<long>", run).where("size > 0")


def runs_of(docs: DataFrame, seeds: np.ndarray | None, sizes: list[int], id_col: str, text_col: str) -> DataFrame:
    """(uid, doc_id, runs, hits) for documents with a window in ``seeds`` (None: of all windows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = common.WordHashes()
        for b in common.slices(batches):
            keep, runs, found = [], [], []
            for i, t in enumerate(common.texts(b, "text")):
                w = hashes.of(words(t))
                inside = np.zeros(len(w) + 1, np.int32)
                hit = []
                for size in sizes:
                    h = common.window_hashes(w, size)
                    if seeds is None:
                        at = np.arange(len(h))
                    else:
                        near = np.searchsorted(seeds, h)
                        near[near == len(seeds)] = 0
                        at = np.flatnonzero(seeds[near] == h)
                    if len(at):
                        hit.append(np.unique(h[at]))
                        np.add.at(inside, at, 1)
                        np.add.at(inside, at + size, -1)
                if hit:
                    on = np.concatenate(([0], (np.cumsum(inside)[:-1] > 0).astype(np.int8), [0]))
                    edge = np.flatnonzero(np.diff(on))
                    keep.append(i)
                    runs.append([w[s:e].view(np.int64) for s, e in zip(edge[::2], edge[1::2], strict=True)])
                    found.append(np.unique(np.concatenate(hit)).view(np.int64))
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("uid").take(rows), b.column("doc_id").take(rows), pa.array(runs, pa.list_(pa.list_(pa.int64()))), pa.array(found, pa.list_(pa.int64()))],
                                             ["uid", "doc_id", "runs", "hits"])

    rows = docs.select(row_uid(id_col, text_col).alias("uid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return common.map_arrow(rows, f"uid long, doc_id {kind}, runs array<array<long>>, hits array<long>", run)


def tiles(runs: list[np.ndarray], item: np.ndarray, least: int) -> list[tuple[int, int, int, int]]:
    """Greedy string tiling: (position in item, run, position in run, length) of every tile."""
    free = np.ones(len(item), bool)
    run_free = [np.ones(len(r), bool) for r in runs]
    done: list[tuple[int, int, int, int]] = []

    def unmarked(mask: np.ndarray, size: int) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return np.flatnonzero(total[size:] - total[:-size] == size)

    def longest(size: int) -> list[tuple[int, int, int, int]]:
        """All maximal unmarked matches of at least ``size``, each from its first word."""
        table = defaultdict(list)
        h = common.window_hashes(item, size)
        for p in unmarked(free, size):
            table[int(h[p])].append(int(p))
        out = []
        for r, run in enumerate(runs):
            if len(run) < size or not table:
                continue
            at = unmarked(run_free[r], size)
            for t, x in zip(at.tolist(), common.window_hashes(run, size)[at].tolist(), strict=True):
                for p in table.get(x, ()):
                    if p and t and free[p - 1] and run_free[r][t - 1] and item[p - 1] == run[t - 1]:
                        continue
                    n = 0
                    while p + n < len(item) and t + n < len(run) and free[p + n] and run_free[r][t + n] and item[p + n] == run[t + n]:
                        n += 1
                    if n >= size:
                        out.append((n, p, r, t))
        return out

    size = max([min(len(item), max(map(len, runs), default=0)), least])
    while size >= least:
        found = longest(size)
        if not found:
            size = size // 2 if size > 2 * least else least if size > least else 0
            continue
        top = max(n for n, _, _, _ in found)
        for n, p, r, t in sorted(found, key=lambda m: (-m[0], *m[1:])):
            if n == top and free[p:p + n].all() and run_free[r][t:t + n].all():
                free[p:p + n] = run_free[r][t:t + n] = False
                done.append((p, r, t, n))
    return done


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
          coverage: float = COVERAGE, sent_seeds: int = SENT_SEEDS) -> DataFrame:
    """(uid, doc_id, item_id, item_words, covered_words, coverage, n_tiles, longest_tile) of every leak."""
    items = common.stored(item_table(benchmark, item_id, item_text), "items")
    by_seed = items.select("item_id", F.explode("seeds").alias("seed"))
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())
    few = by_seed.limit(sent_seeds + 1).count() <= sent_seeds
    seeds = np.unique(by_seed.select("seed").toArrow().column(0).to_numpy().view(np.uint64)) if few else None
    docs_runs = runs_of(docs, seeds, sizes, id_col, text_col) if seeds is None or len(seeds) else runs_of(docs.limit(0), None, sizes, id_col, text_col)
    docs_runs = common.stored(docs_runs, "runs") if few else docs_runs
    pairs = docs_runs.select("uid", F.explode("hits").alias("seed")).join(by_seed, "seed").select("uid", "item_id").distinct()
    kinds = dict(docs_runs.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    both = docs_runs.dropDuplicates(["uid"]).join(pairs, "uid").join(items.select("item_id", "words", "size"), "item_id").select("uid", "doc_id", "item_id", "runs", "words", "size")

    # Few bytes, much work: a number of partitions of its own, which Spark does not put together.
    both = both.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "uid", "item_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["uid", "doc_id", "item_id", "item_words", "covered_words", "coverage", "n_tiles", "longest_tile"]
        for b in common.slices(batches, 256):
            keep, rest = [], []
            for i, (parts, item, size) in enumerate(zip(b.column("runs").to_pylist(), b.column("words").to_pylist(), b.column("size").to_pylist(), strict=True)):
                item = np.array(item, np.int64).view(np.uint64)
                found = tiles([np.array(p, np.int64).view(np.uint64) for p in parts], item, size)
                covered = sum(n for *_, n in found)
                if covered >= coverage * len(item):
                    keep.append(i)
                    rest.append((len(item), covered, covered / len(item), len(found), max(n for *_, n in found)))
            rows = pa.array(keep, pa.int64())
            cols = list(zip(*rest, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([b.column("uid").take(rows), b.column("doc_id").take(rows), b.column("item_id").take(rows)] + [pa.array(c, k) for c, k in zip(cols, [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()], strict=True)], names)

    return common.map_arrow(both, f"uid long, doc_id {kinds[0]}, item_id {kinds[1]}, item_words long, covered_words long, coverage double, n_tiles long, longest_tile long", run)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op4: the benchmark items that leak into documents."""
    return leaks(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")).drop("uid")


def cleaned(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without those that hold a benchmark item."""
    found = leaks(docs, benchmark, id_col, text_col).select("uid").distinct()
    held = docs.select(row_uid(id_col, text_col).alias("uid"), common.whole_row(docs))
    return held.join(found, "uid", "left_anti").select("row.*")
