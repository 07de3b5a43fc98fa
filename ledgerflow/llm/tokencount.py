"""Unigram token counts with dynamic programming shared over a trie.

The vocabulary is a file of ranks (base64 token, rank) that holds every
single byte; a token's log probability follows Zipf's law in its rank,
-log(rank + SHIFT), held as an integer (millionths), so that equal scores
are exactly equal.  A text is cut into pre-tokens by the pattern.  Distinct
pre-tokens are inserted into a trie of bytes; each node keeps the best
forward score of its prefix and the number of tokens of that segmentation,
both computed once from its ancestors, whatever number of pre-tokens pass
through it.  The node where a pre-token ends holds its count.  A document's
count is the sum over its pre-tokens.

Tries live within a task, are shared by all its documents and start anew
beyond ``NODES`` nodes, which changes no result.

Defined results: a null or empty text has 0 tokens and score 0; ties between
segmentations go to the one with fewer tokens; repeated rows count alike; ids
are carried as they are; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import common
from ledgerflow.llm.bpe import read_ranks

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SHIFT = 2.7
UNIT = 1_000_000
NODES = 1_000_000


def token_scores(path: str) -> dict[bytes, int]:
    """Log probability of each token in millionths, up to a constant."""
    scores = {t: -round(UNIT * math.log(rank + SHIFT)) for rank, t in enumerate(read_ranks(path))}
    if missing := [b for b in range(256) if bytes([b]) not in scores]:
        raise ValueError(f"{path} lacks the bytes {missing}")
    return scores


class Trie:
    """Forward scores by prefix.  Nodes are numbered; node 0 is the empty prefix."""

    def __init__(self, scores: dict[bytes, int]):
        # Scores (below 0) of tokens, None for other ends of tokens: a walk
        # back stops at a piece that is neither.
        self.pieces = dict.fromkeys(t[i:] for t in scores for i in range(len(t))) | scores
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.best = [0]
        self.count = [0]
        self.terminal: dict[str, tuple[int, int]] = {}

    def insert(self, pretoken: str) -> tuple[int, int]:
        """(tokens, score) of the pre-token; nodes on its path that are new get their scores."""
        raw = pretoken.encode("utf-8", "surrogatepass")
        child, best, count, known = self.child, self.best, self.count, self.pieces.get
        node, path, size = 0, [0], len(raw)
        while len(path) <= size and (nxt := child.get(node << 8 | raw[len(path) - 1])) is not None:
            node = nxt
            path.append(node)
        for end in range(len(path), size + 1):
            top = fewest = None
            start = end
            while start:
                start -= 1
                piece = raw[start:end]
                s = known(piece, 0)
                if s:
                    at = path[start]
                    s += best[at]
                    n = count[at] + 1
                    if top is None or s > top or s == top and n < fewest:
                        top, fewest = s, n
                elif s == 0:
                    break
            nxt = child[node << 8 | raw[end - 1]] = len(best)
            best.append(top)
            count.append(fewest)
            node = nxt
            path.append(node)
        result = self.terminal[pretoken] = (self.count[node], self.best[node])
        return result

    def measure(self, pretokens: list[str]) -> tuple[int, int]:
        """(tokens, score) of a document's pre-tokens."""
        if len(self.best) > NODES:
            self.clear()
        known = self.terminal
        for p in set(pretokens).difference(known):
            self.insert(p)
        if not pretokens:
            return 0, 0
        tokens, score = zip(*map(known.__getitem__, pretokens), strict=True)
        return sum(tokens), sum(score)


_TRIES: dict[str, Trie] = {}


def trie(path: str) -> Trie:
    if path not in _TRIES:
        _TRIES[path] = Trie(token_scores(path))
    return _TRIES[path]


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens, score) for every row; score is the
    segmentation's log probability up to a constant per token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, cut = trie(path), regex.compile(pattern).findall
        for b in common.slices(batches):
            found = [cut(x) for x in common.texts(b, "text")]
            sums = [t.measure(p) for p in found]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(map(len, found), pa.int64()), pa.array([n for n, _ in sums], pa.int64()), pa.array([s / UNIT for _, s in sums], pa.float64())],
                                             ["doc_id", "n_pretokens", "n_tokens", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return common.map_arrow(rows, f"doc_id {kind}, n_pretokens long, n_tokens long, score double", run)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op7: token counts of every document."""
    return counts(common.table(spark, sf_dir, "documents"))
