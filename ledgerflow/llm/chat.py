"""Chat formatting over reply trees.

Messages form trees by their parent.  Iterative self-joins (each doubling the
distance covered, so a path of n messages takes log2(n) joins) give every
message its root, depth and path score.  Leaves are the ends of
root-to-leaf paths; the branches of a root are ranked by score, the best
``keep`` are chosen, and the same jump tables list the messages of each
chosen path.  A path is formatted as one conversation, held as one segment a
message in order, with a loss mask over the assistant's texts.

Template (fixed values): a turn is ``### role:``, a line end, the text,
``</turn>`` and a line end.  Inside roles and texts a backslash is put before
each backslash, ``</turn>`` and ``### `` (in roles before ``:`` too), and
taken away again on reading.

Defined results: a null role or text counts as empty; a message whose parent
is null or missing is a root; of several messages with one id in one tree the
least (role, text) stays; equal scores are ranked by the smaller leaf id;
cycles have no root and are left out; null tree ids form one tree; an empty
table gives no conversation; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm import common

# Fixed values of the template.
OPEN, AFTER_ROLE, CLOSE = "### ", ":\n", "</turn>\n"
LEARNT_ROLE = "assistant"
_TURN = re.compile(r"### ((?:\\.|[^\\:])*):\n((?:\\.|[^\\])*?)</turn>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)
#: Turns of one numbering block; a long conversation is numbered in blocks.
BLOCK = 256


def escape(text: Column, role: bool = False) -> Column:
    return F.regexp_replace(text, r"(\\|</turn>|### " + ("|:)" if role else ")"), r"\\$1")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def numbered(turns: DataFrame, tree_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(tree, node, parent, role, text, score): rows by turn as a chain of
    messages.  Rows of one turn follow each other by role and text."""
    rows = turns.select(F.col(tree_col).alias("tree"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("block", F.floor(F.col("turn") / BLOCK))
    within = Window.partitionBy("tree", "block").orderBy("turn", "role", "text")
    earlier = Window.partitionBy("tree").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("tree", "block").agg(F.count("*").alias("n")).select(F.col("tree").alias("t"), F.col("block").alias("b"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    rows = rows.withColumn("place", F.row_number().over(within)).join(offsets, F.col("tree").eqNullSafe(F.col("t")) & F.col("block").eqNullSafe(F.col("b")))
    node = F.col("offset") + F.col("place")
    return rows.select("tree", node.alias("node"), F.when(node > 1, node - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def chosen_paths(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """(tree, path, rank, place, node, role, text) of the messages on the best
    ``keep`` root-to-leaf paths of every root (None: all); path is the leaf's id.

    ``messages``: tree, node, parent, role, text, score."""
    key = F.coalesce(F.concat(F.lit("="), F.col("tree").cast("string")), F.lit("null"))
    rows = messages.select(key.alias("key"), "tree", "node", "parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")).where("node is not null")
    rows = rows.groupBy("key", "node").agg(F.min(F.struct("role", "text", "parent", "score", "tree")).alias("m")).select("key", "node", "m.*")
    rows = common.stored(rows, "messages")
    present = rows.select(F.col("key").alias("k"), F.col("node").alias("anc"))
    cur = rows.join(present, (rows.key == F.col("k")) & (rows.parent == F.col("anc")), "left").select("key", "node", "anc", F.lit(1).cast("long").alias("hops"), "score", F.col("node").alias("top"))
    cur = common.stored(cur, "jumps")
    parents = cur.where("anc is not null").select("key", F.col("anc").alias("node")).distinct()
    leaves = cur.select("key", "node").join(parents, ["key", "node"], "left_anti")
    jumps, total = [], rows.count()
    while (1 << len(jumps)) <= 2 * total and cur.where("anc is not null").limit(1).count():
        # Messages whose pointer has passed the root are done and not joined again.
        ahead = cur.where("anc is not null")
        jumps.append(ahead.select("key", "node", "anc"))
        far = cur.select(F.col("key").alias("k"), F.col("node").alias("n"), F.col("anc").alias("far_anc"), F.col("hops").alias("far_hops"), F.col("score").alias("far_score"), F.col("top").alias("far_top"))
        joined = ahead.join(far, (F.col("key") == F.col("k")) & (F.col("anc") == F.col("n")))
        moved = joined.select("key", "node", F.col("far_anc").alias("anc"), (F.col("hops") + F.col("far_hops")).alias("hops"), (F.col("score") + F.col("far_score")).alias("score"), F.col("far_top").alias("top"))
        cur = common.stored(moved.unionByName(cur.where("anc is null")), "jumps")
    ends = leaves.join(cur.where("anc is null"), ["key", "node"]).select("key", F.col("node").alias("path"), "score", "top")
    if keep == 1:
        best = ends.groupBy("key", "top").agg(F.min(F.struct((-F.col("score")).alias("s"), "path")).alias("b")).select("key", "b.path", F.lit(1).alias("rank"))
    else:
        best = ends.withColumn("rank", F.row_number().over(Window.partitionBy("key", "top").orderBy(F.col("score").desc(), "path")))
        best = (best if keep is None else best.where(F.col("rank") <= keep)).select("key", "path", "rank")
    on_path = common.stored(best.withColumn("node", F.col("path")), "paths")
    for jump in jumps:
        further = on_path.join(jump, ["key", "node"]).select("key", "path", "rank", F.col("anc").alias("node"))
        on_path = common.stored(on_path.unionByName(further), "paths")
    placed = on_path.join(cur.select("key", "node", F.col("hops").alias("place")), ["key", "node"])
    return placed.join(rows.select("key", "node", "tree", "role", "text"), ["key", "node"]).select("tree", "path", "rank", "place", "node", "role", "text")


def formatted(paths: DataFrame, learnt: str = LEARNT_ROLE) -> DataFrame:
    """(tree, path, rank, place, segment, loss_start, loss_chars): the segments
    of each conversation in order of place.  The loss mask covers loss_chars
    code points of the segment from loss_start (0-based)."""
    head = F.concat(F.lit(OPEN), escape(F.col("role"), role=True), F.lit(AFTER_ROLE))
    body = escape(F.col("text"))
    is_learnt = F.col("role") == learnt
    return paths.select("tree", "path", "rank", "place", F.concat(head, body, F.lit(CLOSE)).alias("segment"), F.length(head).alias("loss_start"), F.when(is_learnt, F.length(body)).otherwise(0).alias("loss_chars"), is_learnt.alias("learnt"))


class Reader:
    """Reads one conversation back from its segments, as they come."""

    def __init__(self):
        self.rest, self.turns, self.chars, self.loss_chars = "", 0, 0, 0
        self.sha, self.loss = hashlib.sha256(), hashlib.sha256()

    def take(self, segment: str, loss_start: int, loss_chars: int) -> None:
        self.chars += len(segment)
        under = unescape(segment[loss_start:loss_start + loss_chars])
        self.loss_chars += len(under)
        self.loss.update(under.encode())
        self.rest += segment
        at = 0
        while m := _TURN.match(self.rest, at):
            self.turns += 1
            self.sha.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
            at = m.end()
        self.rest = self.rest[at:]

    def row(self, tree, path) -> tuple:
        if self.rest:
            raise ValueError(f"conversation {tree}, path {path}: what remains is not a turn")
        return tree, path, self.turns, self.sha.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(segments: DataFrame) -> DataFrame:
    """(tree, path, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars) of each conversation.  Its segments are streamed in
    order through one task, and only the turn at hand is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["tree", "path", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        now, reader, done = None, None, []

        def batch() -> pa.RecordBatch:
            cols = zip(*done, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()], strict=True)], names)

        for b in common.slices(batches):
            for tree, path, segment, start, chars in zip(*(b.column(k).to_pylist() for k in ("tree", "path", "segment", "loss_start", "loss_chars")), strict=True):
                if reader is None or (tree, path) != now:
                    if reader:
                        done.append(reader.row(*now))
                    now, reader = (tree, path), Reader()
                reader.take(segment, start, chars)
            if done:
                yield batch()
                done.clear()
        if reader:
            done.append(reader.row(*now))
            yield batch()

    rows = segments.select(F.col("tree").cast("long").alias("tree"), F.col("path").cast("long").alias("path"), "place", "segment", "loss_start", "loss_chars")
    rows = rows.repartition("tree", "path").sortWithinPartitions("tree", "path", "place")
    return common.map_arrow(rows, "tree long, path long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long", run)


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op5: every conversation, and conversation -7, formatted and read back."""
    hard = r"\### Assistant: </turn> ok"
    rows = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    back = read_back(formatted(chosen_paths(numbered(rows.unionByName(extra)))))
    return back.select(F.col("tree").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


#: Every conversation is one chain, so its path holds all its turns in order.
SQL = r"""
WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\### Assistant: </turn> ok'),
    sized AS (
        SELECT *, length('### ') + length(regexp_replace(role, '(\\|</turn>|### |:)', '\\\1', 'g')) + length(':x')
                  + length(regexp_replace(text, '(\\|</turn>|### )', '\\\1', 'g')) + length('</turn>x') AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
