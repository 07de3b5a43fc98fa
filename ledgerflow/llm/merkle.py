"""A Merkle manifest of a data set: every row's leaf with its proof up to the root.

A leaf is the SHA-256 of a row's canonical columns.  Each group (source) has a
tree whose leaves ascend by id; runs of ``FANOUT`` consecutive nodes are hashed
into their parent until one is left, the subroot.  The subroots, in order of
the group, are the leaves of one last tree, whose root stands for the data.

The upper levels come by butterfly exchange.  A block of ``FANOUT ** LEVELS``
consecutive leaves hashes its own subtree.  Then, round by round, the blocks
whose numbers differ in one digit of base ``FANOUT`` only swap the roots of the
subtrees they stand in: each of them hashes the parent (all do, redundantly)
and keeps the siblings it has seen.  After as many rounds as a number has
digits every block holds the upper part of its leaves' proofs and the subroot;
nothing is handed down.  Where the last subtree of a level lacks the block of
some digits, its other blocks send to their partners instead.

A group's ranks come from ranges of (group, id), numbered in each range and
shifted by counts, so a group with most of the rows is spread like any other;
a swap holds at most ``FANOUT`` rows, a block ``FANOUT ** LEVELS`` leaves.
Everything is DataFrame expressions; no text leaves the scan.

Defined results: a null column counts as ``-``, and so does a null id, whose
leaf comes first; rows with equal ids follow each other by leaf, and each
repeated row has a leaf of its own; the null group comes first; an empty table
gives no rows; a table of one group has its subroot as root, and a group of one
row its leaf as subroot; columns not named are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm import common

FANOUT = 16
LEVELS = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_PATH = "cast(array() as array<struct<before:string,after:string>>)"


def canonical(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(canonical, values)), 256)


def tree_of(group: Column) -> Column:
    """A key without nulls that sorts like the group, null first."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group.cast("string")))


def joined(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def step(hashes: Column, at: Column, fanout: int) -> Column:
    """What stands before and after place ``at`` (from 0) of a run."""
    return F.struct(joined(F.slice(hashes, F.lit(1), at)).alias("before"), joined(F.slice(hashes, at + 2, F.lit(fanout))).alias("after"))


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, the rank from 0 within ``tree`` by ``order``
    (which must tell rows apart), and ``n``, the tree's rows."""
    keys = [F.asc_nulls_first(c) for c in ("tree", *order)]
    lines = common.stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("line", F.monotonically_increasing_id()), "merkle-ranges")
    lines = lines.withColumn("part", F.shiftright("line", 33))
    parts = lines.groupBy("tree", "part").agg(F.min("line").alias("first"), F.count("*").alias("here"))
    w = Window.partitionBy("tree")
    before = F.sum("here").over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("tree", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("here").over(w).alias("n"))
    return lines.join(parts, ["tree", "part"]).withColumn("pos", F.col("line") + F.col("shift")).drop("line", "part", "shift")


def blocks(leaves: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(tree, n, block, hash, below): each block's subtree root, and its nodes
    as nested runs of (pos, hash, below); at the bottom ``below`` is the item.
    ``leaves``: tree, n, pos, hash, item."""
    rows = leaves.withColumn("block", F.expr(f"pos div {fanout ** levels}")).withColumnRenamed("item", "below").repartition("tree", "block")
    for level in range(levels):
        rows = rows.withColumn("parent", F.expr(f"pos div {fanout}")).groupBy("tree", "n", "block", "parent") \
            .agg(F.array_sort(F.collect_list(F.struct("pos", "hash", "below"))).alias("below"))
        # Nodes are hashed into their parent while the tree has several.
        up = F.when(F.col("n") > fanout ** level, F.sha2(joined(F.col("below.hash")), 256)).otherwise(F.col("below")[0]["hash"])
        rows = rows.withColumn("hash", up).withColumnRenamed("parent", "pos")
    return rows.select("tree", "n", "block", "hash", "below")


def butterfly(rows: DataFrame, fanout: int) -> DataFrame:
    """(tree, block, hash, path): for every block the tree's root, and what the
    runs above the block hold besides its own ancestors, lowest first.
    ``rows``: tree, block, hash, and ``blocks``, the tree's number of blocks."""
    most = rows.agg(F.max("blocks")).first()[0] or 0
    rows = rows.withColumn("path", F.expr(NO_PATH))
    width = 1
    while width < most:
        rows = rows.withColumns({"node": F.expr(f"block div {width}"), "low": F.expr(f"block % {width}"), "last": F.expr(f"(blocks - 1) div {width}")})
        # The last subtree may lack blocks: those it has also serve the places of the others.
        slots = F.when((F.col("blocks") > width) & (F.col("node") == F.col("last")) & (F.col("last") % fanout > 0),
                       F.sequence(F.col("low"), F.lit(width - 1).cast("long"), F.col("blocks") - F.col("last") * width)).otherwise(F.array("low"))
        swap = Window.partitionBy("tree", F.expr(f"node div {fanout}"), "slot")
        rows = rows.withColumn("slot", F.explode(slots)).withColumn("run", F.array_sort(F.collect_list(F.struct("node", "hash")).over(swap))).where("slot = low")
        more = F.col("blocks") > width
        hashes, at = F.col("run.hash"), (F.col("node") % fanout).cast("int")
        rows = rows.select("tree", "block", "blocks", F.when(more, F.sha2(joined(hashes), 256)).otherwise(F.col("hash")).alias("hash"),
                           F.when(more, F.concat("path", F.array(step(hashes, at, fanout)))).otherwise(F.col("path")).alias("path"))
        width *= fanout
    return rows.select("tree", "block", "hash", "path")


def grown(leaves: DataFrame, order: Sequence[str], fanout: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """The trees' blocks, as a stored table, and the blocks' roots and upper paths."""
    below = common.stored(blocks(numbered(leaves, order), fanout, levels), "merkle-blocks")
    upper = butterfly(below.select("tree", "block", "hash", F.ceil(F.col("n") / fanout ** levels).alias("blocks")), fanout)
    return below, upper


def items(below: DataFrame, upper: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(tree, pos, leaf, item, path and the other columns of ``upper``) of every leaf."""
    kept = [c for c in upper.columns if c not in ("tree", "block", "path")]
    rows = below.drop("hash").join(upper, ["tree", "block"])
    for level in reversed(range(levels)):
        rows = rows.select("tree", "n", *kept, "path", F.col("below.hash").alias("hashes"), F.posexplode("below").alias("at", "kid"))
        path = F.when(F.col("n") > fanout ** level, F.concat(F.array(step(F.col("hashes"), F.col("at"), fanout)), F.col("path"))).otherwise(F.col("path"))
        rows = rows.select("tree", "n", *kept, path.alias("path"), F.col("kid.pos").alias("pos"), F.col("kid.hash").alias("leaf"), F.col("kid.below").alias("below"))
    return rows.withColumnRenamed("below", "item").drop("n")


def manifest(leaves: DataFrame, group_col: str = "source", id_col: str = "doc_id", leaf_col: str = "leaf", fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """One row for each of ``leaves``: its group, id, place ``pos`` in the group,
    ``leaf``, ``path`` (an array from the bottom up of the siblings before and
    after the node, as joined hex), ``subroot``, ``root``, and ``carried``, the
    other columns as a struct."""
    others = [c for c in leaves.columns if c not in (group_col, id_col, leaf_col)]
    item = F.struct(F.col(id_col).alias("id"), F.col("uid"), F.struct(*[F.col(f"`{c}`") for c in others] or [F.lit(None).alias("none")]).alias("carried"))
    # The number tells repeated rows apart; stored, it does not change.
    rows = common.stored(leaves.withColumn("uid", F.monotonically_increasing_id()).select(tree_of(F.col(group_col)).alias("tree"), F.col(leaf_col).alias("hash"), item.alias("item")), "merkle-leaves")
    below, upper = grown(rows, ["item.id", "hash", "item.uid"], fanout, levels)
    upper = common.stored(upper.withColumnRenamed("hash", "subroot"), "merkle-upper")
    tops = upper.where("block = 0").select(F.lit("").alias("tree"), F.col("subroot").alias("hash"), F.struct(F.col("tree").alias("id")).alias("item"))
    top_below, top_upper = grown(tops, ["item.id"], fanout, levels)
    top = items(top_below, top_upper.withColumnRenamed("hash", "root"), fanout, levels).select(F.col("item.id").alias("tree"), "root", F.col("path").alias("top"))
    upper = upper.join(top, "tree").select("tree", "block", "subroot", "root", F.concat("path", "top").alias("path"))
    group = F.when(F.col("tree") == "", F.lit(None)).otherwise(F.expr("substring(tree, 2)"))
    return items(below, upper, fanout, levels).select(group.alias("group"), F.col("item.id").alias("id"), "pos", "leaf", "path", "subroot", "root", F.col("item.carried").alias("carried"))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def siblings(path: Column) -> Column:
    return joined(F.flatten(F.transform(path, lambda s: F.array(s["before"], s["after"]))))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op11: every document's proof, and whether a copy with lower-case text still fits it."""
    docs = common.table(spark, sf_dir, "documents")
    lower = F.translate("text", UPPER, LOWER)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, leaf([lower if c == "text" else F.col(c) for c in COLUMNS]))
    rows = manifest(docs.select("doc_id", "source", leaf([F.col(c) for c in COLUMNS]).alias("leaf"), tampered.alias("tampered")))
    rows = rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
                       folded(F.coalesce("carried.tampered", "leaf"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def _tree_sql(name: str, leaves: str) -> str:
    """CTEs ``<name>_nodes`` and ``<name>_proof`` (tree, pos, siblings, folded) of
    the trees in ``leaves`` (tree, pos, n, leaf, started)."""
    return f"""
    {name}_nodes AS (
        SELECT tree, 0 AS level, n, pos, leaf AS node FROM {leaves}
        UNION ALL
        SELECT tree, any_value(level) + 1, any_value(n + 15) // 16, pos // 16, sha256(string_agg(node, '' ORDER BY pos)) FROM {name}_nodes WHERE n > 1 GROUP BY tree, pos // 16),
    {name}_runs AS (SELECT tree, level, pos // 16 AS run, list(node ORDER BY pos) AS nodes FROM {name}_nodes WHERE n > 1 GROUP BY ALL),
    {name}_climb AS (
        SELECT tree, pos, 0 AS level, n AS left_over, pos AS at, '' AS siblings, started AS folded FROM {leaves}
        UNION ALL
        SELECT c.tree, c.pos, c.level + 1, (c.left_over + 15) // 16, c.at // 16,
               c.siblings || array_to_string(r.nodes[:c.at % 16], '') || array_to_string(r.nodes[c.at % 16 + 2:], ''),
               sha256(array_to_string(r.nodes[:c.at % 16], '') || c.folded || array_to_string(r.nodes[c.at % 16 + 2:], ''))
        FROM {name}_climb c JOIN {name}_runs r ON r.tree = c.tree AND r.level = c.level AND r.run = c.at // 16),
    {name}_proof AS (SELECT tree, pos, siblings, folded FROM {name}_climb WHERE left_over = 1)"""


def _leaf_sql(text: str) -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR END" for c in (*COLUMNS[:-1], text)]
    return f"sha256({' || '.join(parts)})"


#: CRC-32 bit by bit; everything else as the definition says it, level by level.
SQL = f"""
WITH RECURSIVE hashed AS (
        SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS tree, {_leaf_sql('text')} AS leaf, {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} AS lowered,
               xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                   lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) AS crc
        FROM documents),
    leaves AS (SELECT *, CASE WHEN crc % 5 = 0 THEN lowered ELSE leaf END AS started, count(*) OVER (PARTITION BY tree) AS n,
                      row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed),
    {_tree_sql('low', 'leaves')},
    subroots AS (SELECT DISTINCT tree AS source_key, node AS leaf FROM low_nodes WHERE n = 1),
    tops AS (SELECT source_key, '' AS tree, leaf, leaf AS started, count(*) OVER () AS n, row_number() OVER (ORDER BY source_key) - 1 AS pos FROM subroots),
    {_tree_sql('top', 'tops')},
    -- The upper climb of a document starts at what its own one gave.
    begun AS (SELECT l.doc_id, l.leaf, s.leaf AS subroot, p.siblings AS low_siblings, s.source_key, l.tree, l.pos AS low_pos, s.pos, s.n, p.folded AS started
              FROM leaves l JOIN low_proof p ON p.tree = l.tree AND p.pos = l.pos JOIN tops s ON s.source_key = l.tree),
    ended AS (
        SELECT tree, low_pos, 0 AS level, n AS left_over, pos AS at, started AS folded FROM begun
        UNION ALL
        SELECT e.tree, e.low_pos, e.level + 1, (e.left_over + 15) // 16, e.at // 16, sha256(array_to_string(r.nodes[:e.at % 16], '') || e.folded || array_to_string(r.nodes[e.at % 16 + 2:], ''))
        FROM ended e JOIN top_runs r ON r.level = e.level AND r.run = e.at // 16),
    root AS (SELECT any_value(node) AS root FROM top_nodes WHERE n = 1)
SELECT b.doc_id, b.leaf, b.subroot, root.root, sha256(b.low_siblings || t.siblings) AS proof_sha256, e.folded AS folded_root, e.folded = root.root AS verified
FROM begun b JOIN ended e ON e.tree = b.tree AND e.low_pos = b.low_pos AND e.left_over = 1 JOIN top_proof t ON t.pos = b.pos CROSS JOIN root
"""
