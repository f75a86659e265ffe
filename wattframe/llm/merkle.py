"""Merkle manifest of a table: leaves, proofs and the check of every row, by cogrouped superblocks.

Every row is a leaf. The leaves of one language, ascending by doc_id, are the lowest level of a
tree of pairs; the trees' roots, ordered by language, are the lowest level of one more tree. A
superblock is the part of a tree above ``2**BLOCK_LEVELS`` consecutive nodes. Upwards, each
superblock is reduced to its top node, round by round, until one node is left. Downwards, the
nodes of a superblock are cogrouped with the one row of outer nodes that lead from its top to
the root; the function finishes the reduction inside the block, joins inner and outer siblings
to every node's proof and folds them to the root. No tree, level or proof list is ever in one
place: a group has at most ``2**BLOCK_LEVELS`` rows, whatever the share of one language.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.common import written

#: Levels of a superblock: 256 leaves.
BLOCK_LEVELS = 8
#: What takes part in a leaf, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Of 1 in so many documents (by crc32 of the id) the check gets a changed leaf.
TAMPER_MOD = 7

_PATHS = "tree string, pos long, path string"


def field(column):
    """Column: ``-`` for null, else the value's UTF-8 byte count, ``:`` and the value."""
    value = column.cast("string")
    return F.when(column.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_hash(columns):
    return F.sha2(F.encode(F.concat(*[field(c) for c in columns]), "UTF-8"), 256)


def node_hash(text: str) -> str:
    return sha256(text.encode("ascii")).hexdigest()


def numbered(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``pos`` (from 0, ascending by ``order``) and ``height`` (levels) per ``group``.

    Rows are dealt by ranges of (group, order), so that a group with most of the rows lies in
    many tasks; a row's place in its task is added to what earlier tasks hold of its group.
    """
    ranges = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    rows = written(ranges.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)
    held = rows.groupBy(F.col(group), part.alias("part")).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    offsets = held.selectExpr(
        f"{group} as of_group", "part as of_part", "first",
        f"sum(n) over (partition by {group} order by part rows between unbounded preceding and current row) - n as before",
        f"sum(n) over (partition by {group}) as n")
    joined = rows.join(offsets, (F.col(group) == F.col("of_group")) & (part == F.col("of_part")))
    height = F.length(F.regexp_replace(F.bin(F.col("n") - 1), "^0$", ""))
    return joined.select(*df.columns, (F.col("before") + F.col("at") - F.col("first")).alias("pos"),
                         height.cast("int").alias("height"))


def levels(nodes: list[str], height: int) -> list[list[str]]:
    """``nodes`` and the levels above them, ``height`` of them; a last one without partner goes up alone."""
    out = [nodes]
    for _ in range(height):
        below = out[-1]
        out.append([node_hash("".join(below[i:i + 2])) for i in range(0, len(below), 2)])
    return out


def inner_path(tree: list[list[str]], i: int) -> list[str]:
    """Siblings of node ``i`` level by level: ``L`` or ``R`` (its side) and the node, ``-`` if there is none."""
    path = []
    for level in tree[:-1]:
        j = i ^ 1
        path.append(("L" if j < i else "R") + level[j] if j < len(level) else "-")
        i >>= 1
    return path


def folded(node: str, path: list[str]) -> str:
    for step in path:
        node = node_hash(node if step == "-" else step[1:] + node if step[0] == "L" else node + step[1:])
    return node


def _with_block(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("pos", BLOCK_LEVELS))


def rounds(nodes: DataFrame) -> list[DataFrame]:
    """[(tree, pos, node, height)] from the lowest nodes up to one node per tree."""
    def up(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("pos")
        height = int(g["height"].iloc[0])
        top = levels(g["node"].tolist(), min(height, BLOCK_LEVELS))[-1]
        return pd.DataFrame({"tree": g["tree"].iloc[:1], "pos": g["block"].iloc[:1], "node": top,
                             "height": [max(height - BLOCK_LEVELS, 0)]})

    out = [nodes]
    most = nodes.agg(F.max("height")).first()[0]
    for k in range(-(-most // BLOCK_LEVELS)):
        blocks = _with_block(out[-1]).select("tree", "block", "pos", "node", "height").groupBy("tree", "block")
        out.append(written(blocks.applyInPandas(up, "tree string, pos long, node string, height int"), f"merkle-up-{k}"))
    return out


def paths_down(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """(tree, pos, path) of ``nodes`` from the paths (tree, pos = superblock, path) of their superblocks' tops."""
    def down(g: pd.DataFrame, o: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("pos")
        inner = levels(g["node"].tolist(), min(int(g["height"].iloc[0]), BLOCK_LEVELS))
        rest = [x for x in o["path"].iloc[0].split(",") if x]
        return pd.DataFrame({"tree": g["tree"], "pos": g["pos"],
                             "path": [",".join(inner_path(inner, i) + rest) for i in range(len(g))]})

    left = _with_block(nodes).select("tree", "block", "pos", "node", "height").groupBy("tree", "block")
    right = outer.select("tree", F.col("pos").alias("block"), "path").groupBy("tree", "block")
    return left.cogroup(right).applyInPandas(down, _PATHS)


def _all_paths(tops: list[DataFrame], outer: DataFrame, name: str) -> DataFrame:
    """Paths of the nodes of ``tops[0]``'s superblocks, given those of the trees' roots."""
    for k, nodes in reversed(list(enumerate(tops[1:-1]))):
        outer = written(paths_down(nodes, outer), f"{name}-{k}")
    return outer


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, proof and check of every row of ``docs`` (doc_id, source, lang, n_chars, text).

    Returns doc_id, leaf, subroot (of its language's tree), root, proof_sha256 (SHA-256 of the
    siblings on the way to the root, of the empty text where there are none), folded_root (from
    the leaf, changed by adding 1 to n_chars where 7 divides crc32 of the id and n_chars is not
    null, and the siblings of the unchanged table) and verified (folded_root equals root).

    One row is returned for each row of ``docs``. Any column may be null: the leaf holds ``-``
    for it, a null language is the first tree, a null doc_id comes first in its tree and is never
    changed. Rows with the same doc_id are ordered by their leaf; repeated rows have equal leaves,
    so their order does not matter. Empty and very long texts are hashed whole where they are
    read and never shuffled. Other columns are ignored, whatever their names. An empty table
    gives no rows.
    """
    changed = (F.crc32(F.col("doc_id").cast("string")) % TAMPER_MOD == 0) & F.col("n_chars").isNotNull()
    fields = [F.col(c) for c in LEAF_COLUMNS]
    with_one = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in LEAF_COLUMNS]
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("+"), F.col("lang").cast("string")), F.lit("")).alias("tree"), F.col("doc_id"),
        leaf_hash(fields).alias("node"), F.when(changed, leaf_hash(with_one)).otherwise(F.lit("")).alias("changed"),
        F.monotonically_increasing_id().alias("row"))
    leaves = written(numbered(written(leaves, "leaves"), "tree", ["doc_id", "node", "row"], "leaves-ordered"), "leaves-numbered")
    kind = docs.schema["doc_id"].dataType
    result = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if not leaves.head(1):
        empty = docs.sparkSession.createDataFrame([], result)
        return empty.withColumn("doc_id", F.col("doc_id").cast(kind))

    low = rounds(leaves.select("tree", "pos", "node", "height"))
    subroots = low[-1].select(F.lit("").alias("all"), F.col("tree").alias("of"), F.col("node"))
    subroots = written(numbered(subroots, "all", ["of"], "subroots-ordered"), "subroots")
    high = rounds(subroots.select(F.col("all").alias("tree"), "pos", "node", "height"))
    root = high[-1].first()["node"]

    top = docs.sparkSession.createDataFrame([("", 0, "")], _PATHS)
    if len(high) > 1:
        top = written(paths_down(high[0], _all_paths(high, top, "merkle-top")), "merkle-top")
    of_trees = subroots.join(top.select(F.col("pos").alias("of_pos"), "path"), F.col("pos") == F.col("of_pos")).select(
        F.col("of").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", F.col("node").alias("subroot"))
    of_trees = written(of_trees, "merkle-trees")
    outer = _all_paths(low, of_trees.select("tree", "pos", "path"), "merkle-down") if len(low) > 1 else of_trees
    outer = outer.select("tree", "pos", "path").join(
        of_trees.select(F.col("tree").alias("of"), "subroot"), F.col("tree") == F.col("of"))

    def prove(g: pd.DataFrame, o: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("pos")
        nodes = g["node"].tolist()
        inner = levels(nodes, min(int(g["height"].iloc[0]), BLOCK_LEVELS))
        rest = [x for x in o["path"].iloc[0].split(",") if x]
        proofs, ends = [], []
        for i, (node, other) in enumerate(zip(nodes, g["changed"])):
            path = inner_path(inner, i) + rest
            proofs.append(node_hash("".join(x[1:] for x in path)))
            ends.append(folded(other or node, path))
        return pd.DataFrame({"doc_id": g["doc_id"], "leaf": nodes, "subroot": o["subroot"].iloc[0], "root": root,
                             "proof_sha256": proofs, "folded_root": ends, "verified": [x == root for x in ends]})

    left = _with_block(leaves.withColumn("doc_id", F.col("doc_id").cast("string"))).select(
        "tree", "block", "pos", "doc_id", "node", "changed", "height").groupBy("tree", "block")
    right = outer.select("tree", F.col("pos").alias("block"), "path", "subroot").groupBy("tree", "block")
    return left.cogroup(right).applyInPandas(prove, result).withColumn("doc_id", F.col("doc_id").cast(kind))
