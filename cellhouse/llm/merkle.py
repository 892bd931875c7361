"""Merkle manifest of a dataset: a persistent tree whose tampered leaves are
versions made by path copying.

Tree: a row's leaf is H (lowercase hex SHA-256) of its columns.  Within a group
(a language) leaves ascend by id, and each run of ``FAN`` consecutive nodes becomes
their H until one is left, the group's subroot; the subroots, by group, go on
likewise to the root.

Persistence: a tampered leaf makes a version of the tree that shares every node
it does not touch.  In an aligned block of ``FAN ** DEPTH`` leaves only the leaf's
ancestors are copied (``Block.copy``); the version then goes on above the block, where
it copies one node a level, with the siblings that the block's path names.

Plan: rows are range-partitioned by (group, id) and numbered by partition counts,
so a group that holds most rows spreads over many tasks.  Up: each aligned block
gives its top node; tops are blocks again, log(rows) / log(FAN ** DEPTH) rounds, each
``FAN ** DEPTH`` times smaller.  Down: a block with the path of its top (siblings of
each level up to the root) gives its nodes theirs, and the leaves their proofs and
versions.  A task holds one block and one path; the path is joined once a block.
Only the largest group's row count passes the driver.

Defined results: a null column counts as ``-``; a null group is a group of its own,
the first; null ids come first in their group and are never tampered; rows of equal
id follow by leaf (equal rows are interchangeable); an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stored

FAN, DEPTH = 8, 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


class Block:
    """The nodes of an aligned block; ``n`` nodes of its lowest level are in the
    whole group, ``depth`` levels at most lie above it in the block."""

    def __init__(self, nodes: list[str], n: int, depth: int = DEPTH):
        self.levels = [nodes]
        while n > 1 and len(self.levels) <= depth:
            below = self.levels[-1]
            self.levels.append([digest("".join(below[i:i + FAN])) for i in range(0, len(below), FAN)])
            n = -(-n // FAN)

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def siblings(self, i: int) -> tuple[list[str], list[str]]:
        """Siblings before and after node ``i`` and its ancestors, by level."""
        before, after = [], []
        for nodes in self.levels[:-1]:
            first = i - i % FAN
            before.append("".join(nodes[first:i]))
            after.append("".join(nodes[i + 1:first + FAN]))
            i //= FAN
        return before, after


def copied(node: str, before: list[str], after: list[str]) -> list[str]:
    """The nodes that a version copies when ``node`` takes a leaf's place: the
    leaf and one ancestor a level, the version's root last."""
    out = [node]
    for a, b in zip(before, after):
        out.append(digest(a + out[-1] + b))
    return out


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` (stored) with ``idx``, the place in its group in ``order`` (from 0),
    and ``n``, the group's rows.  No group is in one task."""
    rows = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    rows = stored(rows.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()),
                  "numbered")
    runs = rows.groupBy(group, "_part").agg(F.count("*").alias("_size"), F.min("_at").alias("_first"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0))).withColumn(
        "n", F.sum("_size").over(Window.partitionBy(group))).drop("_size")
    return rows.join(runs, [group, "_part"]).withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before")).drop(
        "_part", "_at", "_first", "_before")


def _blocks_up(nodes: DataFrame, depth: int) -> DataFrame:
    """The top of each block: nodes of the next round."""
    size = FAN ** depth

    def tops(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        n = table.column("n")[0].as_py()
        top = Block(table.column("digest").to_pylist(), n, depth).top
        return pa.table({"key": table.column("key")[:1], "idx": pa.array([table.column("idx")[0].as_py() // size]),
                         "n": pa.array([-(-n // size)]), "digest": [top]})

    at = nodes.select("key", "idx", "n", "digest", F.floor(F.col("idx") / size).alias("block"))
    return at.groupBy("key", "block").applyInArrow(tops, "key string, idx long, n long, digest string")


def rounds_up(nodes: DataFrame, depth: int) -> list[DataFrame]:
    """``key, idx, n, digest`` of each round, up to one node a key."""
    out = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        out.append(stored(_blocks_up(out[-1], depth), "tops"))
        most = -(-most // FAN ** depth)
    return out


_PATH = "key string, idx long, before array<string>, after array<string>, subroot string, root string"


def _paths_down(nodes: DataFrame, paths: DataFrame, depth: int) -> DataFrame:
    """Paths of the nodes from the paths of their blocks' tops."""

    def down(nodes: pa.Table, path: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("idx")
        block = Block(nodes.column("digest").to_pylist(), nodes.column("n")[0].as_py(), depth)
        above = path.slice(0, 1).to_pylist()[0]
        mine = [block.siblings(i) for i in range(len(nodes))]
        return pa.table({
            "key": nodes.column("key"), "idx": nodes.column("idx"),
            "before": pa.array([b + above["p_before"] for b, _ in mine], pa.list_(pa.string())),
            "after": pa.array([a + above["p_after"] for _, a in mine], pa.list_(pa.string())),
            "subroot": [above["p_subroot"]] * len(nodes), "root": [above["p_root"]] * len(nodes)})

    return _with_paths(nodes, paths, depth).applyInArrow(down, _PATH)


def _with_paths(nodes: DataFrame, paths: DataFrame, depth: int):
    at = nodes.withColumn("block", F.floor(F.col("idx") / FAN ** depth))
    names = paths.select(*(F.col(c).alias(f"p_{c}") for c in paths.columns))
    return at.groupBy("key", "block").cogroup(names.groupBy("p_key", "p_idx"))


def leaves(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text",
           columns: tuple = COLUMNS) -> DataFrame:
    """``key, id, digest, tampered``: each row's leaf, and its leaf with the text's
    A-Z lower-cased where 3 divides the id's crc32 (else null)."""
    def put(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))

    def leaf(text: Column) -> Column:
        return F.sha2(F.concat(*(put(text if c == text_col else F.col(f"`{c}`")) for c in columns)), 256)

    text, group, row_id = F.col(f"`{text_col}`"), F.col(f"`{group_col}`").cast("string"), F.col(f"`{id_col}`")
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(row_id.cast("string").cast("binary")) % 3 == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("key"), row_id.cast("long").alias("id"),
        leaf(text).alias("digest"), F.when(hit, leaf(low)).alias("tampered"))


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text",
             columns: tuple = COLUMNS, with_nodes: bool = True, depth: int = DEPTH) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified`` and, ``with_nodes``, ``proof`` (siblings by level, lowest
    first) and ``version`` (the nodes that the row's tampering copies, leaf to root;
    null if untampered)."""
    spark = docs.sparkSession
    prepare(spark)
    rows = stored(numbered(leaves(docs, id_col, group_col, text_col, columns), "key", "id", "digest"), "leaves")
    lower = rounds_up(rows, depth)
    subroots = lower[-1].select(F.lit("").alias("key"), F.col("key").alias("group"), "digest")
    upper = rounds_up(stored(numbered(subroots, "key", "group"), "subroots"), depth)
    none = F.array().cast("array<string>")
    paths = upper[-1].select("key", "idx", none.alias("before"), none.alias("after"),
                             F.lit("").alias("subroot"), F.col("digest").alias("root"))
    for nodes in reversed(upper[:-1]):
        paths = stored(_paths_down(nodes.select("key", "idx", "n", "digest"), paths, depth), "paths")
    paths = paths.drop("key", "subroot").join(upper[0].select("idx", F.col("group").alias("key"),
                                                              F.col("digest").alias("subroot")), "idx")
    paths = paths.select("key", F.lit(0).cast("long").alias("idx"), "before", "after", "subroot", "root")
    for nodes in reversed(lower[1:-1]):
        paths = stored(_paths_down(nodes, paths, depth), "paths")
    if len(lower) == 1:  # no group has two rows: a leaf is its block's top
        lower.append(None)

    def prove(nodes: pa.Table, path: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("idx")
        leaf, tampered = nodes.column("digest").to_pylist(), nodes.column("tampered").to_pylist()
        block = Block(leaf, nodes.column("n")[0].as_py(), depth)
        above = path.slice(0, 1).to_pylist()[0]
        high = above["p_before"], above["p_after"]
        same = copied(block.top, *high)[-1]  # what every untampered leaf folds to
        proofs, roots, versions = [], [], []
        for i, t in enumerate(tampered):
            before, after = block.siblings(i)
            proofs.append([a + b for a, b in zip(before + high[0], after + high[1])])
            versions.append(None if t is None else copied(t, before + high[0], after + high[1]))
            roots.append(same if t is None else versions[-1][-1])
        root = above["p_root"]
        out = pa.table({
            "doc_id": nodes.column("id"), "leaf": leaf, "subroot": [above["p_subroot"]] * len(leaf),
            "root": [root] * len(leaf), "proof_sha256": [digest("".join(p)) for p in proofs], "folded_root": roots,
            "verified": [r == root for r in roots]})
        if with_nodes:
            out = out.append_column("proof", pa.array(proofs, strings)).append_column(
                "version", pa.array(versions, strings))
        return out

    strings = pa.list_(pa.string())
    return _with_paths(rows, paths, depth).applyInArrow(
        prove, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
               "verified boolean" + (", proof array<string>, version array<string>" if with_nodes else ""))
