"""Merkle manifest of a data set: a root over all rows, and for each row the proof that it belongs to it.

A leaf is the digest of a row's values. The leaves of a group (a source), in the order of their ids, make a tree whose nodes have
``ARITY`` children; the group roots, in the order of the groups, make the tree of the whole.

Witnesses are incremental. Nodes are appended in order to a tree that keeps one open subtree a level; every leaf below an
open subtree holds a partial witness, the sibling lists so far. When a run of siblings is complete, it becomes a node of the next level
and extends the witnesses below it. Trees are aligned: every ``ARITY ** DEPTH`` leaves of a group are a block that one task appends
by itself, as no run crosses its border. The roots of blocks are then appended in the same way, again in blocks, and so on until
every group has one root; then the roots of the groups likewise. What a task holds is one block, whatever the size of a group; the number of steps
is the logarithm of the largest group to the base of a block's size.

Texts never move: only ids, groups and digests are shuffled. Leaves get their places from a range sort, stored once, and the counts of its
parts. Proofs of leaves are long (up to 15 digests a level), so they are not stored: the last step appends the leaves of a block again and has
what it needs of the levels above, once a block. :func:`proofs` gives them whole.

Rules: nulls are digested as ``-``, so a null and an empty text differ. A null group is a group of its own, before all others; null ids come
first. Rows with equal ids are ordered by their leaves, equal rows have equal leaves and each its own place. A tree of one node is that node. A very long text is
digested by itself, in its own task. Other columns do not count. An empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT_SHARE, attached, stored

ARITY = 16
#: Levels of a block: 16 ** 3 = 4,096 leaves.
DEPTH = 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Sibling runs that a node has on its way up: its place in the run, and the run's digests as hex text.
_WITNESS = "array<struct<place: int, run: string>>"
_HEX = 64


def value_digest_text(column: Column) -> Column:
    """``-`` for a null, else the UTF-8 byte count, ``:`` and the value."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(columns: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the values of a row."""
    return F.sha2(F.concat(*map(value_digest_text, columns)), 256)


def combined(run: list[str]) -> str:
    """The digest over a run of siblings, as hex text."""
    return hashlib.sha256("".join(run).encode()).hexdigest()


class WitnessTree:
    """Nodes appended one after another, with a partial witness for each."""

    def __init__(self, arity: int = ARITY):
        self.arity = arity
        #: of each level: the open run of subtree roots, and the numbers of the appended nodes below it
        self.open: list[tuple[list[str], list[int]]] = [([], [])]
        #: of each appended node: its place in a run, and the run, level by level
        self.witnesses: list[list[tuple[int, list[str]]]] = []

    def append(self, digest: str) -> None:
        self.witnesses.append([])
        self._put(0, digest, [len(self.witnesses) - 1])

    def _put(self, level: int, digest: str, below: list[int]) -> None:
        if level == len(self.open):
            self.open.append(([], []))
        run, members = self.open[level]
        if len(run) == self.arity:
            # the run is complete and more nodes follow: it becomes a node of the next level
            self._close(level)
            run, members = self.open[level]
        for node in below:
            # the list itself: siblings yet to come extend this witness
            self.witnesses[node].append((len(run), run))
        run.append(digest)
        members += below

    def _close(self, level: int) -> None:
        run, members = self.open[level]
        self.open[level] = ([], [])
        self._put(level + 1, combined(run), members)

    def finish(self, depth: int | None = None) -> str:
        """Close all runs up to ``depth`` levels; without it, until one node remains, which is returned."""
        level = 0
        while True:
            run, members = self.open[level]
            last = level + 1 == len(self.open)
            if (depth is None and last and len(run) == 1) or level == depth:
                for node in members:
                    self.witnesses[node].pop()  # the root has no siblings
                return run[0]
            self._close(level)
            level += 1


def _key(group: Column) -> Column:
    """The group as a text that is never null; null sorts first."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group.cast("string")))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``place`` (from 0, in its group) and ``n`` (rows of the group), by one range sort over all groups."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, next_ = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column(batch.schema.get_field_index(group)).to_numpy(zero_copy_only=False)
            change = np.concatenate([[groups[0] != before], groups[1:] != groups[:-1]])
            starts = np.flatnonzero(change)
            own = np.arange(len(groups)) + next_
            for a, b in zip(starts, [*starts[1:], len(groups)]):
                own[a:b] = np.arange(b - a)
            before, next_ = groups[-1], int(own[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(own), part), pa.int32()), pa.array(own, pa.int64())], [*batch.schema.names, "part", "own"])

    kinds = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in rows.schema)
    ordered = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    # stored, so that a repeated task cannot number its rows in another way than those that were counted
    ordered = stored(ordered.mapInArrow(number, f"{kinds}, part int, own long"), "ordered")
    sizes = ordered.groupBy(group, "part").agg((F.max("own") + 1).alias("size"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    # a group has at most one row a part here
    sizes = sizes.select(group, "part", "size", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"), F.sum("size").over(whole).alias("n"))
    sizes = stored(sizes, "part-sizes")
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    placed = attached(ordered, sizes, [group, "part"], F.col("size") > int(total * HOT_SHARE), order)
    return placed.withColumn("place", F.col("before") + F.col("own")).drop("part", "own", "before", "size")


def _block(depth: int) -> Column:
    return F.floor(F.col("place") / ARITY**depth).cast("long")


def _tree(digests: list[str], depth: int | None) -> tuple[WitnessTree, str]:
    tree = WitnessTree()
    for digest in digests:
        tree.append(digest)
    return tree, tree.finish(depth)


def _climb(nodes: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """From ``nodes`` (tree, place, n, digest): roots (tree, digest) of all trees, and of each node its witness up to there."""
    size = ARITY**depth

    def append(group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        tree, root = _tree(group.column("digest").to_pylist(), depth if group.column("n")[0].as_py() > size else None)
        witnesses = [[{"place": place, "run": "".join(run)} for place, run in own] for own in tree.witnesses]
        kind = pa.list_(pa.struct([("place", pa.int32()), ("run", pa.string())]))
        columns = {"tree": group.column("tree"), "place": group.column("place"), "witness": pa.array(witnesses, kind)}
        return pa.table({**columns, "n": group.column("n"), "root": pa.array([root] * len(group), pa.string())})

    done = nodes.groupBy("tree", _block(depth).alias("block")).applyInArrow(append, f"tree string, place long, witness {_WITNESS}, n long, root string")
    done = stored(done, "witnesses")
    if done.filter(F.col("n") > size).isEmpty():
        return done.select("tree", F.col("root").alias("digest")).distinct(), done.select("tree", "place", "witness")
    upper = done.select("tree", _block(depth).alias("place"), F.ceil(F.col("n") / size).cast("long").alias("n"), F.col("root").alias("digest")).distinct()
    roots, above = _climb(upper, depth)
    above = above.select("tree", F.col("place").alias("block"), F.col("witness").alias("above"))
    joined = done.withColumn("block", _block(depth)).join(above, ["tree", "block"])
    return roots, joined.select("tree", "place", F.concat("witness", "above").alias("witness"))


def _leaves(docs: DataFrame, id_col: str, group_col: str, columns: list[str], text_col: str) -> DataFrame:
    """tree, id, leaf, and altered: the leaf of the row with its text in lower case, for every row whose id's crc32 is divisible by 5."""
    values = [F.col(name) for name in columns]
    lower = [F.translate(value, _UPPER, _LOWER) if name == text_col else value for name, value in zip(columns, values)]
    tampered = F.crc32(F.col(id_col).cast("string")) % 5 == 0
    return docs.select(
        _key(F.col(group_col)).alias("tree"),
        F.col(id_col).cast("long").alias("id"),
        row_digest(values).alias("leaf"),
        F.when(tampered, row_digest(lower)).alias("altered"),
    )


def _folded(digest: str, witness: list[tuple[int, str]]) -> str:
    for place, run in witness:
        at = place * _HEX
        digest = hashlib.sha256((run[:at] + digest + run[at + _HEX :]).encode()).hexdigest()
    return digest


def _siblings(witness: list[tuple[int, str]]) -> str:
    return "".join(run[: place * _HEX] + run[(place + 1) * _HEX :] for place, run in witness)


class Manifest:
    """The trees of a table: ``leaves`` (tree, id, leaf, altered, place, n), ``above`` (tree, block, witness from the block's root up to the
    root of all, subroot) and ``root``."""

    def __init__(self, leaves: DataFrame, above: DataFrame, root: str | None, depth: int):
        self.leaves, self.above, self.root, self.depth = leaves, above, root, depth


def build_manifest(docs: DataFrame, *, id_col: str = "doc_id", group_col: str = "source", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), text_col: str = "text", depth: int = DEPTH) -> Manifest:
    """Leaves of all rows, the tree of every group and the tree of the groups."""
    size = ARITY**depth
    leaves = numbered(_leaves(docs, id_col, group_col, list(columns), text_col), "tree", ["id", "leaf"])
    leaves = stored(leaves, "leaves")

    def root_of(group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        n = group.column("n")[0].as_py()
        root = _tree(group.column("leaf").to_pylist(), depth if n > size else None)[1]
        blocks = -(-n // size)
        return pa.table({"tree": group.column("tree")[:1], "place": pa.array([group.column("place")[0].as_py() // size], pa.int64()), "n": pa.array([blocks], pa.int64()), "digest": pa.array([root], pa.string())})

    blocks = leaves.select("tree", "place", "n", "leaf").groupBy("tree", _block(depth).alias("block")).applyInArrow(root_of, "tree string, place long, n long, digest string")
    blocks = stored(blocks, "block-roots")
    subroots, inner = _climb(blocks, depth)
    order = numbered(subroots.select(F.lit("").alias("group"), "tree", "digest"), "group", ["tree"])
    order = stored(order, "subroots")
    tops, outer = _climb(order.select(F.col("group").alias("tree"), "place", "n", "digest"), depth)
    names = order.select(F.col("tree").alias("name"), "place", F.col("digest").alias("subroot"))
    outer = outer.join(names, "place").select(F.col("name").alias("tree"), F.col("witness").alias("outer"), "subroot")
    above = inner.join(outer, "tree").select("tree", F.col("place").alias("block"), F.concat("witness", "outer").alias("witness"), "subroot")
    found = tops.first()
    return Manifest(leaves, stored(above, "above"), found.digest if found else None, depth)


def proofs(manifest: Manifest, *, whole: bool = False) -> DataFrame:
    """id, leaf, subroot, root, proof_sha256 (over all siblings from the leaf up), folded_root (of the altered leaf, where there is one, with
    the siblings of the original) and verified; ``whole`` adds the siblings themselves."""
    depth, root = manifest.depth, manifest.root
    size = ARITY**depth

    def prove(leaves: pa.Table, above: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("place")
        upper = [(step["place"], step["run"]) for step in above.column("witness")[0].as_py()]
        upper_siblings = _siblings(upper)
        tree, _ = _tree(leaves.column("leaf").to_pylist(), depth if leaves.column("n")[0].as_py() > size else None)
        joined: dict[int, str] = {}  # runs as text, each once
        columns: dict[str, list] = {"proof": [], "siblings": [], "folded": []}
        for own, leaf, altered in zip(tree.witnesses, leaves.column("leaf").to_pylist(), leaves.column("altered").to_pylist()):
            witness = [(place, joined.setdefault(id(run), "".join(run))) for place, run in own]
            siblings = _siblings(witness) + upper_siblings
            columns["proof"].append(hashlib.sha256(siblings.encode()).hexdigest())
            columns["folded"].append(_folded(altered or leaf, witness + upper))
            if whole:
                columns["siblings"].append(siblings)
        found = {"id": leaves.column("id"), "leaf": leaves.column("leaf"), "subroot": pa.array([above.column("subroot")[0].as_py()] * len(leaves), pa.string())}
        found |= {"proof_sha256": pa.array(columns["proof"], pa.string()), "folded_root": pa.array(columns["folded"], pa.string())}
        return pa.table(found | ({"siblings": pa.array(columns["siblings"], pa.string())} if whole else {}))

    leaves = manifest.leaves.withColumn("block", _block(depth)).groupBy("tree", "block")
    schema = "id long, leaf string, subroot string, proof_sha256 string, folded_root string" + (", siblings string" if whole else "")
    found = leaves.cogroup(manifest.above.groupBy("tree", "block")).applyInArrow(prove, schema)
    found = found.withColumns({"root": F.lit(root).cast("string"), "verified": F.col("folded_root") == F.lit(root).cast("string")})
    names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return found.select(*names, *(["siblings"] if whole else []))
