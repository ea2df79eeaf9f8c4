"""Merkle manifest of a data set with a witness for each row, kept up as leaves are appended.

A tree takes leaves in order. Of two complete neighbours of the same height the parent is made at once, and the witnesses
of the leaves below get their sibling: leaves carry a partial witness as long as their subtree is open, and each sibling
that completes extends it. Leaves are numbered per group by running sums over ranges, so a group of any size is split.
Every aligned block of leaves is one append stream in one task; its root is a leaf of the next tree, appended in turn,
until a group has one root. The groups' roots are appended to the top tree. A row's witness is what its own block, its
block's block and so on gathered, put behind each other. Only digests are shuffled, never texts.

A witness has one element for each level: empty where a node has no sibling, else a byte that says on which side the
sibling stands and its 32 bytes.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import in_order, running, store

BLOCK_LEVELS = 10
ON_LEFT, ON_RIGHT, ALONE = b"L", b"R", b""


def node_digest(*children: bytes) -> bytes:
    """sha256 of the children's digests as hex text, one behind the other."""
    return sha256("".join(c.hex() for c in children).encode()).digest()


@dataclass
class Subtree:
    """A complete subtree of 2 ** height leaves, or fewer at the end of the tree."""

    height: int
    root: bytes
    leaves: range


@dataclass
class OpenTree:
    """A tree that leaves are appended to, with the witness of each leaf as far as it is known."""

    open: list[Subtree] = field(default_factory=list)
    witnesses: list[list[bytes]] = field(default_factory=list)

    def append(self, leaf: bytes) -> None:
        at = len(self.witnesses)
        self.witnesses.append([])
        self.open.append(Subtree(0, leaf, range(at, at + 1)))
        while len(self.open) > 1 and self.open[-1].height == self.open[-2].height:
            self.complete()

    def complete(self) -> None:
        """Joins the last two subtrees, which are siblings, and extends the witnesses of their leaves."""
        right, left = self.open.pop(), self.open.pop()
        for at in left.leaves:
            self.witnesses[at].append(ON_RIGHT + right.root)
        for at in right.leaves:
            self.witnesses[at].append(ON_LEFT + left.root)
        leaves = range(left.leaves.start, right.leaves.stop)
        self.open.append(Subtree(left.height + 1, node_digest(left.root, right.root), leaves))

    def close(self, levels: int | None = None) -> bytes:
        """The root once no leaf follows: after exactly ``levels`` levels, or as soon as one node remains."""
        while len(self.open) > 1 or levels is not None and self.open[0].height < levels:
            last = self.open[-1]
            if len(self.open) > 1 and self.open[-2].height == last.height:
                self.complete()
                continue
            for at in last.leaves:
                self.witnesses[at].append(ALONE)
            self.open[-1] = Subtree(last.height + 1, node_digest(last.root), last.leaves)
        return self.open[0].root


def append_blocks(nodes: DataFrame, group: list[str], levels: int) -> DataFrame:
    """Nodes (group, position, digest and what else they carry) with their block, its root and their witness within it.

    A block has 2 ** levels positions. All blocks rise by ``levels`` levels, but for the only block of a group, which
    rises until one node remains: that is block 0 with a place left.
    """
    size, kinds = 1 << levels, {f.name: f.dataType.simpleString() for f in nodes.schema}
    blocks = nodes.withColumn("block", F.expr(f"position div {size}"))
    fields = [c for c in blocks.columns if c != "digest"]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("position").combine_chunks()
        tree = OpenTree()
        for digest in table.column("digest").to_pylist():
            tree.append(digest)
        only = table.column("block")[0].as_py() == 0 and table.num_rows < size
        root = tree.close(None if only else levels)
        offsets = np.concatenate([[0], np.cumsum([len(w) for w in tree.witnesses])])
        flat = pa.array([e for w in tree.witnesses for e in w], pa.binary())
        return pa.table(
            [
                *(table.column(c) for c in fields),
                pa.array([root] * table.num_rows, pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat),
            ],
            [*fields, "root", "witness"],
        )

    schema = ", ".join([*(f"`{c}` {kinds.get(c, 'bigint')}" for c in fields), "root binary", "witness array<binary>"])
    return blocks.groupBy(*group, "block").applyInArrow(run, schema)


def grow(leaves: DataFrame, group: list[str], levels: int = BLOCK_LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """One tree for each group over its leaves (group, position from 0, digest).

    Returns the stored levels of blocks, the leaves' own first, and the groups' roots (group, position, digest).
    """
    grown = []
    while True:
        grown.append(store(append_blocks(leaves, group, levels), "merkle-blocks"))
        found = grown[-1].groupBy(*group, "block").agg(F.first("root").alias("digest"))
        leaves = store(found.withColumnRenamed("block", "position"), "merkle-roots")
        if leaves.where("position > 0").isEmpty():
            return grown, leaves


def extended(grown: list[DataFrame], group: list[str], above: DataFrame) -> DataFrame:
    """The leaves with their whole witness: from the top down each block's own is put behind those of its leaves.

    ``above`` has (group, position 0, witness) of the groups' roots and columns that go down to all leaves. The join is on
    group and block, so a large group is spread.
    """
    carried = [c for c in above.columns if c not in [*group, "position", "witness"]]
    for level in reversed(grown):
        same = F.col("block") == F.col("__position")
        for g in group:
            same = same & F.col(g).eqNullSafe(F.col(f"__{g}"))
        higher = above.select(
            *[F.col(g).alias(f"__{g}") for g in group],
            F.col("position").alias("__position"),
            F.col("witness").alias("__above"),
            *carried,
        )
        joined = level.join(higher, same).withColumn("witness", F.concat("witness", "__above"))
        above = joined.select(*[c for c in level.columns if c not in ("block", "root")], *carried)
    return above


def field_text(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """sha256 of the values' texts one behind the other, lower-case hex."""
    return F.sha2(F.concat(*[field_text(v) for v in values]), 256)


def sibling(element: Column) -> Column:
    return F.lower(F.hex(F.substring(element, 2, 32)))


def proof_digest(witness: Column) -> Column:
    """sha256 of all siblings as hex text, from leaf to root."""
    return F.sha2(F.array_join(F.transform(witness, sibling), ""), 256)


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and its witness give."""

    def up(node: Column, element: Column) -> Column:
        side = F.substring(element, 1, 1)
        text = F.when(side == F.lit(ON_LEFT), F.concat(sibling(element), node)).when(
            side == F.lit(ON_RIGHT), F.concat(node, sibling(element))
        )
        return F.sha2(F.coalesce(text, node), 256)

    return F.aggregate(witness, leaf, up)


def manifest(leaves: DataFrame, group: str, order: str, levels: int = BLOCK_LEVELS) -> tuple[DataFrame, str | None]:
    """Every leaf with its group's subroot and its witness up to the root, and the root of all as hex text.

    ``leaves`` has the columns group, order and leaf (hex text) and others that pass through; none of them may be called
    position, digest, range, before, block, root, subroot or witness or begin with ``__``. Within a group leaves ascend by ``order``, nulls first; ties
    go by leaf, so equal rows are neighbours and their order does not matter. Null is a group of its own, the first;
    text sorts by UTF-8 bytes. Repeated rows are leaves as often as they come. An empty table gives no row and a null root.
    """
    rows = leaves.withColumn("__row", F.monotonically_increasing_id()).withColumn("__one", F.lit(1).cast("long"))
    ties = [order, "leaf", "__row"]
    placed = running(in_order(rows, [group, *ties], "merkle"), [group], ties, "__one", "position")
    grown, roots = grow(placed.drop("__row", "__one").withColumn("digest", F.unhex("leaf")), [group], levels)
    tops = roots.select(group, F.col("digest"), F.lit(1).cast("long").alias("__one"))
    tops = running(in_order(tops, [group], "merkle-groups"), [], [group], "__one", "position").drop("__one")
    high, top = grow(tops.withColumn("subroot", F.lower(F.hex("digest"))), [], levels)
    first = top.first()
    end = top.select("position", F.array().cast("array<binary>").alias("witness"))
    above = extended(high, [], end).withColumn("position", F.lit(0).cast("long"))
    found = extended(grown, [group], above)
    return found.select(*leaves.columns, "subroot", "witness"), None if first is None else first["digest"].hex()
