"""A Merkle manifest of a dataset: ternary hash trees per group of rows, under one root.

Every row is a leaf. The leaves of a group, in key order, are hashed three by three, level by
level, until one node is left; the last run of a level may hold fewer nodes, even one. The
groups' last nodes, in group order, are the leaves of the top tree, whose last node is the root.

A parent is SHA-256 of its children as hexadecimal text. While it is built it retains a copy of
the hash state before each child's slot. Folding a changed leaf resumes the state of its slot
with the replacement and the siblings on its right; what lies on the left is never hashed again.

Trees are built in subtrees of ``RUN`` neighbouring nodes (six levels), each in one task, so a
group of any size is dealt out evenly. The way from a subtree to the root is handed down from
the top, again subtree by subtree, together with the root itself; a leaf's proof and its folded
root need only its own subtree and that way. Every leaf is folded, changed or not, and what it
folds to is compared with the root that was built. Positions in a group come from a sorted range partitioning and the counts per
partition, never from one sorted group.

A missing field is written ``-``, any other one as its number of bytes, ``:`` and the value. A
missing group comes first, missing keys come first in their group, rows of equal key are
ordered by leaf. Repeated rows are leaves of their own. Other columns are not read. An
empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelweave.sources.scratch import materialize

ARITY, LEVELS = 3, 6
RUN = ARITY**LEVELS

NODE = "tree string, at long, n long, digest string"
_NODE = pa.schema([("tree", pa.string()), ("at", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
_STEPS = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
_WAY = pa.schema(
    [("tree", pa.string()), ("at", pa.int64()), ("steps", _STEPS), ("subroot", pa.string()), ("root", pa.string())]
)
WAY = "tree string, at long, steps array<struct<left: string, right: string>>, subroot string, root string"
_PROOF = pa.schema(
    [("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
     ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())]
)
PROOF = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)


def framed(value: Column) -> Column:
    """A field as a leaf holds it."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def without_line_feeds(doc_id: Column, text: Column) -> Column:
    """What the check of a manifest tampers with: texts of every other id lose their line feeds.

    A missing id counts as the empty text.
    """
    even = F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 2 == 0
    return F.when(even, F.translate(text, "\n", "")).otherwise(text)


class Tree:
    """The levels above up to ``RUN`` neighbouring leaves, with the state before every slot."""

    def __init__(self, leaves: Sequence[str], levels: int):
        self.levels = [list(leaves)]
        self.states: list[list] = []
        for _ in range(levels):
            below, parents, states = self.levels[-1], [], []
            for first in range(0, len(below), ARITY):
                state = hashlib.sha256()
                for child in below[first : first + ARITY]:
                    states.append(state.copy())
                    state.update(child.encode())
                parents.append(state.hexdigest())
            self.levels.append(parents)
            self.states.append(states)

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def siblings(self, at: int) -> list[tuple[str, str]]:
        """Left and right siblings of a leaf and of its ancestors, joined, level by level."""
        found = []
        for nodes in self.levels[:-1]:
            first = at - at % ARITY
            found.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + ARITY])))
            at //= ARITY
        return found

    def fold(self, at: int, digest: str) -> str:
        """The top with the leaf replaced."""
        for nodes, states in zip(self.levels, self.states, strict=False):
            state = states[at].copy()
            state.update(digest.encode())
            for sibling in nodes[at + 1 : at - at % ARITY + ARITY]:
                state.update(sibling.encode())
            digest = state.hexdigest()
            at //= ARITY
        return digest


class Way:
    """The way from a subtree's top to the root: resumable states and right siblings."""

    def __init__(self, steps: Sequence[dict]):
        self.steps = [(s["left"], s["right"]) for s in steps]
        self.states = [(hashlib.sha256(left.encode()), right.encode()) for left, right in self.steps]
        self.siblings = "".join(left + right for left, right in self.steps)

    def fold(self, digest: str) -> str:
        for before, right in self.states:
            state = before.copy()
            state.update(digest.encode() + right)
            digest = state.hexdigest()
        return digest


def levels_of(n: int) -> int:
    """Levels that a subtree builds in a tree whose level has ``n`` nodes."""
    if n > RUN:
        return LEVELS
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def _subtree(table: pa.Table) -> Tree:
    """The subtree of a group's rows, which are put in order."""
    return Tree(table.column("digest").to_pylist(), levels_of(table.column("n")[0].as_py()))


def _climb(table: pa.Table) -> pa.Table:
    table = table.sort_by("at")
    tree, at, n = (table.column(c)[0].as_py() for c in ("tree", "at", "n"))
    row = {"tree": tree, "at": at // RUN, "n": -(-n // RUN), "digest": _subtree(table).top}
    return pa.Table.from_pylist([row], schema=_NODE)


def _descend(nodes: pa.Table, ways: pa.Table) -> pa.Table:
    if not nodes.num_rows:
        return _WAY.empty_table()
    nodes = nodes.sort_by("at")
    subtree = _subtree(nodes)
    above, subroot, root = (ways.column(c)[0].as_py() for c in ("steps", "subroot", "root"))
    steps = [
        [{"left": left, "right": right} for left, right in subtree.siblings(k)] + above
        for k in range(nodes.num_rows)
    ]
    return pa.table(
        [nodes.column("tree"), nodes.column("at"), pa.array(steps, _STEPS),
         pa.array([subroot] * nodes.num_rows, pa.string()), pa.array([root] * nodes.num_rows, pa.string())],
        schema=_WAY,
    )


def _prove(leaves: pa.Table, ways: pa.Table) -> pa.Table:
    if not leaves.num_rows:
        return _PROOF.empty_table()
    leaves = leaves.sort_by("at")
    subtree, way = _subtree(leaves), Way(ways.column("steps")[0].as_py())
    subroot, root = (ways.column(c)[0].as_py() for c in ("subroot", "root"))
    rows = []
    for k, r in enumerate(leaves.select(["doc_id", "digest", "altered"]).to_pylist()):
        proof = "".join(left + right for left, right in subtree.siblings(k)) + way.siblings
        folded = way.fold(subtree.fold(k, r["digest"] if r["altered"] is None else r["altered"]))
        rows.append(
            {"doc_id": r["doc_id"], "leaf": r["digest"], "subroot": subroot, "root": root,
             "proof_sha256": hashlib.sha256(proof.encode()).hexdigest(), "folded_root": folded,
             "verified": folded == root}
        )
    return pa.Table.from_pylist(rows, schema=_PROOF)


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with their place ``at`` in their tree and the number ``n`` of its rows.

    The order is that of ``tree`` and the given columns. A tree may lie in any number of range
    partitions; what is summed up is one row per tree and partition.
    """
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    dealt = materialize(
        dealt.withColumns(
            {"part": F.spark_partition_id(), "line": F.monotonically_increasing_id()}
        ),
        "ordered-leaves",
    )
    counts = dealt.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("held"), F.min("line").alias("least"))
    counts = materialize(counts, "leaf-counts")
    whole = Window.partitionBy("tree").orderBy("part")
    before = F.coalesce(F.sum("held").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    n = F.sum("held").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    starts = counts.select("tree", "part", (before - F.col("least")).alias("shift"), n.alias("n"))
    return (
        dealt.join(starts, ["tree", "part"])
        .withColumn("at", F.col("line") + F.col("shift"))
        .drop("part", "line", "shift")
    )


def _grouped(nodes: DataFrame):
    return nodes.groupBy("tree", F.expr(f"at div {RUN}").alias("subtree"))


def climb(leaves: DataFrame) -> list[DataFrame]:
    """The leaves and the nodes above each ``LEVELS`` levels, the last ones alone in their trees."""
    levels = [leaves]
    largest = leaves.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        levels.append(materialize(_grouped(levels[-1].select(*_NODE.names)).applyInArrow(_climb, NODE), "nodes"))
        largest = -(-largest // RUN)
    return levels


def descend(levels: list[DataFrame], ways: DataFrame) -> DataFrame:
    """Ways to the root of the nodes of ``levels[0]``, given those of the last level's nodes."""
    for nodes in reversed(levels[:-1]):
        above = ways.groupBy("tree", F.col("at").alias("subtree"))
        nodes = _grouped(nodes.select(*_NODE.names))
        ways = materialize(nodes.cogroup(above).applyInArrow(_descend, WAY), "ways")
    return ways


def manifest(
    docs: DataFrame, fields: Sequence[str], key: str = "doc_id", group: str = "source", tampered=without_line_feeds
) -> DataFrame:
    """Leaf, root and proof of every row, and the root that its tampered copy folds to.

    ``tampered`` makes the changed ``text`` of a row from its key and text.
    """
    def leaf(text: Column) -> Column:
        parts = [framed(text if f == "text" else F.col(f)) for f in fields]
        return F.sha2(F.concat(*parts), 256)

    changed = tampered(F.col(key), F.col("text"))
    leaves = docs.select(
        # A missing group sorts before every other one.
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"),
        F.col(key).cast("long").alias("doc_id"),
        leaf(F.col("text")).alias("digest"),
        F.when(~changed.eqNullSafe(F.col("text")), leaf(changed)).alias("altered"),
    )
    # Written, since the range partitioning reads its input twice.
    leaves = materialize(numbered(materialize(leaves, "leaves"), "doc_id", "digest"), "numbered-leaves")
    levels = climb(leaves)

    subroots = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("branch"), "digest")
    tops = materialize(numbered(subroots, "branch"), "top-leaves")
    above = climb(tops)
    last = above[-1].select(
        "tree", "at", F.expr("cast(array() AS array<struct<left: string, right: string>>)").alias("steps"),
        F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"),
    )
    ways = descend(above, last).drop("subroot")
    ways = tops.join(ways, ["tree", "at"]).select(
        F.col("branch").alias("tree"), F.lit(0).cast("long").alias("at"), "steps", F.col("digest").alias("subroot"),
        "root",
    )
    ways = descend(levels[1:], materialize(ways, "branch-ways"))
    # The subtrees of the leaves are the first nodes above them, a lone leaf is its own.
    subtrees = ways.groupBy("tree", F.col("at").alias("subtree"))
    return _grouped(leaves).cogroup(subtrees).applyInArrow(_prove, PROOF)
