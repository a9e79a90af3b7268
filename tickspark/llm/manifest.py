"""Merkle manifest of a dataset, kept as logs of nodes in the order of their completion.

The records of a tree are its leaves, in order. A node is complete once its last leaf is
written, so a log that appends every node at that moment is in postorder. With n leaves the
node ``index`` of level ``level`` ends at leaf i = min((index + 1) * 2 ** level, n) - 1; i leaves
and i - popcount(i) parents were complete before that leaf, and the nodes that end at it follow
it level by level, so the node's place in the log is 2 * i - popcount(i) + level. A sibling is
looked up at the place computed this way; no pointers are stored.

The leaves of a tree are cut into aligned segments of ``2 ** SEGMENT_LEVELS`` leaves. One
builder appends all nodes of a segment, which lie together in the tree's log. The segments' tops
are the leaves of the next tier, built the same way, so no task sees more than one segment.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.llm.numbering import in_order
from tickspark.session import stage

SEGMENT_LEVELS = 12
_DIGEST = 32

def digest(*parts: bytes) -> bytes:
    """SHA-256 of the hexadecimal texts of some digests, one after the other."""
    return hashlib.sha256(b"".join(p.hex().encode() for p in parts)).digest()


def height(leaves: int) -> int:
    """The level of the root of a tree of so many leaves."""
    return (leaves - 1).bit_length()


def width(level: int, leaves: int) -> int:
    """The number of nodes of a level."""
    return -(-leaves // (1 << level))


def place(level: int, index: int, leaves: int) -> int:
    """Where a node is in the log of a tree of so many leaves."""
    last = min((index + 1) << level, leaves) - 1
    return 2 * last - last.bit_count() + level


def append(leaves: list[bytes], levels: int) -> list[bytes]:
    """The nodes of a tree up to level ``levels`` in the order of their completion."""
    log: list[bytes] = []
    waiting: list[bytes] = []  # complete nodes without a parent, the larger ones first
    for count, leaf in enumerate(leaves, 1):
        node = leaf
        log.append(node)
        while count % 2 == 0:
            node = digest(waiting.pop(), node)
            log.append(node)
            count //= 2
        waiting.append(node)
    # The right edge ends with the last leaf: parents of two or of one node.
    level = (len(leaves) & -len(leaves)).bit_length() - 1
    node = waiting.pop()
    while level < levels:
        node = digest(waiting.pop(), node) if width(level, len(leaves)) % 2 == 0 else digest(node)
        log.append(node)
        level += 1
    return log


class Log(NamedTuple):
    """The logs of many trees.

    ``segments``: (tree, segment, n, first, nodes, top): the nodes of one aligned segment, 32
    bytes each, from place ``first`` of the log on; n is the number of leaves of the tree.
    ``upper``: (tree, place, node): the nodes above the segments and the segments' tops.
    ``roots``: (tree, n, root).
    """

    segments: DataFrame
    upper: DataFrame
    roots: DataFrame


def _leaf(columns: list[Column]) -> Column:
    """Digest of a record: ``-`` for a null, else the UTF-8 byte count, ``:`` and the value."""
    parts = []
    for column in columns:
        text = column.cast("string")
        body = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(body, F.lit("-")))
    return F.unhex(F.sha2(F.encode(F.concat(*parts), "UTF-8"), 256))


def _node(nodes: bytes, at: int) -> bytes:
    return nodes[at * _DIGEST : (at + 1) * _DIGEST]


def _sorted(table: pa.Table, by: str) -> pa.Table:
    return table.take(pa.array(np.argsort(table.column(by).to_numpy(), kind="stable")))


def build(leaves: DataFrame, levels: int = SEGMENT_LEVELS) -> Log:
    """Logs of trees from their leaves (tree string, i, n, node binary), i from 0 without gaps."""
    size = 1 << levels

    def write(key: tuple, table: pa.Table) -> pa.Table:
        table = _sorted(table, "i")
        leaves_, n = table.column("node").to_pylist(), table.column("n")[0].as_py()
        segment = key[1].as_py()
        nodes = append(leaves_, min(levels, height(n)))
        columns = [[key[0].as_py()], [segment], [n], [place(0, segment * size, n)], [b"".join(nodes)], [nodes[-1]]]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SEGMENT)], schema=_SEGMENT)

    grouped = leaves.select("tree", "i", "n", "node", F.shiftright("i", levels).alias("segment"))
    segments = stage(grouped.groupBy("tree", "segment").applyInArrow(write, _SEGMENT_DDL))

    roots = segments.filter(F.col("n") <= size).select("tree", "n", F.col("top").alias("root"))
    tops = segments.filter(F.col("n") > size).select("tree", F.col("segment").alias("i"), "n", F.col("top").alias("node"))
    base = F.lit(levels)
    upper = tops.select("tree", _place(base, F.col("i"), F.col("n")).alias("place"), "node")
    largest = segments.agg(F.max("n")).first()[0] or 0
    level = levels
    while largest > 1 << level:
        tier = stage(_tier(tops, level, levels))
        upper = upper.unionByName(tier.select("tree", "place", "node"))
        level += levels
        top = tier.filter("top")
        roots = roots.unionByName(top.filter(F.col("n") <= 1 << level).select("tree", "n", F.col("node").alias("root")))
        tops = top.filter(F.col("n") > 1 << level).select("tree", "i", "n", "node")
    return Log(segments, upper, roots)


_SEGMENT_DDL = "tree string, segment long, n long, first long, nodes binary, top binary"
_SEGMENT = pa.schema(
    [
        ("tree", pa.string()),
        ("segment", pa.int64()),
        ("n", pa.int64()),
        ("first", pa.int64()),
        ("nodes", pa.binary()),
        ("top", pa.binary()),
    ]
)


def _tier(tops: DataFrame, level: int, levels: int) -> DataFrame:
    """The nodes of the ``levels`` levels above ``level``: (tree, i, n, place, node, top)."""
    schema = pa.schema(
        [
            ("tree", pa.string()),
            ("i", pa.int64()),
            ("n", pa.int64()),
            ("place", pa.int64()),
            ("node", pa.binary()),
            ("top", pa.bool_()),
        ]
    )

    def write(key: tuple, table: pa.Table) -> pa.Table:
        table = _sorted(table, "i")
        tree, part, n = key[0].as_py(), key[1].as_py(), table.column("n")[0].as_py()
        below = table.num_rows
        up = min(levels, height(n) - level)
        nodes = append(table.column("node").to_pylist(), up)
        rows = []
        for above in range(1, up + 1):
            for index in range(width(above, below)):
                at = (part << (levels - above)) + index
                node = nodes[place(above, index, below)]
                rows.append((tree, at, n, place(level + above, at, n), node, above == up))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    grouped = tops.withColumn("part", F.shiftright("i", levels)).groupBy("tree", "part")
    return grouped.applyInArrow(write, "tree string, i long, n long, place long, node binary, top boolean")


def _place(level: Column, index: Column, leaves: Column) -> Column:
    """``place`` as an expression."""
    end = F.call_function("shiftleft", (index + 1).cast("bigint"), level.cast("int"))
    last = F.least(end, leaves) - 1
    return 2 * last - F.bit_count(last) + level


_PATH = "array<struct<left: boolean, node: binary>>"


def _above(log: Log, levels: int) -> DataFrame:
    """(tree, segment, above): the siblings on the way from each segment's top to the root, a
    null node where there is none. At most 64 entries a segment."""
    deep = log.segments.filter(F.col("n") > 1 << levels).select("tree", "segment", "n")
    top = F.length(F.bin(F.col("n") - 1))
    steps = deep.select("*", F.explode(F.sequence(F.lit(levels), top - 1)).alias("level"))
    index = F.call_function("shiftright", F.col("segment"), F.col("level") - levels)
    steps = steps.withColumn("sibling", index.bitwiseXOR(F.lit(1)))
    # The sibling exists if its first leaf does.
    there = F.call_function("shiftleft", F.col("sibling"), F.col("level")) < F.col("n")
    steps = steps.withColumn("place", F.when(there, _place(F.col("level"), F.col("sibling"), F.col("n"))))
    found = steps.join(log.upper, ["tree", "place"], "left")
    entry = F.struct("level", (F.col("sibling") % 2 == 0).alias("left"), "node")
    listed = found.groupBy("tree", "segment").agg(F.sort_array(F.collect_list(entry)).alias("above"))
    return listed.select("tree", "segment", F.transform("above", lambda e: F.struct(e["left"], e["node"])).alias("above"))


def prove(leaves: DataFrame, log: Log, levels: int = SEGMENT_LEVELS) -> DataFrame:
    """Add to the leaves (tree, i, n and any others) the column ``proof``: for every level from
    the leaf up, whether the sibling is on the left and its digest, null where there is none."""
    names = [f.name for f in leaves.schema.fields]
    kept = leaves.withColumn("segment", F.shiftright("i", levels))
    parts = log.segments.select("tree", "segment", "nodes").join(_above(log, levels), ["tree", "segment"], "left")
    parts = parts.withColumn("above", F.coalesce("above", F.array().cast(_PATH)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in leaves.schema.fields)

    def address(key: tuple, rows: pa.Table, segment: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.Table.from_arrays([*rows.select(names).columns, pa.array([], _PROOF)], names=[*names, "proof"])
        nodes, above = segment.column("nodes")[0].as_py(), segment.column("above")[0].as_py()
        n = rows.column("n")[0].as_py()
        first = key[1].as_py() << levels
        below, up = min(n - first, 1 << levels), min(levels, height(n))
        proofs = []
        for i in rows.column("i").to_pylist():
            path = []
            for level in range(up):
                sibling = ((i - first) >> level) ^ 1
                there = sibling < width(level, below)
                node = _node(nodes, place(level, sibling, below)) if there else None
                path.append({"left": sibling % 2 == 0, "node": node})
            proofs.append(path + above)
        return pa.Table.from_arrays([*rows.select(names).columns, pa.array(proofs, _PROOF)], names=[*names, "proof"])

    both = kept.groupBy("tree", "segment").cogroup(parts.groupBy("tree", "segment"))
    return both.applyInArrow(address, f"{fields}, proof {_PATH}")


_PROOF = pa.list_(pa.struct([("left", pa.bool_()), ("node", pa.binary())]))


def hexadecimal(node: Column) -> Column:
    return F.lower(F.hex(node))


def fold(leaf: Column, proof: Column) -> Column:
    """The root (hexadecimal) that a leaf (hexadecimal) and a proof lead to."""

    def up(node: Column, step: Column) -> Column:
        other = F.coalesce(hexadecimal(step["node"]), F.lit(""))
        return F.sha2(F.when(step["left"], F.concat(other, node)).otherwise(F.concat(node, other)), 256)

    return F.aggregate(proof, leaf, up)


def proof_hash(proof: Column) -> Column:
    """SHA-256 of the hexadecimal texts of a proof's siblings, from the leaf up."""
    texts = F.transform(F.filter(proof, lambda s: s["node"].isNotNull()), lambda s: hexadecimal(s["node"]))
    return F.sha2(F.array_join(texts, ""), 256)


def manifest(
    df: DataFrame,
    columns: list[str],
    key: str = "doc_id",
    tree: str = "lang",
    tampered: dict[str, Column] | None = None,
    levels: int = SEGMENT_LEVELS,
) -> DataFrame:
    """One narrow row per record: ``key``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``,
    ``folded_root``, ``verified``, ``leaf_place`` (in the log of its tree).

    A leaf digests the values of ``columns``. The leaves of each value of ``tree`` (a null is a
    value) ascend by key (null first), records of one key by their digest. The subroots, null
    first and else bytewise, are the leaves of the root. ``proof_sha256`` digests the siblings
    on the way up, ``folded_root`` is recomputed from them and the leaf of the record as it
    would be with the values ``tampered`` in place of some columns; it is ``verified`` if it
    equals the root. A null replacement leaves a value as it is.

    Null and empty values differ. Repeated rows are leaves of their own. An empty table gives
    no rows. Other columns are left aside. No task sees more than a segment of a tree.
    """
    new = tampered or {}
    true = [F.col(f"`{name}`") for name in columns]
    false = [F.coalesce(new[name].cast("string"), c.cast("string")) if name in new else c for name, c in zip(columns, true)]
    rows = df.select(
        F.when(F.col(f"`{tree}`").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(f"`{tree}`"))).alias("tree"),
        F.col(f"`{key}`").alias("key"),
        _leaf(true).alias("node"),
        _leaf(false).alias("shown"),
        F.monotonically_increasing_id().alias("tie"),
    )
    # Texts are read and digested once; numbering reads the narrow rows several times.
    rows = stage(rows.withColumn("shown", F.when(F.col("shown") != F.col("node"), F.col("shown"))))
    leaves = stage(in_order(rows, ["key", "node", "tie"]).drop("tie"))
    log = build(leaves, levels)

    # The tree of the trees: one leaf per subroot.
    heads = log.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("node"))
    heads = stage(in_order(heads, ["name"]))
    top = build(heads, levels)
    ways = prove(heads, top, levels).join(top.roots.select("tree", "root"), "tree")  # one tree, one root
    ways = stage(ways.select(F.col("name").alias("tree"), F.col("node").alias("subroot"), "root", F.col("proof").alias("way")))

    # The rest of the way is the same for all leaves of a tree: it is joined after extraction.
    proven = prove(leaves, log, levels).join(ways, "tree")
    proof = F.concat("proof", "way")
    shown = F.coalesce("shown", "node")
    out = proven.select(
        F.col("key").alias(key),
        hexadecimal(F.col("node")).alias("leaf"),
        hexadecimal(F.col("subroot")).alias("subroot"),
        hexadecimal(F.col("root")).alias("root"),
        proof_hash(proof).alias("proof_sha256"),
        fold(hexadecimal(shown), proof).alias("folded_root"),
        _place(F.lit(0), F.col("i"), F.col("n")).alias("leaf_place"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
