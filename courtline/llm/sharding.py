"""Sharding by a weighted hash tree: regions, racks, shards.

A document descends the tree.  At every node each child draws an exponential
time from a hash of the document's key and the child's name, divided by the
child's weight, and the earliest wins; so a child is chosen in proportion to
its weight, whatever its siblings.  When one child's weight changes, only keys
that enter or leave that child move, so movement stays inside the subtrees
whose weights change.  All of it is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import running, spread_of, stored


@dataclass(frozen=True)
class Node:
    """A region, rack or shard; ``shard`` is set on leaves only."""
    name: str
    weight: float = 1.0
    children: tuple["Node", ...] = ()
    shard: int | None = None

    @property
    def total(self) -> float:
        return sum(c.total for c in self.children) if self.children else self.weight

    @property
    def leaves(self) -> list["Node"]:
        return [x for c in self.children for x in c.leaves] if self.children else [self]


def _region(name: str, shards: list[int], per_rack: int) -> Node:
    racks = [shards[i:i + per_rack] for i in range(0, len(shards), per_rack)]
    return Node(name, children=tuple(
        Node(f"{name}/k{i}", children=tuple(Node(f"s{s}", shard=s) for s in rack)) for i, rack in enumerate(racks)))


def tree(shards: int, per_rack: int = 4, racks: int = 2) -> Node:
    """``shards`` equal shards, filled up rack by rack and region by region."""
    size = per_rack * racks
    return Node("root", children=tuple(
        _region(f"r{i}", list(range(lo, min(shards, lo + size))), per_rack) for i, lo in enumerate(range(0, shards, size))))


def grown(root: Node, weight: float = 1.0) -> Node:
    """One more shard, in a region of its own: no other subtree's weight changes, so rows move only into it."""
    shard = max(x.shard for x in root.leaves) + 1
    region = Node(f"g{shard}", children=(Node(f"g{shard}/k0", children=(Node(f"s{shard}", weight, shard=shard),)),))
    return Node(root.name, children=(*root.children, region))


def _draw(key: Column, node: Node) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(node.name)), 11).cast("double")
    return -F.log((bits + 0.5) * F.lit(2.0 ** -53)) / F.lit(float(node.total))


def shard_of(key: Column, node: Node) -> Column:
    """The shard that ``key`` (a string column, null for none) descends to."""
    live = [c for c in node.children if c.total > 0]
    if node.shard is not None:
        return F.lit(node.shard)
    if not live:
        raise ValueError(f"no shard below {node.name} has a weight")
    if len(live) == 1:
        return shard_of(key, live[0])
    best = F.array_min(F.array(*[F.struct(_draw(key, c).alias("t"), F.lit(i).alias("i")) for i, c in enumerate(live)]))["i"]
    out = F.when(best == 0, shard_of(key, live[0]))
    for i, c in enumerate(live[1:], 1):
        out = out.when(best == i, shard_of(key, c))
    return out


def shard_documents(docs: DataFrame, root: Node, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) per row.

    The law is ``key``: the key alone, as text, decides with the tree; rows
    with equal keys share a shard, and a null key is a key like any other.
    ``size`` is the text's UTF-8 bytes plus 1; a null text counts as empty,
    crc32 0.  ``slot`` numbers a shard's rows from 0 without gaps, in the order
    of a hash of key and text (equal rows in any order).  ``grown_shard`` is
    the shard after :func:`grown` adds one.  Other columns are not read; an
    empty table gives an empty result.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    src = docs.select(F.col(key).alias("id"), body.alias("text"))
    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    sized = src.select("id", (F.octet_length("text") + 1).cast("long").alias("size"), F.crc32("text").alias("text_crc32"),
                       spread_of("id", "text").alias("at"),
                       shard_of(name, root).alias("shard"), shard_of(name, grown(root)).alias("grown_shard"))
    slotted = running(stored(sized, "shards"), ["shard"], ["id", "text_crc32", "size"], F.col("at"), index="slot")
    return slotted.select(F.col("id").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
