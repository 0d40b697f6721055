"""Shards by a weighted hash tree."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievegate.llm.shared import slice_bits, stored, sums_before

SHARDS = 8
#: Shards of a rack, racks of a region.
RACK_SHARDS, REGION_RACKS = 2, 2


@dataclass(frozen=True)
class Node:
    """A shard (no children) or a group of nodes; a group weighs what its children weigh."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def shard_tree(shards: int, base: int = SHARDS) -> Node:
    """Regions of racks of equal shards.

    The first ``base`` shards fill racks and regions in order. Each further shard is a region of
    its own, so that growing the tree by one shard changes no weight inside the other regions.
    """
    leaves = [Node(f"shard-{i}", shard=i) for i in range(shards)]
    racks = [
        Node(f"rack-{i}", tuple(leaves[i : min(i + RACK_SHARDS, base)]))
        for i in range(0, min(shards, base), RACK_SHARDS)
    ]
    regions = [Node(f"region-{i}", tuple(racks[i : i + REGION_RACKS])) for i in range(0, len(racks), REGION_RACKS)]
    regions += [Node(f"region-of-{leaf.shard}", (Node(f"rack-of-{leaf.shard}", (leaf,)),)) for leaf in leaves[base:]]
    return Node("root", tuple(regions))


def shard_of(node: Node, key: Column) -> Column:
    """Descends from the root: at each level the child with the smallest weighted draw.

    A draw is ``-ln(u) / weight`` with u from a hash of key and child name. When weights change in
    one subtree, draws elsewhere stay, so keys move into or out of that subtree only.
    """
    if node.shard is not None:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return shard_of(node.children[0], key)
    draws = []
    for number, child in enumerate(node.children):
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(child.name)), 11)
        uniform = (bits.cast("double") + 0.5) / float(1 << 53)
        draws.append(F.struct((-F.log(uniform) / child.weight).alias("draw"), F.lit(number).alias("child")))
    winner = F.array_min(F.array(*draws))["child"]
    places = [shard_of(child, key) for child in node.children]
    return F.element_at(F.array(*places), winner + 1)


def assign_shards(
    docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Shard and slot of every document, and its shard in a tree with one more shard.

    The law is ``key``: the id and the number of shards decide; one more shard takes rows only into
    itself. Slots count a shard's rows from 0 without gaps, in order of a hash of the id; they come
    from prefix sums over slices of that order, so no task holds a shard.

    A null text has no bytes and the checksum 0; rows with the same id share a shard and have
    slots of their own; null ids share one shard. An empty table gives no rows. Other columns are
    ignored.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    doc_id = F.col(id_column).cast("long")
    rows = stored(
        docs.select(
            doc_id.alias("doc_id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            shard_of(shard_tree(shards), doc_id).alias("shard"),
            shard_of(shard_tree(shards + 1, shards), doc_id).alias("grown_shard"),
        ),
        "shards",
    )
    bits = slice_bits(rows.count())
    key = F.xxhash64("doc_id", "text_crc32", F.lit("slot"))
    piece = F.shiftrightunsigned(F.shiftrightunsigned(F.col("key"), 1), 63 - bits)
    keyed = rows.withColumn("key", key).withColumn("piece", piece).withColumn("one", F.lit(1))
    order = ["key", "doc_id", "size", "text_crc32"]
    return sums_before(keyed, "shard", "piece", order, "one", "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        "grown_shard",
    )
