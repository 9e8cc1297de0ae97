"""Sharding by a hierarchical weighted hash tree.

A row goes down the tree region, rack, shard.  At each level every child draws
``-ln(u) / weight`` with u from a hash of the key and the child's path, and the
smallest draw wins, so a child gets rows in proportion to its weight.  A draw depends
on nothing but the key, the path and the weight: when weights change, only rows of the
subtrees whose weights change move.  A new region takes rows from all the others and
moves none between them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, write_table

SHARDS_PER_RACK = 4
RACKS_PER_REGION = 2


@dataclass(frozen=True)
class Leaf:
    """A shard's place in the tree and its weight."""
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def base_tree(n_shards: int) -> list[Leaf]:
    """Shards 0 to n - 1 of weight 1, four to a rack and two racks to a region."""
    return [Leaf(s // (SHARDS_PER_RACK * RACKS_PER_REGION), s // SHARDS_PER_RACK, s) for s in range(n_shards)]


def grown(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard.  It is a region of its own, so all rows that move go to it."""
    new = max((x.shard for x in tree), default=-1) + 1
    region = max((x.region for x in tree), default=-1) + 1
    rack = max((x.rack for x in tree), default=-1) + 1
    return [*tree, Leaf(region, rack, new, weight)]


def _children(tree: list[Leaf]) -> dict[str, dict[str, float]]:
    """Weights of each node's children by path: ``tree``, ``tree/region``, ``tree/region/rack``."""
    nodes: dict[str, dict[str, float]] = {}
    for x in tree:
        path = "tree"
        for step in (x.region, x.rack, x.shard):
            below = nodes.setdefault(path, {})
            path = f"{path}/{step}"
            below[path] = below.get(path, 0.0) + x.weight
    return nodes


def with_shard(df: DataFrame, key: str, tree: list[Leaf], name: str) -> DataFrame:
    """``df`` with the shard (int) of column ``key``: from the root, three times the child
    with the smallest draw.  The tree is a literal, a parameter of fixed size."""
    nodes = _children(tree)
    below = F.create_map(*[x for path, children in nodes.items() for x in (
        F.lit(path), F.array(*[F.struct(F.lit(c).alias("path"), F.lit(w).alias("weight")) for c, w in children.items()]))])

    def draw(child: Column) -> Column:
        # 53 bits of the hash as a number strictly between 0 and 1
        u = (F.shiftrightunsigned(F.xxhash64(F.col(key), child["path"]), 11).cast("double") + 0.5) / float(1 << 53)
        return F.struct((-F.log(u) / child["weight"]).alias("draw"), child["path"].alias("path"))
    at = fresh(df, "_node")
    df = df.withColumn(at, F.lit("tree"))
    for _ in ("region", "rack", "shard"):
        df = df.withColumn(at, F.array_min(F.transform(F.element_at(below, F.col(at)), draw))["path"])
    return df.withColumn(name, F.substring_index(at, "/", -1).cast("int")).drop(at)


def shard_rows(docs: DataFrame, tree: list[Leaf], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size (UTF-8 bytes of the text plus 8), text_crc32,
    shard, slot (0, 1, ... in each shard) and grown_shard (with one more shard).

    Null text has no bytes (its CRC-32 is that of the empty text); a null id is one more key value;
    repeated rows share a shard and have slots of their own; an empty table gives an empty
    result; other columns are not read.

    Slots need no sort of a whole shard: rows are numbered within (shard, read partition), and the
    partitions' counts, one row each, give every partition its first slot.  The rows (without
    their texts) are written first, so both steps see the same partitions.
    """
    key = docs[id_col].cast("long")
    body = F.encode(F.coalesce(docs[text_col].cast("string"), F.lit("")), "UTF-8")
    slim = docs.select(
        key.alias("doc_id"), (F.octet_length(body) + F.lit(8)).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"))
    slim = with_shard(with_shard(slim, "doc_id", tree, "shard"), "doc_id", grown(tree), "grown_shard")
    slim = write_table(slim, "shards")
    counts = slim.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row"))
    return (slim.withColumn("place", within).join(offsets, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("place") - 1).cast("long").alias("slot"), "grown_shard"))
