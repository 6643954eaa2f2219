"""Sharding by a hierarchical weighted hash tree (operator 9).

A row descends from regions to racks to shards. At each level every child draws ln(u) / weight, u
being a hash of the row's key and the child's name, and the largest draw wins: a child is chosen in
proportion to its weight. A child's draw doesn't depend on its siblings, so a change of
weight moves rows into or out of that child's subtree alone.

Shards beyond the base layout are regions of their own. Thus one more shard takes rows
only into itself, and no other row moves.

Placement is a row-wise expression without a shuffle. Slots number a shard's rows
without gaps: rows are dealt out to parts of each shard, as many as the input has partitions but SLOT_PARTS at least, numbered there, and shifted by
the sizes of the parts before; texts aren't moved. Rows of one doc_id share a shard.
A null doc_id is a key like any other; a null text has no bytes. An empty table gives an
empty result. Other columns don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import text_bytes

SHARDS = 40
RACKS_PER_REGION, SHARDS_PER_RACK = 4, 2
SLOT_PARTS = 16


@dataclass(frozen=True)
class Tree:
    """Weights of shards by region and rack: {region: {rack: {shard: weight}}}."""

    regions: dict[str, dict[str, dict[int, float]]]

    @staticmethod
    def uniform(shards: int, base: int = SHARDS) -> Tree:
        """Up to base, shards fill racks of SHARDS_PER_RACK and regions of RACKS_PER_REGION racks; each further one is a region."""
        regions: dict[str, dict[str, dict[int, float]]] = {}
        for s in range(shards):
            rack = s // SHARDS_PER_RACK
            region, rack_name = (f"region{rack // RACKS_PER_REGION}", f"rack{rack}") if s < base else (f"own{s}", f"own{s}")
            regions.setdefault(region, {}).setdefault(rack_name, {})[s] = 1.0
        return Tree(regions)

    def shards(self) -> list[int]:
        return sorted(s for racks in self.regions.values() for rack in racks.values() for s in rack)


def _draw(key: Column, name: str, weight: float) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11) + 1) / F.lit(float(1 << 53))
    return F.log(u) / F.lit(float(weight))


def _choice(key: Column, weights: dict, prefix: str, value) -> Column:
    """value(child) of the child with the largest draw; among equal draws that of the larger name."""
    if len(weights) == 1:
        return F.lit(value(next(iter(weights))))
    best = F.array_max(F.array(*(F.struct(_draw(key, f"{prefix}/{child}", w).alias("draw"), F.lit(value(child)).alias("child")) for child, w in weights.items())))
    return best["child"]


def _per(column: str, names: dict, make) -> Column:
    """For rows whose column has a name, make(name); other branches aren't evaluated."""
    out = None
    for name in names:
        out = F.when(F.col(column) == name, make(name)) if out is None else out.when(F.col(column) == name, make(name))
    return out


def place(df: DataFrame, key: str, tree: Tree, out: str) -> DataFrame:
    """df with the shard of each row's key."""
    k = F.col(key)
    racks = {rack: shards for region in tree.regions.values() for rack, shards in region.items()}
    weight = {region: sum(sum(s.values()) for s in inner.values()) for region, inner in tree.regions.items()}
    df = df.withColumn("__region", _choice(k, weight, "", str))
    df = df.withColumn("__rack", _per("__region", tree.regions, lambda r: _choice(k, {n: sum(s.values()) for n, s in tree.regions[r].items()}, r, str)))
    # never null, and said so: else the joins below would filter on the whole expression once more
    df = df.withColumn(out, F.coalesce(_per("__rack", racks, lambda n: _choice(k, racks[n], n, int)).cast("int"), F.lit(-1)))
    return df.drop("__region", "__rack")


def with_slots(df: DataFrame, shard: str, order: list[str], out: str = "slot") -> DataFrame:
    """df with a number from 0 without gaps in each shard; rows equal in all of order may swap."""
    parts = max(SLOT_PARTS, df.rdd.getNumPartitions())
    df = df.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    sizes = df.groupBy(shard, "__part").agg(F.count("*").alias("__size"))
    before = Window.partitionBy(shard).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(F.col(shard).alias("__shard"), F.col("__part").alias("__of"), F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__shift"))
    inside = F.row_number().over(Window.partitionBy(shard, "__part").orderBy(*order))
    df = df.withColumn("__inside", inside).join(shifts, (F.col(shard) == F.col("__shard")) & (F.col("__part") == F.col("__of")))
    return df.withColumn(out, (F.col("__shift") + F.col("__inside") - 1).cast("long")).drop("__part", "__inside", "__shard", "__of", "__shift")


def query(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    data = text_bytes()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.length(data) + 16).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    rows = place(rows, "doc_id", Tree.uniform(shards), "shard")
    rows = place(rows, "doc_id", Tree.uniform(shards + 1), "grown_shard")
    rows = with_slots(rows, "shard", ["doc_id", "text_crc32", "size"])
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
