"""Shards of near-equal size by best-fit-decreasing bin packing of indivisible groups.

Rows of a group stay together; groups, largest first, enter the shard with the tightest remaining
capacity that holds them, found in a balanced tree. ``pack`` opens as few bins of a fixed capacity
as it can; for a fixed number of shards the smallest capacity that fits is searched for (a group
above the fair share of what is left gets a shard of its own first).

At scale the packing has two levels. With ``unit`` = total / (shards * ``PARCELS``), groups of at
least a unit number at most shards * PARCELS and are packed one by one. Smaller groups are dealt by
hash into slices of about ``SLICE`` groups, and every slice packs them, also best-fit-decreasing, into
parcels of one unit, in parallel. Parcels are at least half full but for one per slice; while there
are more than ``SLICE`` slices, these light parcels are dealt into slices and packed in the same way.
So the last packing sees a bounded number of items (about 3 * shards * PARCELS, plus SLICE) whatever
the number of documents; sizes then differ by about a unit. Group sizes are partially aggregated; rows
get their shard by an equi-join on the group, which Spark can split on a hot group, and their slots
by counts per piece of a written file, not by one window over a shard, so rows repeated any number
of times spread as others do.

Defined results: NULL and empty texts are one group; repeated rows are separate rows of one group;
an empty table gives no rows; other columns are ignored; rows without an id are placed as others are.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from strata.llm.common import cut, use_package

SHARDS = 40
#: Units per shard that the last packing tells apart.
PARCELS = 128
#: Small groups per slice of the first packing, and rows per numbered piece of a file.
SLICE, PIECE = 16_384, 50_000


class Tree:
    """Sorted keys in a balanced tree of two levels (a B+ tree): leaves of bounded size and the list of their least keys."""

    def __init__(self, width: int = 256):
        self.width, self.leaves, self.least = width, [], []

    def add(self, key: tuple) -> None:
        if not self.leaves:
            self.leaves, self.least = [[key]], [key]
            return
        at = max(0, bisect_left(self.least, key) - 1)
        leaf = self.leaves[at]
        insort(leaf, key)
        self.least[at] = leaf[0]
        if len(leaf) > 2 * self.width:
            self.leaves[at : at + 1] = [leaf[: self.width], leaf[self.width :]]
            self.least.insert(at + 1, leaf[self.width])

    def take_from(self, key: tuple) -> tuple | None:
        """Remove and return the least key that is not below ``key``."""
        at = max(0, bisect_left(self.least, key) - 1)
        while at < len(self.leaves):
            leaf = self.leaves[at]
            i = bisect_left(leaf, key)
            if i < len(leaf):
                found = leaf.pop(i)
                if leaf:
                    self.least[at] = leaf[0]
                else:
                    del self.leaves[at], self.least[at]
                return found
            at += 1
        return None


def pack(sizes: list[int], capacity: int, bins: int | None = None) -> tuple[list[int], int] | None:
    """Best fit decreasing: the bin of every size, and the number of bins; None if more than ``bins`` are needed."""
    tree, opened, out = Tree(), 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        found = tree.take_from((size, -1))
        if found is None:
            if size > capacity or opened == bins:
                return None
            found, opened = (capacity, opened), opened + 1
        left, b = found
        out[i] = b
        tree.add((left - size, b))
    return out, opened


def pack_into(sizes: list[int], bins: int) -> list[int]:
    """Near-equal bins: sizes above the fair share alone, the others at the smallest capacity that fits."""
    out, order = [0] * len(sizes), sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    rest, alone = sum(sizes), 0
    while alone < min(len(order), bins - 1) and sizes[order[alone]] * (bins - alone) > rest:
        out[order[alone]] = alone
        rest -= sizes[order[alone]]
        alone += 1
    order, bins = order[alone:], bins - alone
    if not order:
        return out
    left = [sizes[i] for i in order]
    low = max(left[0], -(-rest // bins))
    high = low + left[0]  # the last item put into the lowest bin never passes this
    best = None
    while best is None or low < high:
        at = high if best is None else (low + high) // 2
        got = pack(left, at, bins)
        if got is None:
            if best is None:
                high = 2 * high
            else:
                low = at + 1
        else:
            best, high = got[0], at
            if (high - low) * 1000 < high:
                break
    for i, b in zip(order, best):
        out[i] = alone + b
    return out


def shard(docs: DataFrame, size: Column, group: Column, id_col: str, shards: int = SHARDS, parcels: int = PARCELS, extra: dict[str, Column] | None = None, slice_size: int = SLICE) -> DataFrame:
    """``(id, size, shard, slot, *extra)`` per row: ``size`` a positive long, rows of equal ``group`` in one shard."""
    use_package(docs.sparkSession)
    key = [F.xxhash64(group).alias("g1"), F.xxhash64(F.lit(1), group).alias("g2")]
    rows = docs.select(F.col(id_col).alias("id"), size.cast("long").alias("size"), *key, *[c.alias(n) for n, c in (extra or {}).items()])
    groups = cut(rows.groupBy("g1", "g2").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "shard-groups")
    total, n_groups = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    unit = max(1, total // (shards * parcels))
    slices = -(-n_groups // slice_size) or 1

    def to_parcels(small: pd.DataFrame) -> pd.DataFrame:
        small = small.sort_values(["bytes", "g1", "g2"], ascending=[False, True, True])
        at, _ = pack(small["bytes"].tolist(), unit)
        return pd.DataFrame({"g1": small["g1"], "g2": small["g2"], "bytes": small["bytes"], "slice": small["slice"], "parcel": at})

    sliced = groups.filter(F.col("bytes") < unit).select("g1", "g2", "bytes", F.pmod("g1", F.lit(slices)).alias("slice"))
    placed_as = "g1 long, g2 long, bytes long, slice long, parcel long"
    small = sliced.groupBy("slice").applyInPandas(to_parcels, placed_as)
    large = groups.filter(F.col("bytes") >= unit).select("g1", "g2", "bytes", F.lit(-1).cast("long").alias("slice"), F.lit(0).cast("long").alias("parcel"))
    placed = cut(small.unionByName(large), "shard-parcels")
    # an item: a parcel, or a large group under its own key
    own = [F.when(F.col("slice") < 0, F.col(c)).otherwise(0).alias(f"i{j}") for j, c in enumerate(("g1", "g2"))]
    items = placed.select("slice", "parcel", *own, "bytes").groupBy("slice", "parcel", "i0", "i1").agg(F.sum("bytes").alias("bytes"))

    # light parcels, at most one per slice, move into parcels of the slices of a further level
    zeros = [F.lit(0).cast("long").alias(c) for c in ("i0", "i1")]
    moves, first = [], 0
    while slices > slice_size:
        items = cut(items, "shard-level")
        light = F.col("slice").between(first, first + slices - 1) & (2 * F.col("bytes") <= unit)
        first, slices = first + slices, -(-slices // slice_size)
        dealt = items.filter(light).select(F.col("slice").alias("g1"), F.col("parcel").alias("g2"), "bytes", (first + F.pmod("slice", F.lit(slices))).alias("slice"))
        moved = cut(dealt.groupBy("slice").applyInPandas(to_parcels, placed_as), "shard-moves")
        items = items.filter(~light).unionByName(moved.groupBy("slice", "parcel").agg(F.sum("bytes").alias("bytes")).select("*", *zeros))
        moves.append(moved)

    def to_shards(all_items: pd.DataFrame) -> pd.DataFrame:
        all_items = all_items.sort_values(["bytes", "slice", "parcel", "i0", "i1"], ascending=[False, True, True, True, True])
        return all_items.drop(columns="bytes").assign(shard=pack_into([int(b) for b in all_items["bytes"]], shards))

    # bounded, see above: the only step in one task
    packed = items.groupBy().applyInPandas(to_shards, "slice long, parcel long, i0 long, i1 long, shard int")
    packed = cut(packed, "shard-items").withColumnsRenamed({"slice": "s", "parcel": "p"})
    for moved in reversed(moves):
        inner = moved.join(packed, (F.col("slice") == F.col("s")) & (F.col("parcel") == F.col("p"))).select(F.col("g1").alias("s"), F.col("g2").alias("p"), *zeros, "shard")
        packed = packed.unionByName(inner)
    of_small = placed.filter("slice >= 0").join(packed, (F.col("slice") == F.col("s")) & (F.col("parcel") == F.col("p"))).select("g1", "g2", "shard")
    of_large = packed.filter("s < 0").select(F.col("i0").alias("g1"), F.col("i1").alias("g2"), "shard")
    where = of_small.unionByName(of_large)

    # slots follow the files just written: a piece is bounded whatever its rows hold
    named = cut(rows.join(where, ["g1", "g2"]), "shard-rows")
    at = F.col("_metadata.row_index")
    named = named.select("*", F.col("_metadata.file_name").alias("file"), at.alias("row"), F.floor(at / PIECE).alias("piece"))
    piece = ["shard", "file", "piece"]
    counts = named.groupBy(*piece).agg(F.count("*").alias("n"))
    before = counts.select(*piece, (F.sum("n").over(W.partitionBy("shard").orderBy("file", "piece")) - F.col("n")).alias("before"))
    inside = F.row_number().over(W.partitionBy(*piece).orderBy("row")) - 1
    return named.withColumn("inside", inside).join(before, piece).select("id", "size", "shard", (F.col("before") + F.col("inside")).alias("slot"), *(extra or {}))
