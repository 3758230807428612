"""Prefix trie of conversations as a minimal-perfect-hash node table.

Every turn becomes a 128-bit digest of role and text, a prefix the XOR of its turns' digests mixed
with their positions (two 64-bit lanes, with the depth); running XORs are made in blocks, so
one very long conversation is spread over tasks. Distinct prefix digests, enumerated by a
partially aggregated ``groupBy``, are the nodes.

Nodes are dealt to shards that hold whole subtrees. A node is heavy if more than a limit of turns
lie below it; heavy nodes are few (depth times rows over the limit). The others go, by the topmost
light node above them, to shards of about the limit's size. In a shard every digest gets a slot
of a minimal perfect hash (levels of bit tables; digests that collide on a level go to the next;
every look-up is verified against the digest kept in its slot), counts are scattered into flat
arrays by slot, and children, leaves and savings are added up through the parent-slot array, the
deepest nodes first. The shards' tops are summed per heavy parent, and the heavy nodes are one last
table. Below a heavy node whose members are all copies of one conversation there is one path,
so such nodes have closed forms and stay out of that table, however long and many the copies are.

Defined results: rows without a conversation id take no part; turns are ordered by number (NULL
first), then by the digest of role and text; NULL roles and texts count as empty; repeated rows are
separate turns; an empty table gives no nodes. Different prefixes share a digest only by
chance (about one pair in 2^128). A node's ``ends_sha256`` streams the sorted ids of
its ends in blocks through one task, as a hash of one string must.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import cut, use_package

#: Turns per block of the running digests, and ids per block of the hashed lists.
BLOCK, IDS = 1024, 512
#: Least size of a shard; with more rows it grows with the square root of their number.
SHARD = 16384
_LOW = (1 << 33) - 1


def _lane(hexes: Column, at: int) -> Column:
    return F.conv(F.substring(hexes, at, 16), 16, -10).cast("long")


def number_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, pos, a, b, chars)``: turns numbered from 0 in their conversation, as digests.

    The rows are range-partitioned by conversation and turn, so a conversation may span
    partitions; those it continues in (at most one per partition) get its earlier rows as offset.
    """
    r, t = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(F.concat_ws(":", F.octet_length(r).cast("string"), r, t).cast("binary"), 256)
    rows = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), digest.alias("h"), F.length(t).cast("long").alias("chars")
    )
    rows = rows.select("conv_id", "turn", _lane(F.col("h"), 1).alias("a"), _lane(F.col("h"), 17).alias("b"), "chars", F.monotonically_increasing_id().alias("salt"))
    order = ["conv_id", "turn", "a", "b", "salt"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    rows = cut(rows.drop("salt", "turn"), "trie-turns").withColumn("piece", F.shiftright("at", 33))
    pieces = rows.groupBy("conv_id", "piece").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    offsets = pieces.withColumn("offset", earlier).filter("offset > 0").select("conv_id", "piece", "offset")
    local = F.row_number().over(Window.partitionBy("conv_id", "piece").orderBy("at")) - 1
    numbered = rows.withColumn("local", local).join(offsets, ["conv_id", "piece"], "left")
    return numbered.select("conv_id", (F.col("local") + F.coalesce("offset", F.lit(0))).cast("long").alias("pos"), "a", "b", "chars")


def splice_heads(numbered: DataFrame, head: Column, length: Column, longest: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation rebuilt: the first ``length`` turns of conversation ``head`` (columns of
    ``conv_id``, lengths up to ``longest``), then its own behind its first ``length``. Returns the turns and the ids."""
    numbered = cut(numbered, "trie-numbered")
    ids = numbered.select("conv_id").distinct().withColumns({"head": head, "h": length.cast("long")})
    heads = numbered.filter(F.col("pos") < longest).withColumnRenamed("conv_id", "head")
    taken = ids.join(heads, "head").filter("pos < h").select("conv_id", "pos", "a", "b", "chars")
    known = heads.groupBy("head").agg(F.count("*").alias("n"))
    shifts = ids.join(known, "head", "left").select("conv_id", "h", (F.least("h", F.coalesce("n", F.lit(0))) - F.col("h")).alias("shift"))
    own = numbered.join(shifts, "conv_id").filter("pos >= h").select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "a", "b", "chars")
    return taken.unionByName(own), ids.select("conv_id")


def _mix(lanes: tuple[np.ndarray, ...], level: int) -> np.ndarray:
    """64 well-mixed bits of digests, another function on every level."""
    h = np.full(len(lanes[0]), np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64))
    for lane in lanes:
        h = (h ^ lane) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(29)
    return h


class SlotTable:
    """A minimal perfect hash of distinct digests ``(depth, x, y)``: slots 0 to n - 1, verified."""

    def __init__(self, depth: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        lanes = self._lanes(depth, x, y)
        rest, used = lanes, 0
        while len(rest[0]):
            if len(self.levels) > 256:
                raise ValueError("digests are not distinct")
            size = len(rest[0]) * 3 // 2 + 1
            h = (_mix(rest, len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(h, minlength=size) == 1
            self.levels.append((size, alone, used + np.cumsum(alone) - 1))
            used += int(alone.sum())
            rest = tuple(lane[~alone[h]] for lane in rest)
        slots = self._slots(lanes)
        if len(slots) and (np.bincount(slots, minlength=used) != 1).any():
            raise AssertionError("two digests in one slot")
        self.kept = tuple(np.empty_like(lane) for lane in lanes)
        for kept, lane in zip(self.kept, lanes):
            kept[slots] = lane
        self.slots = slots

    @staticmethod
    def _lanes(*arrays: np.ndarray) -> tuple[np.ndarray, ...]:
        return tuple(np.ascontiguousarray(a, np.int64).view(np.uint64) for a in arrays)

    def _slots(self, lanes: tuple[np.ndarray, ...]) -> np.ndarray:
        out = np.full(len(lanes[0]), -1, np.int64)
        todo = np.arange(len(out))
        for level, (size, alone, rank) in enumerate(self.levels):
            h = (_mix(tuple(lane[todo] for lane in lanes), level) % np.uint64(size)).astype(np.int64)
            out[todo[alone[h]]] = rank[h[alone[h]]]
            todo = todo[~alone[h]]
        return out

    def find(self, depth: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Slots of digests; -1 where the digest kept in the slot is another."""
        lanes = self._lanes(depth, x, y)
        out = self._slots(lanes)
        same = out >= 0
        for kept, lane in zip(self.kept, lanes):
            same &= (kept[np.maximum(out, 0)] if len(kept) else lane) == lane
        return np.where(same, out, -1)


def solve(nodes: pd.DataFrame) -> pd.DataFrame:
    """Sums over the subtrees of one shard's nodes. ``children``, ``leaves`` and ``saved`` come in as
    what other tables add below a node, and leave as whole sums; ``is_top`` marks nodes whose parent is elsewhere."""
    col = lambda name: nodes[name].to_numpy(np.int64)
    depth, n = col("depth"), len(nodes)
    table = SlotTable(depth, col("x"), col("y"))
    slot = table.slots
    parent = np.full(n, -1, np.int64)
    parent[slot] = table.find(depth - 1, col("px"), col("py"))

    def scatter(values: np.ndarray) -> np.ndarray:
        flat = np.empty(n, np.int64)
        flat[slot] = values
        return flat

    at_depth, conv = scatter(depth), scatter(col("conv_id"))
    children, leaves = scatter(col("children")), scatter(col("leaves"))
    saved = scatter(col("saved") + (col("n_convs") - 1) * col("chars"))
    order = np.argsort(-at_depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(at_depth[order])) + 1):
        leaves[level] += children[level] == 0
        below = level[parent[level] >= 0]
        np.add.at(children, parent[below], 1)
        np.add.at(leaves, parent[below], leaves[below])
        np.add.at(saved, parent[below], saved[below])
    out = nodes[["depth", "x", "y", "px", "py", "conv_id", "n_convs"]].copy()
    above = parent[slot]
    out["parent_conv_id"] = pd.array(np.where(above >= 0, conv[np.maximum(above, 0)], 0), "Int64")
    out.loc[above < 0, "parent_conv_id"] = pd.NA
    out["children"], out["leaves"], out["saved"], out["is_top"] = children[slot], leaves[slot], saved[slot], above < 0
    return out


def _hash_lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each node's id blocks, which come sorted by node and block."""
    now, state = None, None
    for batch in batches:
        done = []
        for depth, x, y, ids in zip(batch["depth"], batch["x"], batch["y"], batch["ids"]):
            if (depth, x, y) != now:
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = (depth, x, y), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pd.DataFrame(done, columns=["depth", "x", "y", "ends_sha256"])
    if now is not None:
        yield pd.DataFrame([(*now, state.hexdigest())], columns=["depth", "x", "y", "ends_sha256"])


def prefix_paths(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Every prefix of every conversation: ``(conv_id, depth, x, y, px, py, chars, total)``, from depth 0;
    ``chars`` is the last turn's length, ``total`` the prefix's."""
    lanes = {"x": F.xxhash64("pos", "a", "b"), "y": F.xxhash64(F.lit("trie"), "b", "pos", "a")}
    rows = turns.withColumns(lanes | {"blk": F.floor(F.col("pos") / BLOCK)})
    blocks = rows.groupBy("conv_id", "blk").agg(F.bit_xor("x").alias("bx"), F.bit_xor("y").alias("by"), F.sum("chars").alias("bt"))
    before = Window.partitionBy("conv_id").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "blk", *[f(c).over(before).alias(c) for f, c in ((F.bit_xor, "bx"), (F.bit_xor, "by"), (F.sum, "bt"))])
    upto = Window.partitionBy("conv_id", "blk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    running = rows.withColumns({"rx": F.bit_xor("x").over(upto), "ry": F.bit_xor("y").over(upto), "rt": F.sum("chars").over(upto)})
    joined = running.join(blocks.filter("blk > 0"), ["conv_id", "blk"], "left")
    full = lambda run, block: F.col(run).bitwiseXOR(F.coalesce(block, F.lit(0).cast("long")))
    paths = joined.select(
        "conv_id", (F.col("pos") + 1).alias("depth"), full("rx", "bx").alias("x"), full("ry", "by").alias("y"), F.col("x").alias("own_x"), F.col("y").alias("own_y"),
        "chars", (F.col("rt") + F.coalesce("bt", F.lit(0))).alias("total"),
    )
    paths = paths.select("conv_id", "depth", "x", "y", F.col("x").bitwiseXOR(F.col("own_x")).alias("px"), F.col("y").bitwiseXOR(F.col("own_y")).alias("py"), "chars", "total")
    zero = F.lit(0).cast("long")
    return paths.unionByName(convs.select("conv_id", *[zero.alias(c) for c in paths.columns[1:]]))


def build(turns: DataFrame, convs: DataFrame, shard: int = SHARD) -> DataFrame:
    """The nodes of the trie of ``turns`` (``conv_id, pos, a, b, chars``), one row each."""
    use_package(turns.sparkSession)
    paths = cut(prefix_paths(turns, convs), "trie-paths")
    last = F.max_by(F.struct("x", "y", "total"), "depth").alias("e")
    ends = cut(paths.groupBy("conv_id").agg(F.max("depth").alias("length"), last).select("conv_id", "length", F.col("e.x").alias("ex"), F.col("e.y").alias("ey"), F.col("e.total").alias("whole")), "trie-ends")
    rows = paths.join(ends, "conv_id")
    key = ["depth", "x", "y"]
    nodes = rows.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        *[F.first(c).alias(c) for c in ("px", "py", "chars")],
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
        (F.min(F.struct("length", "ex", "ey")) == F.max(F.struct("length", "ex", "ey"))).alias("copies_only"),
        F.min(F.col("whole") - F.col("total") + F.col("chars")).alias("rest"),
        F.min("length").alias("length"),
    )
    nodes = cut(nodes, "trie-nodes")
    n = paths.count()
    limit = max(shard, int(4 * n**0.5))
    shards = max(1, -(-n // limit))
    heavy = cut(nodes.filter(F.col("weight") > limit), "trie-heavy")

    # a light node's shard is that of the topmost light node on its path
    deepest = paths.select("conv_id", *key).join(heavy.select(*key), key, "left_semi").groupBy("conv_id").agg(F.max("depth").alias("top"))
    roots = paths.join(deepest, "conv_id", "left").filter(F.col("depth") == F.coalesce("top", F.lit(-1)) + 1)
    roots = roots.select("conv_id", F.pmod(F.xxhash64(*key), F.lit(shards)).cast("int").alias("shard"))
    table = ["depth", "x", "y", "px", "py", "conv_id", "n_convs", "chars"]
    zero = F.lit(0).cast("long")
    below = {c: zero for c in ("children", "leaves", "saved")}
    light = nodes.filter(F.col("weight") <= limit).select(*table).withColumns(below).join(roots, "conv_id")
    solved = "depth long, x long, y long, px long, py long, conv_id long, n_convs long, parent_conv_id long, children long, leaves long, saved long, is_top boolean"
    light = cut(light.groupBy("shard").applyInPandas(solve, solved), "trie-light")

    # heavy nodes over copies of one conversation: one path below, one leaf
    single = heavy.filter("copies_only").select(
        *table[:7], F.lit(None).cast("long").alias("parent_conv_id"), (F.col("length") > F.col("depth")).cast("long").alias("children"), F.lit(1).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("rest")).alias("saved"), F.lit(True).alias("is_top"),
    )
    branching = heavy.filter(~F.col("copies_only")).select(*table)
    parent = [(F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py")]
    tops = light.filter("is_top").unionByName(single)
    sums = tops.groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y"))
    sums = sums.agg(F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    top = branching.join(sums, key, "left").select(*table, *[F.coalesce(c, zero).alias(c) for c in below])
    top = top.withColumn("shard", F.lit(0)).groupBy("shard").applyInPandas(solve, solved)

    above = heavy.select(*parent, F.col("conv_id").alias("above"))
    every = light.unionByName(single).unionByName(top).join(above, ["depth", "px", "py"], "left")

    lists = ends.select(F.col("length").alias("depth"), F.col("ex").alias("x"), F.col("ey").alias("y"), "conv_id", F.floor(F.col("conv_id") / IDS).alias("blk"))
    lists = lists.groupBy(*key, "blk").agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    lists = lists.repartition(*key).sortWithinPartitions(*key, "blk")
    hashed = lists.select(*key, "ids").mapInPandas(_hash_lists, "depth long, x long, y long, ends_sha256 string")
    return every.join(hashed, key, "left").select(
        "conv_id",
        "depth",
        F.coalesce("parent_conv_id", "above").alias("parent_conv_id"),
        "n_convs",
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
