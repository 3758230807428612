"""SimHash near-duplicates: 64-bit fingerprints, linked by multi-index hashing.

A fingerprint takes, bit by bit, the majority over the XXH64 hashes of the text's word shingles.
Fingerprints are linked at ``max_bits`` or fewer differing bits. The 64 bits are cut into three
segments, or into two, with larger balls and fuller look-ups but 2,048 times as many buckets, where
their number makes that the lesser work (with 4 bits above some 35 million). With radii r such that ``sum(r + 1) > max_bits``, two linked fingerprints differ in at
most r bits in some segment, so enumerating the Hamming ball of radius r around each segment of
one side and looking the values up in a table of the other side's segments finds every link;
the complete distance is checked inside the join.

Groups of copies never become all pairs: equal fingerprints are one node; nodes are first linked
to pivots of their table bucket (stars) and contracted, then to pivots of neighbouring buckets;
last, links are looked up only between different components, where within a bucket the members
of its largest component are never compared with each other. Only counts reach the driver.

Defined results: NULL, empty and blank texts have fingerprint zero and are linked like others;
texts of fewer words than a shingle are one shingle; repeated rows are separate rows of one
component; a NULL id belongs to its component, whose id is the smallest id that is not NULL; an
empty table gives no rows. Other columns are ignored (kept by ``near_duplicate_docs``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import components, cut, text_id, use_package

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Numbers of segments to choose from.
SEGMENTS = (2, 3)
#: Shingles hashed at a time, which bounds the memory for very long texts.
CHUNK = 1 << 16
#: Buckets of up to so many fingerprints are compared member by member; in larger ones the
#: largest component is left out against itself. Both find every link.
SMALL_BUCKET = 64


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text."""
    # bytes.lower() changes A-Z only, bytes.split() splits at 0x20 and 0x09-0x0D only
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    stops = ends[size - 1 :].tolist()
    joined = b" ".join(words)
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), CHUNK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], stops[at : at + CHUNK])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id, tid, fp)`` per row; ``fp`` holds the 64 bits as a signed long."""
    use_package(docs.sparkSession)

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).astype(np.int64))

    return docs.select(F.col(id_col).alias("id"), text_id(F.col(text_col)).alias("tid"), of(F.col(text_col)).alias("fp"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _segments(segments: int) -> list[list[int]]:
    """The bit positions of each segment."""
    return [p.tolist() for p in np.array_split(np.arange(64), segments)]


def _radii(max_bits: int, segments: int) -> list[int]:
    """Smallest balls with ``sum(r + 1) > max_bits``; -1 leaves a segment out."""
    each, more = divmod(max_bits + 1, segments)
    return [each - 1 + (i < more) for i in range(segments)]


def best_segments(n: int, max_bits: int) -> int:
    """The number of segments with the fewest look-ups and expected checks for ``n`` fingerprints."""

    def work(segments: int) -> float:
        balls = [(len(bits), sum(comb(len(bits), i) for i in range(r + 1))) for bits, r in zip(_segments(segments), _radii(max_bits, segments))]
        return sum(n * ball * (1 + n / 2**width) for width, ball in balls)

    return min(SEGMENTS, key=work)


def _looked_up(max_bits: int, balls: bool, segments: int) -> Column:
    """Array of (seg, mask, flip): one entry per segment, or one per member of its ball."""
    out = []
    for s, (bits, r) in enumerate(zip(_segments(segments), _radii(max_bits, segments))):
        if r < 0:
            continue
        mask = sum(1 << b for b in bits)
        flips = [sum(1 << b for b in c) for n in range(r + 1) for c in combinations(bits, n)] if balls else [0]
        out += [F.struct(F.lit(s).alias("seg"), F.lit(_signed(mask)).cast("long").alias("mask"), F.lit(_signed(f)).cast("long").alias("flip")) for f in flips]
    return F.array(*out)


def _keyed(nodes: DataFrame, entries: Column) -> DataFrame:
    """``nodes`` once per entry, with the segment number and value.

    Its joins are by merge: Spark sizes exploded rows as if there were one per node, and would
    broadcast through the driver hundreds of rows for each node of a small file.
    """
    spread = nodes.select("*", F.explode(entries).alias("e"))
    return spread.select(*nodes.columns, F.col("e.seg").alias("seg"), F.col("fp").bitwiseAND(F.col("e.mask")).bitwiseXOR(F.col("e.flip")).alias("key"))


def _near(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def _buckets(members: DataFrame) -> DataFrame:
    """Per (seg, key): the largest component, whether there are others, the number of fingerprints, and up to three pivots."""
    by_label = members.groupBy("seg", "key", "label").agg(
        F.sum("n").alias("c"),
        F.count("*").alias("fps"),
        F.max(F.struct("n", "fp", "label")).alias("top"),
        F.min(F.struct(F.xxhash64("fp").alias("x"), "fp", "label")).alias("low"),
        F.max(F.struct(F.xxhash64("fp").alias("x"), "fp", "label")).alias("high"),
    )
    pivot = lambda c: F.struct(c["fp"].alias("p_fp"), c["label"].alias("p_label"))
    return by_label.groupBy("seg", "key").agg(
        F.max(F.struct("c", "label"))["label"].alias("major"),
        (F.count("*") > 1).alias("mixed"),
        F.sum("fps").alias("fps"),
        F.array_distinct(F.array(pivot(F.max("top")), pivot(F.min("low")), pivot(F.max("high")))).alias("pivots"),
    )


def _pivots(members: DataFrame) -> DataFrame:
    return _buckets(members).select("seg", "key", F.explode("pivots").alias("p")).select("seg", "key", "p.*")


def _merged(nodes: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """``nodes`` relabelled by the components of links between their labels."""
    found = components(edges, name)
    return cut(nodes.join(found, nodes.label == found.node, "left").select("fp", "n", "least", F.coalesce(found.label, nodes.label).alias("label")), name)


def link(fps: DataFrame, max_bits: int = MAX_BITS, segments: int | None = None) -> DataFrame:
    """``(fp, label, component_id)`` of the distinct fingerprints in ``fps`` (id, fp); without ``segments`` their number decides."""
    nodes = cut(fps.groupBy("fp").agg(F.count("*").alias("n"), F.min("id").alias("least")).withColumn("label", F.col("fp")), "simhash-nodes")
    segments = segments or best_segments(nodes.count(), max_bits)
    entries, balls = _looked_up(max_bits, False, segments), _looked_up(max_bits, True, segments)

    # stars around the pivots of each bucket
    members = _keyed(nodes, entries)
    stars = members.hint("merge").join(_pivots(members), ["seg", "key"]).filter((F.col("fp") != F.col("p_fp")) & _near("fp", "p_fp", max_bits))
    nodes = _merged(nodes, stars.select(F.col("label").alias("a"), F.col("p_label").alias("b")), "simhash-stars")

    # the pivots of neighbouring buckets
    pivots = _pivots(_keyed(nodes, entries))
    near = _keyed(nodes.select("fp", "label"), balls).hint("merge").join(pivots, ["seg", "key"])
    near = near.filter((F.col("label") != F.col("p_label")) & _near("fp", "p_fp", max_bits))
    nodes = _merged(nodes, near.select(F.col("label").alias("a"), F.col("p_label").alias("b")), "simhash-pivots")

    # what is left: links between different components, checked inside the join
    members = _keyed(nodes, entries)
    table = _buckets(members).select("seg", "key", "major", "mixed", "fps")
    sides = members.hint("merge").join(table, ["seg", "key"]).select("seg", "key", "fp", "label", "fps", (F.col("label") == F.col("major")).alias("is_major"))
    asked = _keyed(nodes.select("fp", "label"), balls).withColumnsRenamed({"fp": "q", "label": "q_label"}).hint("merge")
    linked = (F.col("q_label") != F.col("label")) & _near("q", "fp", max_bits)
    small = asked.join(sides.filter(F.col("fps") <= SMALL_BUCKET), ["seg", "key"]).filter(linked)
    # in large buckets the largest component is not compared with itself
    kinds = F.filter(F.array(F.when(F.col("q_label") != F.col("major"), F.lit(True)), F.when(F.col("mixed"), F.lit(False))), lambda x: x.isNotNull())
    reached = asked.join(table.filter(F.col("fps") > SMALL_BUCKET), ["seg", "key"]).filter((F.col("q_label") != F.col("major")) | F.col("mixed"))
    reached = reached.select("q", "q_label", "seg", "key", F.explode(kinds).alias("is_major"))
    large = reached.hint("merge").join(sides.filter(F.col("fps") > SMALL_BUCKET), ["seg", "key", "is_major"]).filter(linked)
    others = small.select("q_label", "label").unionByName(large.select("q_label", "label"))
    nodes = _merged(nodes, others.select(F.col("q_label").alias("a"), F.col("label").alias("b")), "simhash-rest")

    least = nodes.groupBy("label").agg(F.min("least").alias("component_id"))
    return nodes.select("fp", "label").join(least, "label").select("fp", "label", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``(id, tid, fp, label, component_id)`` per row of ``docs``."""
    fps = cut(fingerprints(docs, id_col, text_col, shingle), "simhash-fps")
    return fps.join(link(fps, max_bits), "fp").select("id", "tid", "fp", "label", "component_id")


def near_duplicate_docs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group: smallest id (rows without id last), then text hash; all columns kept."""
    found = near_duplicates(docs, id_col, text_col, shingle, max_bits)
    chosen = found.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tid")).alias("c"))
    keys = chosen.select(F.col("c.none").alias("k_none"), F.coalesce("c.id", F.lit(0)).alias("k_id"), F.col("c.tid").alias("k_tid"))
    rows = docs.select(
        F.struct("*").alias("doc"), F.col(id_col).isNull().alias("k_none"), F.coalesce(F.col(id_col), F.lit(0)).alias("k_id"), text_id(F.col(text_col)).alias("k_tid")
    )
    # equal rows are one document: one of them stays
    return rows.join(keys, ["k_none", "k_id", "k_tid"], "left_semi").dropDuplicates(["k_none", "k_id", "k_tid"]).select("doc.*")
