"""Repeated-passage removal by overlapping windows of three lines.

A window is three consecutive non-blank lines of a text. Windows are hashed (128 bits) and
counted over all documents; the first occurrence (smallest document id, then position) stays,
and the lines covered by any later occurrence are removed, their covered positions merged.

Only hashes and positions are shuffled for the search. Counting is a partially aggregated
``groupBy``, so a window found in a third of all rows is one partial row per task; the windows
then meet the repeated ones in an equi-join, which Spark can split on a hot window.

Only texts that lose lines are shuffled to meet their positions: a bitmap of ``BITS`` bits, broadcast
at a fixed size, tells for certain that a document loses none. The few that share a bit with
another are shuffled for nothing, so the result is the same for any number of bits. Beyond some
``BITS`` touched documents nearly all texts are shuffled.

Defined results: blank lines never form windows and go only where they lie inside a removed
window; texts of fewer than three non-blank lines, empty and NULL texts stay as they are. A
later occurrence that overlaps its own first occurrence removes only the lines behind it, so
one copy always stays. Documents without an id come first in the order. Rows equal in id and
text are one document and all get its result. All columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, text_id

WINDOW = 3
#: Bits of the bitmap of touched documents, a multiple of the 32,768 of one of its parts: 4 MB at most.
BITS = 1 << 25


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, tid, gone)`` for documents with removed lines; ``gone`` is the sorted array of their 0-based positions."""
    filled = F.array_compact(F.transform("lines", lambda x, i: F.when(x.rlike(r"[^ \t\r]"), i)))
    base = (
        docs.select(F.col(id_col).alias("id"), text_id(F.col(text_col)).alias("tid"), _lines(F.col(text_col)).alias("lines"))
        .select("id", "tid", "lines", filled.alias("at"))
        .filter(F.size("at") >= WINDOW)
        .select("id", "tid", "lines", "at", F.explode(F.sequence(F.lit(0), F.size("at") - WINDOW)).alias("o"))
    )
    line = [F.get("lines", F.get("at", F.col("o") + j)) for j in range(WINDOW)]
    windows = base.select(
        "id",
        "tid",
        F.get("at", "o").alias("lo"),
        F.get("at", F.col("o") + WINDOW - 1).alias("hi"),
        F.xxhash64(*line).alias("h1"),
        F.xxhash64(F.lit(1), *line).alias("h2"),
    )
    repeated = (
        windows.groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min(F.struct("id", "tid", "lo", "hi")).alias("first"))
        .filter("n > 1")
        .select(F.col("h1").alias("r1"), F.col("h2").alias("r2"), "first")
    )
    same_doc = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("tid") == F.col("first.tid"))
    later = (
        windows.join(repeated, (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")))
        .filter(~(same_doc & (F.col("lo") == F.col("first.lo"))))
        .select("id", "tid", F.when(same_doc, F.greatest("lo", F.col("first.hi") + 1)).otherwise(F.col("lo")).alias("lo"), "hi")
    )
    return later.groupBy("id", "tid").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.sequence("lo", "hi"))))).alias("gone"))


def _bit(id_: Column, tid: Column, bits: int) -> Column:
    """The bit of a document, from 1."""
    return F.pmod(F.xxhash64(id_, tid), F.lit(bits)) + 1


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``(doc, gone)``: every input row as the struct ``doc``, its text cleaned, and the removed positions."""
    gone = cut(repeated_lines(docs, id_col, text_col), "line-dedup-gone").withColumnsRenamed({"id": "g_id", "tid": "g_tid"})
    at = gone.select(_bit(F.col("g_id"), F.col("g_tid"), bits).alias("at"))
    # numbers are shuffled, not partial bitmaps of 4 kB each
    at = at.select("at", F.bitmap_bucket_number("at").alias("part")).repartition("part")
    parts = at.groupBy("part").agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("map"))
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("id"), text_id(F.col(text_col)).alias("tid"), F.col(text_col).alias("txt"))
    told = rows.withColumn("at", _bit(F.col("id"), F.col("tid"), bits)).join(F.broadcast(parts), F.bitmap_bucket_number("at") == F.col("part"), "left")
    here = F.bitmap_bit_position("at")
    byte = F.conv(F.hex(F.substring("map", (here / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    # a part is NULL where it holds no bit
    is_set = F.coalesce(F.call_function("shiftright", byte, (here % 8).cast("int")).bitwiseAND(1) == 1, F.lit(False))
    told = told.select("doc", "id", "tid", "txt", is_set.alias("touched"))
    none = F.lit(None).cast("array<int>").alias("gone")
    both = told.filter("touched").join(gone, F.col("id").eqNullSafe(F.col("g_id")) & (F.col("tid") == F.col("g_tid")), "left").select("doc", "txt", "gone")
    both = both.unionAll(told.filter("NOT touched").select("doc", "txt", none))
    # the lines between removed positions, as runs: linear in the number of lines
    split = both.select("doc", "gone", "txt", _lines(F.col("txt")).alias("lines"))
    n = F.size("gone")
    start = lambda i: F.when(i == 0, 0).otherwise(F.get("gone", i - 1) + 1)
    stop = lambda i: F.when(i == n, F.size("lines")).otherwise(F.get("gone", i))
    runs = F.transform(F.sequence(F.lit(0), n), lambda i: F.slice("lines", start(i) + 1, stop(i) - start(i)))
    text = F.when(F.col("gone").isNull(), F.col("txt")).otherwise(F.array_join(F.flatten(runs), "\n"))
    return split.select(F.col("doc").withField(f"`{text_col}`", text).alias("doc"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
