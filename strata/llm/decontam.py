"""Benchmark decontamination by winnowing, in DataFrame expressions only.

Words: A-Z lower-cased, maximal runs of letters a-z, digits and non-ASCII characters. Texts
are contaminated where they share ``span`` (10) consecutive words with a benchmark item.

From the hashes of all k-grams (``k`` = 5) of a text, every run of ``span - k + 1`` (6) of them
keeps its minimum, leftmost on ties, as the run's fingerprint. A shared span of ``span`` words
holds the same run of k-grams on both sides, hence the same fingerprint: none is missed. The
fingerprints of documents and benchmark meet in an equi-join; each match is extended word by
word to both sides and counts where the equal stretch has at least ``span`` words. (A fingerprint's
spans reach at most ``span - k`` words to either side, so the extension stops there.) Items
of fewer words than ``span`` are one fingerprint as a whole and are compared as a whole.

Document fingerprints are made inside one generated loop over positions and probe the benchmark's
table at once; only matches leave the task, one row per document besides. The benchmark's
fingerprints are broadcast while they number at most ``max_broadcast``, else both sides are
shuffled by fingerprint. Equal contexts of different items are one row with a list of ids.

Defined results: NULL and empty texts have no words and no hits; items without words match
nothing; repeated items count once per id; items without an id match but are not counted or
listed. Rows of ``docs`` equal in id and text each get the same result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import lower_ascii, text_id

SPAN = 10
K = 5
#: Benchmark fingerprints that are broadcast at most (each about 300 bytes with its context).
MAX_BROADCAST = 200_000

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _BREAK), "")


def _kgram(at: Column, k: int) -> Column:
    """Hash of the k word hashes from position ``at``: rotations and XOR, which cannot overflow."""
    out = None
    for j in range(k):
        h = F.get("h", at + j)
        turned = h if j == 0 else F.shiftleft(h, 13 * j % 64).bitwiseOR(F.shiftrightunsigned(h, 64 - 13 * j % 64))
        out = turned if out is None else out.bitwiseXOR(turned)
    return out


def _fingerprint(span: int, k: int) -> Column:
    """Minimum k-gram hash of the span at ``i``; its low bits hold the offset of that k-gram."""
    bits = max(1, (span - k).bit_length())
    mask = ~((1 << bits) - 1)
    grams = [F.get("g", F.col("i") + o).bitwiseAND(F.lit(mask)).bitwiseOR(F.lit(o)) for o in range(span - k + 1)]
    return F.least(*grams) if len(grams) > 1 else grams[0]


def _spans(rows: DataFrame, keep: list[str], span: int, k: int, mark: bool = False) -> DataFrame:
    """Per span of ``words`` in ``rows``: fingerprint ``f``, position ``p`` of its k-gram, the words around.

    With ``mark`` every row also gives one line with ``i`` = -1 and no fingerprint.
    """
    first = -1 if mark else 0
    top = F.col("n") - span
    at = F.explode(F.sequence(F.lit(first), F.greatest(top, F.lit(-1)))) if mark else F.explode(F.when(top >= 0, F.sequence(F.lit(0), top)))
    bits = max(1, (span - k).bit_length())
    low = (1 << bits) - 1
    # the k-gram hashes are an array of their own: computed in the loop over positions they would
    # make its generated method too long to be compiled
    grams = F.when(F.col("n") >= span, F.transform(F.sequence(F.lit(0), F.col("n") - k), lambda i: _kgram(i, k)))
    spread = rows.select(*keep, "ws", "n", grams.alias("g")).select(*keep, "ws", "g", "n", at.alias("i"))
    value = F.when(F.col("i") >= 0, _fingerprint(span, k)) if mark else _fingerprint(span, k)
    valued = spread.select(*keep, "ws", "n", "i", value.alias("v"))
    return valued.select(
        *keep,
        "ws",
        "n",
        "i",
        F.col("v").bitwiseAND(F.lit(~low)).alias("f"),
        (F.col("i") + F.col("v").bitwiseAND(F.lit(low)).cast("int")).alias("p"),
    )


def _prefix(equal: list[Column]) -> Column:
    """How many of the comparisons hold before the first that does not."""
    out = F.lit(len(equal))
    for j in range(len(equal) - 1, -1, -1):
        out = F.when(~F.coalesce(equal[j], F.lit(False)), j).otherwise(out)
    return out


def _with_words(df: DataFrame, keep: list[Column], text: Column) -> DataFrame:
    got = df.select(*keep, words(text).alias("ws"))
    names = [c for c in got.columns if c != "ws"]
    return got.select(*names, "ws", F.transform("ws", lambda w: F.xxhash64(w)).alias("h"), F.size("ws").alias("n"))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    span: int = SPAN,
    k: int = K,
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """``(id, tid, n_words, hits, items, copies)`` per distinct document (id and text).

    ``hits`` are the sorted 0-based positions of hit words, ``items`` the ids found, ``copies``
    the number of equal rows.
    """
    side = span - k
    bench = _with_words(benchmark, [F.col(item_col).alias("item")], F.col(item_text_col)).filter("n > 0")
    context = lambda p: F.slice("ws", F.greatest(p - side, F.lit(0)) + 1, side + span)
    seeds = (
        _spans(bench, ["item"], span, k)
        .select("item", F.col("f").alias("b_f"), F.least("p", F.lit(side)).alias("b_at"), context(F.col("p")).alias("b_ctx"))
        .groupBy("b_f", "b_at", "b_ctx")
        .agg(F.collect_set("item").alias("b_items"))
    )
    shorts = bench.filter(F.col("n") < span).groupBy("n", "ws").agg(F.first("h").alias("h"), F.collect_set("item").alias("b_items"))
    # at most span - 1 numbers
    short_sizes = [r.n for r in shorts.select("n").distinct().collect()]

    rows = _with_words(docs, [F.col(id_col).alias("id"), text_id(F.col(text_col)).alias("tid")], F.col(text_col))
    marks = _spans(rows, ["id", "tid"], span, k, mark=True)
    if seeds.limit(max_broadcast + 1).count() <= max_broadcast:
        joined = marks.join(F.broadcast(seeds), F.col("f") == F.col("b_f"), "left").filter((F.col("i") == -1) | F.col("b_f").isNotNull())
        joined = joined.select("id", "tid", "n", "i", "p", F.when(F.col("b_f").isNotNull(), context(F.col("p"))).alias("ctx"), "b_at", "b_ctx", "b_items")
    else:
        slim = marks.select("id", "tid", "n", "i", "f", "p", F.when(F.col("i") >= 0, context(F.col("p"))).alias("ctx"))
        # neighbouring spans mostly share their fingerprint's k-gram: one row each before the shuffle
        single = slim.filter("i >= 0").dropDuplicates(["id", "tid", "f", "p"])
        joined = (
            single.join(seeds, F.col("f") == F.col("b_f"))
            .select("id", "tid", "n", "i", "p", "ctx", "b_at", "b_ctx", "b_items")
            .unionByName(slim.filter("i = -1").select("id", "tid", "n", "i", "p", "ctx"), allowMissingColumns=True)
        )
    at = F.least("p", F.lit(side))
    left = _prefix([F.get("ctx", at - j) == F.get("b_ctx", F.col("b_at") - j) for j in range(1, side + 1)])
    right = _prefix([F.get("ctx", at + j) == F.get("b_ctx", F.col("b_at") + j) for j in range(span)])
    stretched = joined.select("id", "tid", "n", "i", "p", "b_items", left.alias("l"), right.alias("r"))
    hit = (F.col("i") >= 0) & (F.col("r") >= k) & (F.col("l") + F.col("r") >= span)
    found = stretched.filter((F.col("i") == -1) | hit).select(
        "id",
        "tid",
        "n",
        (F.col("i") == -1).alias("mark"),
        F.when(F.col("i") >= 0, F.sequence(F.col("p") - F.col("l"), F.col("p") + F.col("r") - 1)).alias("at"),
        F.col("b_items").alias("items"),
    )
    for size in sorted(short_sizes):
        whole = shorts.filter(F.col("n") == size).select(F.xxhash64("h").alias("b_f"), F.col("ws").alias("b_ws"), "b_items")
        spread = rows.filter(F.col("n") >= size).select("id", "tid", "ws", "h", "n", F.explode(F.sequence(F.lit(0), F.col("n") - size)).alias("i"))
        hashed = spread.select("id", "tid", "n", "i", F.xxhash64(F.slice("h", F.col("i") + 1, size)).alias("f"), F.slice("ws", F.col("i") + 1, size).alias("part"))
        found = found.unionAll(
            hashed.join(whole, (F.col("f") == F.col("b_f")) & (F.col("part") == F.col("b_ws"))).select(
                "id", "tid", "n", F.lit(False).alias("mark"), F.sequence(F.col("i"), F.col("i") + size - 1).alias("at"), F.col("b_items").alias("items")
            )
        )
    return found.groupBy("id", "tid").agg(
        F.max("n").cast("long").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("at")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.count_if("mark").alias("copies"),
    )
