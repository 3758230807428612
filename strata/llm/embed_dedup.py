"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one representative per group.

Only vectors of one label (and length) are compared. Equal vectors of a label are one class,
compared once. A label's classes go to the cells of a codebook of spherical k-means centroids
fitted on a bounded sample; larger labels use larger codebooks. A class whose angle to the plane
between its cell and a later cell is below the threshold's angle is also a guest of that
later cell, and only then can a partner lie there. So every pair at or above the threshold meets in
exactly one cell and no link is lost.

Within a cell, classes less than half the threshold's angle from the centroid (the core) are
linked to each other for certain: they are counted and joined without a product, so a large
group of near copies costs no pairs. Centroids closer than the threshold's angle are thinned
out, so such a group keeps one core. All other pairs are decided by products of blocks of at most
``BLOCK`` classes; a task returns a count per class and the links of a spanning forest, never the pairs.

Defined results: rows without an id, with a NULL label or vector, and empty, zero or non-finite
vectors link with nothing and stay; repeated rows and repeated ids are separate vectors (a
component's id is its smallest ``vec_id``); an empty table gives no rows; other columns are ignored.
Classes are told apart by two 64-bit hashes of label and vector (equal by chance only).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import components, cut, use_package
from strata.llm.spherical import is_sound, sample, spherical_kmeans, unit

#: Classes of a block, and of a cell when its codebook is chosen.
BLOCK = 2048
#: Rows the codebooks are fitted on, and their sizes.
SAMPLE, CODEBOOKS = 4096, (1, 4, 16, 64, 256)
#: Guard of the angles (radians), and the margin around the threshold within which a cosine is computed anew.
SLACK, MARGIN = 1e-6, 1e-9

CORE, RIM, GUEST = 0, 1, 2


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosines of row pairs from the vectors themselves (scaled by their largest component)."""
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (left, right))
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def linked(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of rows reach the threshold: a boolean table, made in slices of the left rows."""
    out, a, b = np.empty((len(left), len(right)), bool), unit(left), unit(right)
    for i in range(0, len(left), 512):
        c = a[i : i + 512] @ b.T
        out[i : i + 512] = c >= threshold
        p, q = np.nonzero(np.abs(c - threshold) <= MARGIN)
        if len(p):
            out[i + p, q] = cosines(left[i + p], right[q]) >= threshold
    return out


def cells_of(points: np.ndarray, centroids: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, cells and kinds of unit points: each in its own cell and, as a guest, in every later cell
    where a partner can be."""
    close = points @ centroids.T
    home = close.argmax(axis=1)
    rows = np.arange(len(points))
    limit = np.arccos(threshold)
    core = np.arccos(np.clip(close[rows, home], -1, 1)) <= limit / 2 - SLACK
    out = [(rows, home, np.where(core, CORE, RIM))]
    for j in range(1, len(centroids)):
        # sine of the angle to the plane of points as near to the own centroid as to the later one
        gap = np.sqrt(((centroids[home] - centroids[j]) ** 2).sum(axis=1))
        sine = (close[rows, home] - close[:, j]) / np.where(gap > 0, gap, 1)
        at = np.flatnonzero((home < j) & (sine <= np.sin(limit) + SLACK))
        out.append((at, np.full(len(at), j), np.full(len(at), GUEST)))
    return tuple(np.concatenate(x) for x in zip(*out))


def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest of a symmetric boolean table; each row is visited once."""
    out, fresh = [], links.any(axis=1)
    for start in np.flatnonzero(fresh):
        if not fresh[start]:
            continue
        fresh[start] = False
        todo = [start]
        while todo:
            at = todo.pop()
            found = np.flatnonzero(links[at] & fresh)
            fresh[found] = False
            out += [(at, x) for x in found]
            todo += found.tolist()
    return out


def compare(frame: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Counts and forest links of one pair of blocks: ``(node, links, other)``, one of the last two NULL."""
    kind, node, weight = (frame[c].to_numpy(np.int64) for c in ("kind", "node", "copies"))
    side = frame["side"].to_numpy()
    v = np.stack(frame["v"].to_numpy()).astype(np.float64)
    links = linked(v, v, threshold)
    np.fill_diagonal(links, False)
    links &= ~np.equal.outer(kind, kind) | (kind == RIM)[:, None]  # core pairs are certain, guest pairs meet elsewhere
    if (side != side[0]).any():  # two different blocks; pairs inside each belong to another task
        links &= ~np.equal.outer(side, side)
    count = links @ weight
    some = np.flatnonzero(count)
    tree = forest(links)
    return pd.DataFrame(
        {
            "node": np.concatenate([node[some], np.array([node[a] for a, _ in tree], np.int64)]),
            "links": pd.array([*count[some], *[None] * len(tree)], "Int64"),
            "other": pd.array([*[None] * len(some), *[node[b] for _, b in tree]], "Int64"),
        }
    )


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", block: int = BLOCK
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per given row."""
    spark = vectors.sparkSession
    use_package(spark)
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & is_sound(F.col("v")) & F.exists("v", lambda x: x != 0)
    hashes = F.when(sound, F.xxhash64("label", "v")).alias("h"), F.when(sound, F.xxhash64(F.lit(1), "v", "label")).alias("g")
    classes = given.filter(sound).groupBy(*hashes).agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("v").alias("v")
    )
    classes = cut(classes.withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("v")), "vector-classes")

    points = sample(classes, "v", SAMPLE)
    apart = float(threshold)
    books = spark.sparkContext.broadcast({dim: [spherical_kmeans(v, k, apart) for k in CODEBOOKS] for dim, v in points.items()})

    def to_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (dim, book), some in batch.groupby(["dim", "book"]):
                known = books.value.get(dim)
                centroids = np.eye(1, dim) if known is None else known[book]
                at, cell, kind = cells_of(unit(np.stack(some["v"].to_numpy()).astype(np.float64)), centroids, threshold)
                out = some.iloc[at].drop(columns="book")
                out["cell"], out["kind"] = cell.astype(np.int32), kind.astype(np.int32)
                yield out

    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    book = F.lit(len(CODEBOOKS) - 1)
    for i in reversed(range(len(CODEBOOKS) - 1)):
        book = F.when(F.col("n") <= CODEBOOKS[i] * block, i).otherwise(book)
    sized = classes.join(sizes.select("label", "dim", book.cast("int").alias("book")), ["label", "dim"]).select("node", "copies", "label", "dim", "v", "book")
    placed = cut(sized.mapInPandas(to_cells, "node long, copies long, label string, dim int, v array<double>, cell int, kind int"), "vector-cells")

    # core classes of a cell are all linked: each counts the others, and hangs on the smallest
    of_cell = ["label", "dim", "cell"]
    in_core = placed.filter(F.col("kind") == CORE).select(*of_cell, "node", "copies")
    totals = in_core.groupBy(*of_cell).agg(F.sum("copies").alias("all"), F.min("node").alias("centre"))
    core = in_core.join(totals, of_cell)
    core_counts = core.select("node", (F.col("all") - F.col("copies")).alias("links"), F.lit(None).cast("long").alias("other"))
    core_links = core.filter("node > centre").select("node", F.lit(None).cast("long").alias("links"), F.col("centre").alias("other"))

    # small cells are one block; else the classes of each kind are dealt to blocks, and each two blocks that can hold pairs make a task
    counts = [F.count_if(F.col("kind") == k).alias(f"n{k}") for k in (CORE, RIM, GUEST)]
    cells = placed.groupBy(*of_cell).agg(*counts).filter("n1 + n2 > 0")
    number = lambda c: F.ceil(F.col(c) / block).cast("int")
    cells = cells.withColumn("one", F.col("n0") + F.col("n1") + F.col("n2") <= block).withColumns({f"b{k}": number(f"n{k}") for k in (CORE, RIM, GUEST)})
    dealt = placed.join(cells, of_cell)
    mine = F.when(F.col("kind") == CORE, F.col("b0")).when(F.col("kind") == RIM, F.col("b1")).otherwise(F.col("b2"))
    before = F.when(F.col("kind") == CORE, 0).when(F.col("kind") == RIM, F.col("b0")).otherwise(F.col("b0") + F.col("b1"))
    dealt = dealt.withColumn("side", F.when(F.col("one"), 0).otherwise(before + F.pmod(F.xxhash64("node"), mine).cast("int")))
    span = lambda a, n: F.when(n > 0, F.sequence(a, a + n - 1)).otherwise(F.array().cast("array<int>"))
    b0, b1, b2 = F.col("b0"), F.col("b1"), F.col("b2")
    partners = (
        F.when(F.col("one"), F.array(F.lit(0)))
        .when(F.col("kind") == CORE, span(b0, b1 + b2))
        .when(F.col("kind") == RIM, span(F.lit(0), b0 + b1 + b2))
        .otherwise(span(F.lit(0), b0 + b1))
    )
    tasks = dealt.withColumn("with", F.explode(partners)).select(
        "label", "dim", "cell", F.least("side", "with").alias("a"), F.greatest("side", "with").alias("b"), "side", "kind", "node", "copies", "v"
    )
    found = tasks.groupBy("label", "dim", "cell", "a", "b").applyInPandas(lambda f: compare(f, threshold), "node long, links long, other long")
    found = cut(found.unionByName(core_counts).unionByName(core_links), "vector-links")

    links = found.filter("links IS NOT NULL").groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(found.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")), "vector-links")
    named = classes.select("h", "g", "node", "copies", "least").join(links, "node", "left").join(labels, "node", "left")
    named = named.withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("least").alias("component"))
    named = cut(named.join(smallest, "label").select("h", "g", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "component"), "vector-groups")
    rows = given.select("vec_id", *hashes).join(named, ["h", "g"], "left")
    component = F.coalesce("component", "vec_id")
    return rows.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )
