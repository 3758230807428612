"""Hard negatives for anchors, by angular triangle filtering.

Components become whole numbers (``floor(256 * x)``), and a row's score is its inner product with
the anchor, an exact integer. Every row stores its norm and its angles to a few reference
directions (spherical k-means centroids of a bounded sample). For an anchor at angle ``p`` and a
row at angle ``q`` from the same direction, the angle between the two lies within ``|p - q|`` and
``min(p + q, 2 pi - p - q)``; the cosines of these ends, times both norms and widened against
rounding, bound the score. Rows are range-partitioned by nearest direction and angle, so that
a run of neighbouring rows has narrow angles: only runs whose interval reaches the anchor's
present k-th positive, or overlaps the score window of one of its positives, are scored.

Two passes over all rows, in blocks: the first finds each anchor's positives (best rows of its
label), the second the best rows of other labels inside each positive's window
``low * positive <= 100 * negative <= high * positive``. A task compares one block of rows with one
block of anchors and keeps k rows per anchor or window, so memory is bounded whatever the
skew of labels or copies; the ranking window cuts to k before its shuffle too. In the second pass an
eighth of the blocks goes first, and their k-th best are floors for the others: what lies below has k
better rows already. Work grows with rows times anchors where the angles exclude nothing.

Defined results: rows without an id, with a NULL label or vector, an empty vector, or NULL or
non-finite components take no part; zero vectors score 0; only vectors of one length are
compared; higher scores first, ties to the smaller id; rows that repeat an id are separate
candidates, an anchor id that repeats is asked once (its smallest vector), and no row with the
anchor's id is its partner; scores beyond a long are cut to its range. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import cut, use_package
from strata.llm.spherical import is_sound, sample, spherical_kmeans, unit

#: Rows of a block while there are at most ``BLOCKS`` blocks; then as many as ``WIDE`` such blocks. Anchors of a task, in blocks.
BLOCK, BLOCKS, WIDE, ASKED = 8192, 64, 32, 8
#: Neighbouring rows that share one score interval, and the anchors that are compared with them at a time.
RUN, TILE = 512, 2048
#: Candidates after which floors are raised, and the share of the blocks whose best are the floors of the others.
MANY, PROBE = 1 << 18, 8
#: Rows the reference directions are fitted on, and their number.
SAMPLE, DIRECTIONS = 2048, 16
#: Guard against the rounding of angles (radians) and of products (a share of the norms' product).
SLACK = 1e-7
NONE, MOST = np.iinfo(np.int64).min + 1, np.iinfo(np.int64).max


def whole(vectors: np.ndarray) -> np.ndarray:
    """``floor(256 * x)``: doubles where these are exact integers, else Python integers."""
    if (np.abs(vectors) < 2.0**44).all():
        return np.floor(vectors * 256)
    return np.array([[int(x) * 256 if abs(x) >= 2.0**53 else int(np.floor(x * 256)) for x in row] for row in vectors.tolist()], object)


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products of whole row vectors: floats where these are exact (see ``in_type``), else int64 (cut to its range)."""
    if anchors.dtype == rows.dtype == np.float32:
        return anchors @ rows.T
    if anchors.dtype != object and rows.dtype != object:
        if np.abs(anchors).max() * np.abs(rows).max() * rows.shape[1] < 2.0**53:  # every partial sum is exact
            return anchors @ rows.T
    a, r = ([[int(x) for x in v] for v in side.tolist()] for side in (anchors, rows))
    return np.array([[max(-(2**63) + 2, min(2**63 - 1, sum(x * y for x, y in zip(p, q)))) for q in r] for p in a], np.int64)


def angles(vectors: np.ndarray, directions: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit(vectors) @ directions.T, -1, 1))


def norms(vectors: np.ndarray) -> np.ndarray:
    most = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / np.where(most > 0, most, 1.0)
    return np.sqrt((scaled * scaled).sum(axis=1)) * most[:, 0]


def intervals(angle: np.ndarray, norm: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores of anchors (angles, norms) with runs of rows (ranges of both): two tables, anchor by run."""
    near, far = np.zeros((len(angle), len(low))), np.full((len(angle), len(low)), np.pi)
    for j in range(angle.shape[1]):
        a = angle[:, j, None]
        near = np.maximum(near, np.maximum(low[None, :, j] - a, a - high[None, :, j]) - SLACK)
        far = np.minimum(far, np.minimum(a + high[None, :, j], 2 * np.pi - a - low[None, :, j]) + SLACK)
    top, end = np.cos(np.clip(near, 0, np.pi)), np.cos(np.clip(far, 0, np.pi))
    with np.errstate(over="ignore"):
        spare = SLACK * norm[:, None] * most[None, :] + 1
        upper = norm[:, None] * np.where(top > 0, top * most, top * least) + spare
        lower = norm[:, None] * np.where(end > 0, end * least, end * most) - spare
    return np.nan_to_num(lower, nan=-np.inf, neginf=-np.inf), np.nan_to_num(upper, nan=np.inf, posinf=np.inf)


class Best:
    """The k best (score, id) of each list within its window ``first`` to ``last``, and each list's present floor."""

    def __init__(self, first: np.ndarray, last: np.ndarray, floor: np.ndarray, k: int) -> None:
        self.first, self.last, self.k = first, last, k
        # rows as good as the floor but of a larger id come too late; a floor from elsewhere has no id
        self.floor, self.floor_id = floor.copy(), np.full(len(floor), MOST)
        self.row, self.id, self.score = (np.empty(0, np.int64) for _ in range(3))

    def need(self) -> np.ndarray:
        """The least score that each list takes."""
        return np.where(self.first <= self.last, np.maximum(self.first, self.floor), MOST)

    def add(self, lists: np.ndarray, ids: np.ndarray, found: np.ndarray) -> None:
        floor = self.floor[lists]
        late = (found < floor) | ((found == floor) & (ids > self.floor_id[lists]))
        keep = ~late & (found >= self.first[lists]) & (found <= self.last[lists])
        row, ident, score = (np.concatenate(x) for x in ((self.row, lists[keep]), (self.id, ids[keep]), (self.score, found[keep])))
        order = np.lexsort((ident, -score, row))
        row, ident, score = row[order], ident[order], score[order]
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        rank = np.arange(len(row)) - np.repeat(starts, np.diff(np.r_[starts, len(row)]))
        last = rank == self.k - 1
        self.floor[row[last]], self.floor_id[row[last]] = score[last], ident[last]
        keep = rank < self.k
        self.row, self.id, self.score = row[keep], ident[keep], score[keep]


def narrow(vectors: np.ndarray) -> list[bytes]:
    """Vectors as bytes: whole numbers of 16 bits where all fit, else the doubles as they are."""
    with np.errstate(over="ignore"):
        w = np.floor(vectors * 256)
    small = (np.abs(w) <= 32767).all(axis=1)
    return [x.astype("<i2").tobytes() if few else v.astype("<f8").tobytes() for x, v, few in zip(w, vectors, small)]


def widen(coded: pd.Series, dim: int) -> np.ndarray:
    """Of ``narrow``: int16, or doubles if some vector has them."""
    if (coded.map(len) == 2 * dim).all():
        return np.frombuffer(b"".join(coded), "<i2").reshape(-1, dim)
    return np.stack([np.frombuffer(x, "<i2") / 256 if len(x) == 2 * dim else np.frombuffer(x, "<f8") for x in coded])


class Side:
    """Rows of one vector length, from a pandas frame in its order, with norms and angles to ``directions``."""

    def __init__(self, frame: pd.DataFrame, dim: int, directions: np.ndarray) -> None:
        self.frame = frame
        self.id, self.label = frame["id"].to_numpy(np.int64), frame["label"].to_numpy(np.int64)
        v = widen(frame["w"], dim)
        self.vector = v if v.dtype == np.int16 else whole(v)
        self.most = np.inf if self.vector.dtype == object else float(np.abs(self.vector).max())
        got = [measured(v[i : i + 8192] / 256 if v.dtype == np.int16 else v[i : i + 8192], directions) for i in range(0, len(v), 8192)]
        self.norm, self.angle = (np.concatenate(x) for x in zip(*got))

    def runs(self, part: slice) -> tuple[list[slice], tuple[np.ndarray, ...]]:
        cuts = [slice(i, min(i + RUN, part.stop)) for i in range(part.start, part.stop, RUN)]
        ranges = [(self.angle[c].min(axis=0), self.angle[c].max(axis=0), self.norm[c].min(), self.norm[c].max()) for c in cuts]
        return cuts, tuple(np.array(x) for x in zip(*ranges))


def measured(vectors: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms of the whole vectors and their angles to ``directions``."""
    with np.errstate(over="ignore"):
        v = np.where(np.abs(vectors) < 2.0**44, np.floor(vectors * 256) / 256, vectors)  # whole vectors over 256
        return norms(v) * 256, angles(v, directions)


def in_type(rows: Side, asked: Side, dim: int) -> None:
    """The vectors as the smallest floats that give exact scores: every partial sum is a whole number below 2 ** 24 or 2 ** 53."""
    if rows.vector.dtype != object and asked.vector.dtype != object:
        kind = np.float32 if rows.most * asked.most * dim < 2.0**24 else np.float64
        rows.vector, asked.vector = rows.vector.astype(kind), asked.vector.astype(kind)


def search(rows: Side, part: slice, asked: Side, who: np.ndarray, owner: np.ndarray, window: tuple[np.ndarray, np.ndarray, np.ndarray], k: int, other: bool) -> tuple[np.ndarray, ...]:
    """The k best rows of ``part`` for each list: (list, row id, score). ``owner``, ascending, is each list's position in
    ``who`` (anchors), ``window`` its first and last score and a floor known from elsewhere; with ``other`` only rows of other labels.

    Anchors go tile by tile over the runs whose interval reaches them, the most promising first. A row of scores is
    looked into only where its best score is as good as the least that the anchor's lists still take.
    """
    out = [(np.empty(0, np.int64),) * 3]
    cuts, ranges = rows.runs(part)
    starts = np.searchsorted(owner, np.arange(len(who) + 1))
    for t in range(0, len(who), TILE):
        mine = who[t : t + TILE]
        begin, l0, l1 = starts[t : t + len(mine)], starts[t], starts[t + len(mine)]
        if l0 == l1:
            continue
        count, of = starts[t + 1 : t + len(mine) + 1] - begin, owner[l0:l1] - t
        best = Best(*(x[l0:l1] for x in window), k)
        top = np.full(len(mine), NONE)
        np.maximum.at(top, of, best.last)
        need = np.full(len(mine), MOST)
        np.minimum.at(need, of, best.need())
        held: list[tuple[np.ndarray, ...]] = []

        def settle() -> None:
            if held:
                at, row, score = (np.concatenate(x) for x in zip(*held))
                held.clear()
                own = asked.id[mine[at]] == rows.id[row]  # no row is its own partner
                at, row, score = at[~own], row[~own], score[~own]
                lists = [(begin[at[has]] - l0 + j, rows.id[row[has]], score[has]) for j in range(count.max()) for has in [count[at] > j]]
                best.add(*(np.concatenate(x) for x in zip(*lists)))
                need.fill(MOST)
                np.minimum.at(need, of, best.need())

        lower, upper = intervals(asked.angle[mine], asked.norm[mine], *ranges)
        done, due, waiting = 0, 1, 0
        for at in np.argsort(-upper.max(axis=0), kind="stable"):
            c, some = cuts[at], np.flatnonzero((upper[:, at] >= need) & (lower[:, at] <= top))
            if not len(some):
                continue
            found = scores(asked.vector[mine[some]], rows.vector[c])
            good = np.flatnonzero(found.max(axis=1) >= need[some].astype(found.dtype))
            if len(good):
                some, found = some[good], found[good]
                hit = (found >= need[some].astype(found.dtype)[:, None]) & (found <= top[some].astype(found.dtype)[:, None])
                if other:
                    hit &= asked.label[mine[some]][:, None] != rows.label[c][None, :]
                if np.count_nonzero(hit) > 4 * k * len(some) + 1024 and found.shape[1] > k:  # many: first see how good the k-th of them is in each list
                    hit &= asked.id[mine[some]][:, None] != rows.id[c][None, :]
                    none = NONE if found.dtype == np.int64 else -np.inf
                    for j in range(count.max()):
                        has = np.flatnonzero(count[some] > j)
                        at_list = begin[some[has]] - l0 + j
                        f = found[has]
                        ok = hit[has] & (f >= best.first[at_list].astype(f.dtype)[:, None]) & (f <= best.last[at_list].astype(f.dtype)[:, None])
                        kth = np.partition(np.where(ok, f, none), -k, axis=1)[:, -k]
                        real = kth > none
                        at_list, kth = at_list[real], kth[real].astype(np.int64)
                        higher = kth > best.floor[at_list]
                        best.floor[at_list[higher]], best.floor_id[at_list[higher]] = kth[higher], MOST
                    need.fill(MOST)
                    np.minimum.at(need, of, best.need())
                    hit &= found >= need[some].astype(found.dtype)[:, None]
                    due = done
                a, col = np.divmod(np.flatnonzero(hit), hit.shape[1])
                if len(a):
                    held.append((some[a], c.start + col, found[a, col].astype(np.int64)))
                    waiting += len(a)
            done += 1
            if done > due or waiting > MANY:
                settle()
                due, waiting = 3 * done, 0
        settle()
        out.append((best.row + l0, best.id, best.score))
    return tuple(np.concatenate(x) for x in zip(*out))


def pairs_of(rows: pd.DataFrame, asked: pd.DataFrame, directions: dict[int, np.ndarray], order: list[str]) -> Iterator[tuple[Side, Side]]:
    """Rows and anchors of a task by vector length."""
    for dim in sorted(set(rows["dim"]) & set(asked["dim"])):
        known = directions_of(directions, dim)
        sides = [Side(x[x["dim"] == dim].sort_values(order), dim, known) for x in (rows, asked)]
        in_type(*sides, dim)
        yield sides[0], sides[1]


def directions_of(directions: dict[int, np.ndarray], dim: int) -> np.ndarray:
    return directions[dim] if dim in directions else np.full((1, dim), dim**-0.5)


def positives_in(rows: pd.DataFrame, asked: pd.DataFrame, directions: dict[int, np.ndarray], k: int) -> pd.DataFrame:
    """Each anchor's k best rows of its label in one block: ``(anchor_id, id, score)``."""
    out = []
    for side, anchors in pairs_of(rows, asked, directions, ["label", "home", "angle", "id"]):
        for label in np.intersect1d(side.label, anchors.label):
            part, who = (slice(int(np.searchsorted(x.label, label)), int(np.searchsorted(x.label, label, "right"))) for x in (side, anchors))
            n = who.stop - who.start
            window = np.full(n, NONE), np.full(n, MOST), np.full(n, NONE)
            row, ident, score = search(side, part, anchors, np.arange(who.start, who.stop), np.arange(n), window, k, False)
            out.append(pd.DataFrame({"anchor_id": anchors.id[who.start + row], "id": ident, "score": score}))
    return pd.concat(out) if out else pd.DataFrame({"anchor_id": [], "id": [], "score": []})


def negatives_in(rows: pd.DataFrame, asked: pd.DataFrame, directions: dict[int, np.ndarray], k: int, low: int, high: int) -> pd.DataFrame:
    """Each positive's k best rows of another label inside its window, in one block; ``floors`` of the anchors hold for all blocks."""
    names = ["anchor_id", "at", "negative_id", "negative_score"]
    out = []
    for side, anchors in pairs_of(rows, asked, directions, ["home", "angle", "id"]):
        given = anchors.frame["p_scores"]
        owner = np.repeat(np.arange(len(given)), given.map(len))
        rank = np.concatenate([np.arange(1, len(x) + 1) for x in given])
        ps, floor = (np.concatenate(anchors.frame[c].to_list()).astype(np.int64) for c in ("p_scores", "floors"))
        first = np.array([-(-low * s // 100) for s in ps.tolist()], np.int64)
        last = np.array([high * s // 100 for s in ps.tolist()], np.int64)
        codes = np.unique(np.concatenate([side.label, anchors.label]), return_inverse=True)[1].astype(np.int32)
        side.label, anchors.label = codes[: len(side.id)], codes[len(side.id) :]
        row, ident, score = search(side, slice(0, len(side.id)), anchors, np.arange(len(given)), owner, (first, last, floor), k, True)
        out.append(pd.DataFrame(dict(zip(names, (anchors.id[owner[row]], rank[row], ident, score)))))
    return pd.concat(out) if out else pd.DataFrame({n: [] for n in names})


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | str = "label",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for all anchors."""
    spark = vectors.sparkSession
    use_package(spark)
    given = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
        F.col(vec_col).cast("array<double>").alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("asked"),
    )
    rows = given.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & is_sound(F.col("v")))
    n, n_asked = rows.agg(F.count("*"), F.count_if("asked")).first()
    directions = spark.sparkContext.broadcast({dim: spherical_kmeans(v, DIRECTIONS) for dim, v in sample(rows, "v", SAMPLE).items()})

    def add_angles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = batch["v"].map(len)
            for dim in sorted(set(size)):
                some = batch[size == dim].copy()
                v = np.stack(some["v"].to_numpy()).astype(np.float64)
                a = measured(v, directions_of(directions.value, dim))[1]
                some["dim"], some["w"] = dim, narrow(v)
                some["home"], some["angle"] = a.argmin(axis=1).astype(np.int32), a.min(axis=1)
                some["v"] = some["v"].where(some["asked"], None)
                yield some[["id", "label", "v", "asked", "dim", "w", "home", "angle"]]

    schema = "id long, label long, v array<double>, asked boolean, dim int, w binary, home int, angle double"
    blocks = max(1, -(-n // (block * WIDE)), min(-(-n // block), BLOCKS))
    ordered = rows.mapInPandas(add_angles, schema).repartitionByRange(blocks, "dim", "home", "angle", "id")
    coded = cut(ordered.withColumn("block", F.spark_partition_id()), "hard-negative-rows")
    blocks = (coded.agg(F.max("block")).first()[0] or 0) + 1
    parts = max(1, -(-n_asked // (block * ASKED)))
    once = coded.filter("asked").groupBy("id").agg(F.min(F.struct("v", "label", "dim", "w", "home", "angle")).alias("x"))
    anchors = once.select("id", "x.label", "x.dim", "x.w", "x.home", "x.angle", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"))

    def compared(some: DataFrame, one: Callable, out: str, first: int, stop: int) -> DataFrame:
        """``one`` over every pair of a block from ``first`` on and a part of the anchors ``some``."""
        # as many tasks as pairs, however few bytes a pair has; toDF: new columns, as both sides come from the same rows
        by = max(1, parts * (stop - first)), "part", "block"
        left = coded.filter(F.col("block").between(first, stop - 1)).select("id", "label", "dim", "w", "home", "angle", "block")
        left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartition(*by)
        right = some.toDF(*some.columns).withColumn("block", F.explode(F.sequence(F.lit(first), F.lit(stop - 1)))).repartition(*by)
        return left.groupBy("part", "block").cogroup(right.groupBy("part", "block")).applyInPandas(one, out)

    near = compared(anchors, lambda r, a: positives_in(r, a, directions.value, positives), "anchor_id long, id long, score long", 0, blocks)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    found = near.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= positives)
    lists = found.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("at", "id", "score"))).alias("ps"))
    lists = cut(lists.select(F.col("anchor_id").alias("id"), F.col("ps.id").alias("p_ids"), F.col("ps.score").alias("p_scores")), "hard-negative-positives")
    told = anchors.join(lists.drop("p_ids"), "id")
    out = "anchor_id long, at int, negative_id long, negative_score long"
    order = Window.partitionBy("anchor_id", "at").orderBy(F.desc("negative_score"), "negative_id")

    def far(some: DataFrame, first: int, stop: int) -> DataFrame:
        return compared(some, lambda r, a: negatives_in(r, a, directions.value, negatives, low, high), out, first, stop)

    def best(df: DataFrame) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)

    # no row below the k-th best of some blocks is among the k best of all
    probe = blocks // PROBE
    unknown = F.transform("p_scores", lambda x: F.lit(int(NONE)).cast("long"))
    if probe:
        early = cut(best(far(told.withColumn("floors", unknown), 0, probe)).drop("rank"), "hard-negative-first")
        full = early.groupBy("anchor_id", "at").agg(F.count("*").alias("n"), F.min("negative_score").alias("least")).filter(F.col("n") >= negatives)
        known = full.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("at", "least"))).alias("known"))
        told = told.join(known.withColumnRenamed("anchor_id", "id"), "id", "left")
        floors = F.transform("p_scores", lambda x, i: F.coalesce(F.element_at("known", i + 1), F.lit(int(NONE)).cast("long")))
        ranked = best(early.unionAll(far(told.withColumn("floors", floors).drop("known"), probe, blocks)))
    else:
        ranked = best(far(told.withColumn("floors", unknown), 0, blocks))
    asked_for = lists.select(F.col("id").alias("anchor_id"), F.posexplode(F.arrays_zip("p_ids", "p_scores")).alias("pos", "p"))
    asked_for = asked_for.select("anchor_id", (F.col("pos") + 1).alias("at"), F.col("p.p_ids").alias("positive_id"), F.col("p.p_scores").alias("positive_score"))
    return ranked.join(asked_for, ["anchor_id", "at"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
