"""Nearest neighbours by cosine with randomly rotated one-bit codes.

Vectors are scaled to length one and rotated by a random orthogonal matrix; the code of a vector
is the sign bits of its rotated coordinates, packed, and a correction scalar: the inner product
of the vector with its code (as a unit vector). For a query, the inner product with a code is
estimated from the packed bits (four bit planes of the rotated, quantised query, AND and
popcount) and divided by the scalar. The estimate's error stays within
``EPS * sqrt((1 - s*s) / (s*s * (d - 1)))`` with high probability, plus the query's exact
quantisation error. Vectors whose upper bound reaches the k-th best exact cosine found so far are
reranked in double precision; the rest is never touched.

Blocks: rows are dealt by hash into blocks of about ``BLOCK`` candidates and of about ``BLOCK``
queries; a task compares one query block with one candidate block, so its memory is bounded
however many rows share a value, and keeps k rows per query. These are shuffled by query and
the k best kept. Every row is a candidate of every query but itself; nothing is capped.

Vectors are scaled by a power of two first, which changes no cosine, so no square over- or underflows.

Defined results: vectors that are NULL, empty, zero, or hold NULL or non-finite components take no
part; rows without an id neither; a query's candidates are the vectors of its own length; ties go to the smaller id;
repeated ids are separate candidates, a query id that repeats is asked once (its smallest vector),
and no row with the query's id is its neighbour; with fewer than k candidates all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, use_package
from strata.llm.spherical import scaled

BLOCK = 4096
SEED = 20240501
#: Width of the error bound in standard deviations of the estimate.
EPS = 3.0
#: Bits per coordinate of a quantised query.
PLANES = 4


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same for every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _words(dim: int) -> int:
    return -(-dim // 64)


def _pack(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    n, dim = bits.shape
    wide = np.zeros((n, 64 * _words(dim)), np.uint8)
    wide[:, :dim] = bits
    return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)


def encode(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits and correction scalars of unit row vectors."""
    rotated = unit @ turn
    return _pack(rotated > 0), np.abs(rotated).sum(axis=1) / np.sqrt(unit.shape[1])


def estimate(codes: np.ndarray, scalars: np.ndarray, query: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of one unit query with coded vectors, and their error bounds."""
    dim = len(query)
    rotated = query @ turn
    low = rotated.min()
    step = (rotated.max() - low) / ((1 << PLANES) - 1) or 1.0
    levels = np.rint((rotated - low) / step).astype(np.uint8)
    total = np.zeros(len(codes), np.int64)
    for plane in range(PLANES):
        word = _pack(((levels >> plane) & 1)[None, :])[0]
        total += np.bitwise_count(codes & word).sum(axis=1, dtype=np.int64) << plane
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    # <sign vector, quantised query>: twice the sum over set bits less the sum over all
    product = 2 * (low * ones + step * total) - (low * dim + step * levels.sum())
    root = np.sqrt(dim)
    lost = np.abs(rotated - (low + step * levels)).sum() / root
    spread = EPS * np.sqrt(np.maximum(0, 1 - scalars**2) / max(1, dim - 1))
    return product / root / scalars, (spread + lost) / scalars


def nearest(ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, scalars: np.ndarray, query_id: int, query: np.ndarray, k: int, turn: np.ndarray) -> list[tuple[int, float]]:
    """The k nearest of a block for one query: ``(id, cosine)``, best first."""
    others = ids != query_id
    if not others.any():
        return []
    length = np.sqrt((query * query).sum())
    guess, bound = estimate(codes, scalars, query / length, turn)
    guess[~others] = -np.inf

    def exact(at: np.ndarray) -> np.ndarray:
        chosen = vectors[at]
        return (chosen * query).sum(axis=1) / (np.sqrt((chosen * chosen).sum(axis=1)) * length)

    first = np.argpartition(-guess, min(4 * k, len(guess) - 1))[: 4 * k]
    first = first[others[first]]
    scores = exact(first)
    floor = np.sort(scores)[-k] if len(scores) >= k else -np.inf
    more = np.flatnonzero(others & (guess + bound >= floor))
    more = np.setdiff1d(more, first, assume_unique=True)
    at, scores = np.concatenate([first, more]), np.concatenate([scores, exact(more)])
    best = np.lexsort((ids[at], -scores))[:k]
    return [(int(ids[at[i]]), float(scores[i])) for i in best]


def search(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest rows of every row for which the Column ``is_query`` holds."""
    use_package(vectors.sparkSession)
    double = F.col(vec_col).cast("array<double>")
    flags = vectors.select(F.col(id_col).cast("long").alias("id"), double.alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = flags.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & sound)
    n, q = rows.agg(F.count("*"), F.count_if("is_query")).first()
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-q // block))
    hashed = F.xxhash64("id", "v")

    def add_codes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = batch["v"].map(len)
            for dim in sorted(set(size)):
                some = batch[size == dim]
                v = scaled(np.stack(some["v"].to_numpy()))
                codes, scalars = encode(v / np.sqrt((v * v).sum(axis=1, keepdims=True)), rotation(dim))
                yield pd.DataFrame({"id": some["id"], "v": some["v"], "c": some["c"], "code": [x.tobytes() for x in codes], "scalar": scalars})

    dealt = rows.select("id", "v", F.pmod(hashed, F.lit(blocks)).cast("int").alias("c"))
    coded = cut(dealt.mapInPandas(add_codes, "id long, v array<double>, c int, code binary, scalar double"), "ann-codes")
    asked = rows.filter("is_query").groupBy("id").agg(F.min("v").alias("v"))
    asked = asked.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("q"))
    left = coded.select("*", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"))
    right = asked.select("id", "v", "q", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("c"))

    def compare(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        of, asked_of = candidates["v"].map(len), queries["v"].map(len)
        for dim in sorted(set(of) & set(asked_of)):
            some, wanted = candidates[of == dim], queries[asked_of == dim]
            ids, v = some["id"].to_numpy(), scaled(np.stack(some["v"].to_numpy()))
            codes = np.frombuffer(b"".join(some["code"]), np.uint64).reshape(len(ids), -1)
            scalars = some["scalar"].to_numpy()
            for qid, query in zip(wanted["id"], scaled(np.stack(wanted["v"].to_numpy()))):
                out += [(qid, i, s) for i, s in nearest(ids, v, codes, scalars, qid, query, k, rotation(dim))]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    near = left.groupBy("q", "c").cogroup(right.groupBy("q", "c")).applyInPandas(compare, "query_id long, vec_id long, score double")
    # k rows per query and candidate block; only the k best of them stay in the aggregate's result
    best = near.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score")
    )
